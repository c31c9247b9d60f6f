import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from starloom.llm.mixing import systematic_mix, take_mix, targets


def shared_out(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > cap * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(2)
    for n in (1, 2, 7, 40):
        sizes = {f"s{i}é" if i else None: rng.choice([0, 1, 5, 100, 10_000]) for i in range(n)}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in targets(table, (1, 2, 3), 3).collect()}
        want = shared_out(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_taken_words_meet_targets_and_reruns_agree(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c"]), rng.choice([0, 3, 3, 3, 50, 400])) for i in range(3000)]
    rows += [(10_000 + i, "tiny", 7) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    out = systematic_mix(df, size=F.col("size")).collect()
    assert len(out) == len(rows)
    taken, target, longest = Counter(), {}, defaultdict(int)
    for r in out:
        s = r["row"]["source"]
        taken[s] += r["copies"] * r["size"]
        target[s], longest[s] = r["target"], max(longest[s], r["size"])
        assert 0 <= r["copies"] <= 3
    assert all(abs(taken[s] - target[s]) <= 2 * longest[s] for s in target)
    again = systematic_mix(df.repartition(7), size=F.col("size")).collect()
    assert {(r["row"]["doc_id"], r["copies"]) for r in out} == {(r["row"]["doc_id"], r["copies"]) for r in again}


def test_edges_and_stage(edge_docs, no_docs):
    out = systematic_mix(edge_docs).collect()
    assert len(out) == edge_docs.count()
    sizes = Counter()
    for r in out:
        sizes[r["row"]["source"]] += r["size"]
    want = shared_out(dict(sizes))
    assert all(abs(r["target"] - want[r["row"]["source"]]) < 1e-6 * (1 + r["target"]) for r in out)
    mixed = take_mix(edge_docs)
    assert mixed.columns == edge_docs.columns and mixed.count() == sum(r["copies"] for r in out)
    assert systematic_mix(no_docs).count() == 0 and take_mix(no_docs).count() == 0
