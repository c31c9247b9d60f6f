import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa

from starloom.llm import minhash_dedup as M
from starloom.llm.components import components
from starloom.session import checkpoint_dir


def shingles(text, k):
    w = text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k, percent):
    sets = [(i, shingles(t or "", k)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def corpus(seed=3):
    """Groups of copies that chain: each is an edit of the one before."""
    rng, docs = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(4000)]
    for group in range(14):
        words = rng.choices(vocabulary, k=rng.choice([8, 40, 120, 300]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            for _ in range(rng.choice([0, 1, 1, 2])):
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words).title() if rng.random() < 0.3 else " ".join(words))
    passage = rng.choices(vocabulary, k=60)
    docs += [" ".join(passage + rng.choices(vocabulary, k=60)) for _ in range(15)]
    docs += [None, "", "  ", "x", "x y", "x y", "X Y"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def run(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    return {r["id"]: r for r in M.near_duplicates(df, **options).collect()}


def test_components_equal_brute_force(spark):
    for k, percent in ((3, 85), (5, 80)):
        docs = corpus()
        want, got = brute(docs, k, percent), run(spark, docs, k=k, percent=percent)
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(r["kept"] == (i == want[i]) for i, r in got.items())
        assert all(r["n_shingles"] == len(shingles(docs[i][1] or "", k)) for i, r in got.items())


def test_edges_and_stage(spark, edge_docs, no_docs):
    out = {(r["id"], r["component_id"], r["kept"]) for r in M.near_duplicates(edge_docs).collect()}
    assert (4, 4, True) in out and (5, 4, False) in out  # equal but for A-Z
    assert {(0, 0, True), (1, 1, True), (2, 2, True), (None, None, True)} <= out
    assert M.near_duplicates(no_docs).count() == 0
    kept = M.drop_near_duplicates(edge_docs)
    assert sorted(kept.columns) == sorted(edge_docs.columns)
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [0, 1, 2, 3, 4, 7, 9, None]))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(1, x) for x in range(2, 60)] + [(9, 9)]
    got = defaultdict(set)
    for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect():
        got[r["root"]].add(r["node"])
    assert got == {100: set(range(100, 181)), 1: set(range(1, 60))}


def test_bands_and_posterior():
    for t in (0.8, 0.85, 0.9):
        bands = M.band_count(t)
        assert (1 - t**M.BAND_ROWS) ** bands <= M.MISS_BANDS
        least = M.least_matches(t, bands * M.BAND_ROWS)
        assert least == sorted(least) and least[-1] <= t * bands * M.BAND_ROWS
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:3000], rng.integers(0, 1 << 62, 1000, dtype=np.uint64)]))
    same = (M.signature(a, 288) == M.signature(b, 288)).mean()
    assert abs(same - 3000 / 5000) < 0.1


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Edits of edits of one text, around the threshold: many balls that touch."""
    rng, docs = random.Random(11), []
    vocabulary = [f"w{i}" for i in range(3000)]
    base = rng.choices(vocabulary, k=90)
    for n in range(260):
        words = list(base if n % 3 else docs[rng.randrange(len(docs))].split() if docs else base)
        for _ in range(rng.choice([1, 1, 2, 3, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append(" ".join(words))
    docs = list(enumerate(docs))
    met = []
    real = M._visits
    monkeypatch.setattr(M, "_visits", lambda *a: met.append(1) or real(*a))
    want = {}
    for parts in (2048, 8):
        monkeypatch.setattr(M, "PART_MEMBERS", parts)
        for k, percent in ((3, 85), (5, 80)):
            want[k] = want.get(k) or brute(docs, k, percent)
            assert {i: r["component_id"] for i, r in run(spark, docs, k=k, percent=percent).items()} == want[k]
    assert met and len(set(want[3].values())) > 3


def test_visitors_meet_every_member_of_every_part(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_MEMBERS", 5)
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 62, 100, dtype=np.uint64))
    sets = {i: np.unique(np.r_[rng.choice(base, 94, replace=False), rng.integers(0, 1 << 62, 5, dtype=np.uint64)]) for i in range(60)}
    bands = M.band_count(0.8) * M.BAND_ROWS
    table = [(i, s.tobytes(), (M.signature(s, bands) >> np.uint64(24)).astype(np.uint8).tobytes()) for i, s in sets.items()]
    df = spark.createDataFrame(table, "id bigint, set binary, sig binary")
    centre = lambda i: 0 if i < 40 else 40 if i < 58 else i
    members = spark.createDataFrame([(centre(i), i, 0.3, len(s), len(s)) for i, s in sets.items()], "centre bigint, id bigint, far double, n bigint, c bigint")
    pairs = [(0, 40), (0, 58), (40, 59)]
    apart = spark.createDataFrame([(a, b, 0.3, 0.3, -0.1) for a, b in pairs], "a bigint, b bigint, ra double, rb double, slack double")
    got = {(r["a"], r["b"]) for r in M._visits(apart, members, df.select("id", "sig"), df.select("id", "set"), 0.8, 80).collect()}
    want = set()
    for i, s in sets.items():
        for j, u in sets.items():
            n = len(np.intersect1d(s, u))
            if i < j and ((centre(i), centre(j)) in pairs) and 100 * n >= 80 * (len(s) + len(u) - n):
                want.add((i, j))
    assert got == want and len(want) > 20


def test_tasks_hold_a_bounded_number_of_rows():
    texts = pa.RecordBatch.from_pydict({"id": pa.array(range(1300), pa.int64()), "text": ["one two three four"] * 1300})
    assert [b.num_rows for b in M._profiles(3, 4)(iter([texts]))] == [512, 512, 276]

    taken = []

    def cell():
        members = set(range(20))
        for n, ids in enumerate([range(3), range(10, 13), range(20, 23)]):
            taken.append(n)
            shingles = [np.array(sorted(members), np.uint64)] * 3
            yield pa.RecordBatch.from_pydict(
                {
                    "host": pa.array([1] * 3, pa.int64()),
                    "part": pa.array([0] * 3, pa.int32()),
                    "guest": pa.array([n > 0] * 3),
                    "id": pa.array(ids, pa.int64()),
                    "far": pa.array([1.0] * 3),
                    "slack": pa.array([0.0] * 3),
                    "c": pa.array([20] * 3, pa.int64()),
                    "sig": pa.array([bytes(32)] * 3, pa.binary()),
                    "set": pa.array([s.tobytes() for s in shingles], pa.binary()),
                }
            )

    links = M._visited(0.85, 85)(cell())
    first = next(links)
    assert taken == [0, 1]  # guests pass by; only the members are held
    assert set(zip(first["a"].to_pylist(), first["b"].to_pylist(), strict=True)) == {(a, b) for a in range(3) for b in range(10, 13)}
    assert next(links).num_rows == 9


def test_small_tables_are_few_files(spark):
    """Not one a shuffle partition: a file costs an executor processes of its own."""
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join([*words[:20], f"x{i % 4}", *words[20:], f"y{i % 3}"])) for i in range(60)]
    set_before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    top = Path(checkpoint_dir(spark).removeprefix("file:"), "starloom-scratch")
    before = set(top.glob("*"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = M.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), k=5, percent=80).collect()
    finally:
        for k, v in set_before.items():
            spark.conf.set(k, v)
    assert {r["id"]: r["component_id"] for r in out} == brute(docs, 5, 80)
    files = {x.name.rsplit("-", 1)[0]: len(list(x.glob("part-*"))) for x in sorted(set(top.glob("*")) - before)}
    known = {"classes", "leaders", "buckets", "balls", "placed", "bounds", "stats", "links", "apart", "components"}
    assert known <= set(files) and all(files[x] <= 12 for x in known)
