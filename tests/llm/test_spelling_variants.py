import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from starloom.llm import spelling_variants as S
from starloom.session import checkpoint_dir


def near_by_brute_force(words):
    """Words that agree after one letter is left out at the same place, or one is left out of one."""
    out, cut = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut[i, w[:i] + w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                out[w].add(short)
                out[short].add(w)
    for same in cut.values():
        for w in same:
            out[w] |= {o for o in same if o != w and len(o) == len(w)}
    return out


def brute(docs, min_length=7, min_count=2, factor=10, drop=31):
    counts = Counter()
    for doc_id, text in docs:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        runs = "".join(c if "a" <= c <= "z" or "\xc0" <= c <= "\xff" else " " for c in low).split()
        for run in runs:
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= min_count}
    near, form = near_by_brute_force(words), {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= factor * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near.get(w, ())), words[form[w]] if w in form else None))
    return out


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id bigint, text string, n int, word string")
    return {tuple(r) for r in S.spelling_variants(df, **options).collect()}


def edited(rng, word, letters):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at + rng.choice([0, 1]) :]])


def corpus(seed, letters, n):
    rng, words = random.Random(seed), []
    for _ in range(n):
        word = "".join(rng.choices(letters, k=rng.randint(5, 12)))
        words += [word] * rng.choice([1, 2, 3, 40, 400])
        for _ in range(rng.randint(0, 4)):
            word = edited(rng, word, letters)
            words += [word] * rng.choice([1, 2, 5, 30])
    rng.shuffle(words)
    return [(i, " ".join(words[i::40])) for i in range(40)]


@pytest.mark.parametrize("letters", ["abcdefghijklmnop\xe9\xdf\xf7", "ab"])
def test_equals_brute_force(spark, letters):
    docs = corpus(2, letters, 300)
    want = brute(docs)
    assert sum(r[4] for r in want) > 100 and any(r[2] != r[1] for r in want if r[1])
    assert run(spark, docs) == want


def test_every_near_pair_meets_through_a_pivot():
    rng = random.Random(8)
    for letters in ("ab", "abcdefgh"):
        words = {"".join(rng.choices(letters, k=rng.randint(4, 9))).encode() for _ in range(300)}
        words |= {edited(rng, w.decode(), letters).encode() for w in words}
        words = {w for w in words if len(w) >= 4}
        count = Counter(g for w in words for g in set(S._bigrams(w)))
        order = {g: (n, k) for k, (n, g) in enumerate(sorted((n, g) for g, n in count.items()))}
        keys = {w: S.lookups(w, order) for w in words}
        text = {w.decode() for w in words}
        for a, others in near_by_brute_force(text).items():
            for b in others:
                p, q = keys[a.encode()], keys[b.encode()]
                assert any(p[k] or q[k] for k in p.keys() & q.keys()), (a, b)


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choices("abcd", k=rng.randint(4, 14))).encode()
        grams = sorted(set(S._bigrams(word)))
        rng.shuffle(grams)
        order = {g: (rng.randint(1, 9), k) for k, g in enumerate(grams)}
        prefix = S.prefix_of(word, order)
        cost = lambda p: sum(order[word[at : at + 2]][0] for at in p)
        p = S.pivots_of(word, prefix, order)
        assert p[1] - p[0] >= 2 and set(p) <= set(prefix)
        assert cost(p) == min(cost((a, b)) for a in prefix for b in prefix if b - a >= 2)


def test_long_runs_of_one_letter(spark):
    runs = ["a" * n for n in (7, 8, 58, 59, 60, 61, 62, 63, 64, 3000, 3001)] + ["a" * 61 + "b", "ab" * 62, "ab" * 62 + "a"]
    docs = [(i, " ".join(runs)) for i in range(2)]
    assert run(spark, docs, drop_one_in=0) == brute(docs, drop=0)


def test_edges(spark, edge_docs, no_docs):
    assert S.spelling_variants(no_docs).count() == 0
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert {tuple(r) for r in S.spelling_variants(edge_docs).collect()} == brute(docs)
    only = [(1, None), (None, ""), (None, "Abcdefgh ABCDEFGH abcdefghāabcdefgh"), (None, "ABCDEFGH"), (1, "x" * 6 + " " + "x" * 6)]
    assert run(spark, only) == brute(only) and len(brute(only)) == 1
    with pytest.raises(ValueError):
        S.spelling_variants(no_docs, min_length=3)


def test_tables_are_few_files(spark):
    """Not one a shuffle partition: a file costs an executor processes of its own."""
    docs = corpus(5, "abcdefgh", 200)
    set_before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    top = Path(checkpoint_dir(spark).removeprefix("file:"), "starloom-scratch")
    before = set(top.glob("*"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = S.spelling_variants(spark.createDataFrame(docs, "doc_id bigint, text string"))
        assert out.rdd.getNumPartitions() <= 6
        assert {tuple(r) for r in out.collect()} == brute(docs)
    finally:
        for k, v in set_before.items():
            spark.conf.set(k, v)
    files = {x.name.rsplit("-", 1)[0]: len(list(x.glob("part-*"))) for x in sorted(set(top.glob("*")) - before)}
    assert {"words", "near-words", "forms"} <= set(files) and all(n <= 6 for n in files.values())
    assert not spark.sparkContext._jsc.getPersistentRDDs()
