import hashlib
import random

from starloom.llm.fingerprints import BINS, fingerprint_edits, next_ids


def brute_edits(docs):
    """(id, text) in order of id: each one's edited text."""
    out = {}
    for n, (i, t) in enumerate(docs):
        follow = docs[(n + 1) % len(docs)][1]
        half = len(t) // 2
        out[i] = t[: len(t) - half] + follow[:half]
    return out


def shingles(t):
    w = t.split(" ")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_edits_and_likeness(spark):
    rng = random.Random(5)
    vocabulary = [f"mot{i}é" for i in range(3000)]
    ids = sorted(rng.sample(range(-5_000_000, 10_000_000), 300)) + list(range(20_000_000, 20_000_700))
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([6, 30, 200, 900])))) for i in ids]
    docs[40] = (docs[40][0], docs[39][1])
    df = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id bigint, text string")
    got = {r["id"]: r for r in fingerprint_edits(df).collect()}
    edited, texts, errors = brute_edits(docs), dict(docs), []
    assert len(got) == len(docs)
    for n, (i, t) in enumerate(docs):
        r = got[i]
        assert r["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert r["n_chars"] == len(t) and len(r["fingerprint"]) == 2 * BINS
        a, b = shingles(t), shingles(edited[i])
        # an estimate over few shingles is coarse: one or two of them fill all bins
        if len(a) > 100:
            errors.append(abs(r["near_edited"] - len(a & b) / len(a | b)))
        follow = docs[(n + 1) % len(docs)][0]
        assert (r["near_next"] > 0.99) == (texts[follow] == t)
        assert (r["fingerprint"] == got[follow]["fingerprint"]) == (texts[follow] == t)
    assert len(errors) > 300 and sum(errors) / len(errors) < 0.04 and max(errors) < 0.2


def test_edges(spark, edge_docs, no_docs):
    rows = fingerprint_edits(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r["id"]: r for r in rows}
    assert by_id[0]["fingerprint"] == by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == ""
    assert by_id[0]["near_next"] == 1.0 and by_id[0]["edited_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[None]["edited_sha256"] is None and by_id[None]["near_next"] is None
    assert all(0 <= r["near_edited"] <= 1 for r in rows if r["id"] is not None)
    assert fingerprint_edits(no_docs).count() == 0
    one = fingerprint_edits(spark.createDataFrame([(5, "ab cd")], "doc_id bigint, text string")).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"ab ab").hexdigest() and one[0]["near_next"] == 1.0


def test_next_ids_of_sparse_ids(spark):
    rng = random.Random(1)
    ids = sorted({rng.randrange(-(1 << 62), 1 << 62) for _ in range(400)})
    got = dict(next_ids(spark.createDataFrame([(i,) for i in ids], "id bigint")).collect())
    assert got == dict(zip(ids, [*ids[1:], None], strict=True))
