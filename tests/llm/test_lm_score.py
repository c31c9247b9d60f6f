import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from starloom.llm import lm_score as lm
from starloom.llm.lm_score import score_documents


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) + [""]


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def check(df):
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    counts = Counter(w for i, t in docs if not is_held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    texts = {i: words(t) for i, t in docs}
    out = score_documents(df).collect()
    assert len(out) == len(docs)
    for r in out:
        w = texts[r["id"]]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert abs(base - r["base_score"]) < 1e-6 * (1 - base)
        assert (r["held_out"], r["n_tokens"], r["n_known"]) == (is_held(r["id"]), len(w), sum(counts[x] > 0 for x in w))
        assert r["train_tokens"] == n and r["score"] < 0
    return out


def test_held_out_texts_of_two_languages(spark):
    rng = random.Random(0)
    tongues = [[f"{a}{b}{e}" for a in "bcdfg" for b in "aeiou" for e in ends] for ends in (("ing", "ed"), ("aux", "oir"))]
    docs = [(i, " ".join(rng.choices(tongues[i % 2], k=120))) for i in range(400)]
    docs += [(1000 + i, f"rare{i} unseen{i} " * 3) for i in range(20)]
    out = check(spark.createDataFrame(docs, "doc_id bigint, text string"))
    held = [r for r in out if r["held_out"] and r["id"] < 1000]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.1 * sum(r["n_tokens"] for r in held)


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    assert score_documents(no_docs).count() == 0
    assert check(edge_docs.filter("doc_id is null")) is not None


def test_partitions_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    runs = [{r["id"]: r for r in score_documents(docs.repartition(n)).collect()} for n in (1, 8, 32)]
    held = [i for i, r in runs[0].items() if r["held_out"]]
    tokens = sum(runs[0][i]["n_tokens"] for i in held)
    gains = [sum(run[i]["score"] - run[i]["base_score"] for i in held) / tokens for run in runs]
    assert min(gains) > 0.02 and max(gains) - min(gains) < 0.01 * min(gains)


def small_model(texts):
    """Lexicon and one step's weights of a few texts."""
    docs = [lm.words_of(t) for t in texts]
    counts = Counter(w for d in docs for w in d)
    own = {w: i for i, (w, _) in enumerate(counts.most_common(lm.OWN_CLASSES))}
    mass = np.full(lm.LEAVES, 0.5)
    for w, n in counts.items():
        mass[leaf_of(w, own)] += n + 0.5
    lexicon = lm.Lexicon(own, {w: counts[w] for w in own}, mass)
    return docs, lexicon


def leaf_of(word, own):
    return own[word] if word in own else int(lm.leaves_of([word], lm.hashes_of([word]))[0])


def contexts(doc, lexicon):
    """Every token's feature hashes, written out one by one."""
    mask, mark = (1 << 64) - 1, 0x5BD1E995
    h = [int(lm.hashes_of([w])[0]) for w in doc]
    c = [int(lm.class_of(np.array([leaf_of(w, lexicon.own)]))[0]) for w in doc]
    for i in range(len(doc)):
        h1, h2 = (h[i - k] if i >= k else mark for k in (1, 2))
        c1, c3 = (c[i - k] if i >= k else mark for k in (1, 3))
        pair = (h1 * 0x9E3779B97F4A7C15 & mask) ^ (h2 * 0xC2B2AE3D27D4EB4F + 3 & mask)
        yield [h1 * 0xBF58476D1CE4E5B9 & mask, h2 * 0x94D049BB133111EB & mask, pair, (c1 * 64 + c3 + 11) * 0x9E3779B97F4A7C15 & mask]


def plain_score(doc, lexicon, weights):
    """log10 of the two softmaxes of a text, token by token."""
    total = 0.0
    for word, context in zip(doc, contexts(doc, lexicon), strict=True):
        leaf = leaf_of(word, lexicon.own)
        cls = int(lm.class_of(np.array([leaf]))[0])
        z = [b + sum(weights.of_class[f >> (64 - weights.bits)][k] for f in context) for k, b in enumerate(lexicon.class_bias())]
        total += (z[cls] - math.log(sum(map(math.exp, z)))) / math.log(10)
        if leaf >= lm.OWN_CLASSES:
            shared, member = divmod(leaf - lm.OWN_CLASSES, lm.MEMBERS)
            rows = [((f ^ ((shared + 1) * 0xD6E8FEB86659FD93 % 2**64)) * 0xFF51AFD7ED558CCD % 2**64) >> (64 - weights.bits) for f in context]
            z = [b + sum(weights.of_member[r][k] for r in rows) for k, b in enumerate(lexicon.member_bias()[shared])]
            total += (z[member] - math.log(sum(map(math.exp, z)))) / math.log(10)
    return total


def test_against_plain_softmaxes():
    rng = random.Random(3)
    vocabulary = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("n", "ng", "st")]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(40))) for _ in range(30)] + [None, ""]
    docs, lexicon = small_model(texts)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    weights = lm.Weights.zeros(10)
    for turn in range(2):
        seen, expected = lm._gradient(weights, lexicon, iter([batch]), turn).reshape(2, -1, lm.OUTPUTS)
        want = Counter()
        for doc in docs:
            for word, context in zip(doc, contexts(doc, lexicon), strict=True):
                cls = int(lm.class_of(np.array([leaf_of(word, lexicon.own)]))[0])
                want.update((f >> 54, cls) for f in context)
        found = seen[:, : lm.CLASSES]
        assert {(r, c): found[r, c] for r, c in np.argwhere(found)} == want
        # what is expected falls on the rows that are seen, in either softmax
        for part in (slice(0, lm.CLASSES), slice(lm.CLASSES, None)):
            assert (seen[:, part].sum(axis=1) == expected[:, part].sum(axis=1)).all()
        weights = weights.plus(lm.step_of(seen, expected).astype(np.float32))
    for _, _, some, places, known in lm._chunks(iter([batch]), lexicon):
        starts = lm._starts(some)
        got = np.add.reduceat(lm._context_scores(weights, lexicon, places, starts, known), starts)
        assert np.allclose(got, [plain_score(d, lexicon, weights) for d in some], rtol=1e-4, atol=1e-4)


def test_draws_follow_the_model():
    odds = np.tile(np.array([1.0, 3.0, 0.0, 6.0], np.float32), (100_000, 1))
    at = np.random.default_rng(0).random(len(odds), dtype=np.float32)
    assert np.allclose(np.bincount(lm._drawn(odds, at), minlength=4) / len(odds), [0.1, 0.3, 0.0, 0.6], atol=0.01)


def test_packed_counts():
    counts = np.array([[0, 1, 255, 256], [70_000, 2**31 - 1, 0, 3]], np.int32)
    assert (lm._unpacked(lm._packed(counts)).reshape(2, -1) == counts).all()


ODD = ["", None, "  ", " A b\x0b\tÀC  b\r", "x", "\n \x1c\x85 y Z ", "a\0 b\x7f a", "\U0001f600 Éa " * 3]


def test_texts_are_split_as_words(monkeypatch):
    texts = pa.array(ODD * 3, pa.string()).slice(2)
    want = [lm.words_of(t) for t in texts.to_pylist()]
    assert [[w.encode() for w in d] for d in lm.split_texts(texts).to_pylist()] == want
    monkeypatch.setattr(lm, "CHUNK_BYTES", 16)
    batch = pa.RecordBatch.from_pydict({"text": texts})
    lexicon = lm.Lexicon({b"b": 0}, {b"b": 4, b"": 7}, np.ones(lm.LEAVES))
    found, rows = [], []
    for _, some, docs, places, seen in lm._chunks(iter([batch]), lexicon):
        found += list(docs)
        rows += some
        words = docs.words.to_pylist()
        assert len(set(words)) == len(words) == len(seen.hash) and len(places) == sum(map(len, docs))
        assert (seen.hash == lm.hashes_of(words)).all() and (seen.leaf == 0).tolist() == [w == b"b" for w in words]
        assert np.isnan(seen.log_count).tolist() == [w not in lexicon.frequent for w in words]
        listed, times = docs.counts(np.isnan(seen.log_count)[places])
        mine = [Counter(w for w in d if w not in lexicon.frequent) for d in docs]
        assert [Counter(dict(zip(*x))) for x in zip(listed.to_pylist(), times.to_pylist(), strict=True)] == mine
    assert found == want and rows == list(range(len(want)))


def test_words_are_counted_without_a_call_each(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(ODD * 50, pa.string())})
    want = Counter(w for t in ODD * 150 for w in lm.words_of(t))
    monkeypatch.setattr(lm, "words_of", None)  # once called for every text
    for remembered in (lm.REMEMBERED, 5):
        monkeypatch.setattr(lm, "REMEMBERED", remembered)
        monkeypatch.setattr(lm, "CHUNK_BYTES", 64)
        found = Counter()
        for out in lm._count(iter([batch] * 3)):
            found.update(dict(zip(out.column("word").to_pylist(), out.column("n").to_pylist(), strict=True)))
        assert found == want
    assert not any(out.num_rows for out in lm._count(iter([batch.slice(0, 0)])))


def test_the_model_grows_with_the_training_tokens():
    assert [lm.row_bits(lm.TOKENS_PER_ROW << k) for k in (0, 14, 18, 19, 30)] == [14, 14, 18, 19, 30]


def test_parts_of_a_gradient(monkeypatch):
    texts = [" ".join(f"w{i * j % 37}" for i in range(60)) for j in range(40)] + [None]
    _, lexicon = small_model(texts)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    weights = lm.Weights.zeros(8)
    monkeypatch.setattr(lm, "CHUNK_BYTES", 512)
    want = lm._gradient(weights, lexicon, iter([batch]), 0)
    for kept in (lm.KEPT, 1000):
        monkeypatch.setattr(lm, "KEPT", kept)
        found, n = np.zeros_like(want).T.ravel(), 0
        for keys, counts in lm._gradient_parts(weights, lexicon, iter([batch]), 0):
            assert (np.diff(keys) > 0).all() and (counts > 0).all()
            found[keys] += counts.astype(np.int32)
            n += 1
        assert (found.reshape(-1, 2).T == want).all() and (n > 1) == (kept == 1000)


def test_models_in_files_score_as_models_that_are_sent(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(5)
    monkeypatch.setattr(lm, "TOKENS_PER_ROW", 1)
    runs = []
    for held in (lm.HELD_BITS, 14):
        monkeypatch.setattr(lm, "HELD_BITS", held)
        runs.append(sorted(map(tuple, score_documents(docs).collect())))
    tokens = runs[0][0][4]
    assert 14 < lm.row_bits(tokens) <= 18  # several files
    assert [r[:-1] for r in runs[0]] == [r[:-1] for r in runs[1]]
    assert np.allclose([r[-1] for r in runs[0]], [r[-1] for r in runs[1]], rtol=1e-9)
    assert sum(r[-1] - r[-2] for r in runs[1] if r[1]) > 0
