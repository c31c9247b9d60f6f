import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm.packing import pack_documents, plan_patterns
from starloom.llm.tokens import TextIds


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_places_every_piece_once(sizes):
    counts = np.bincount(sizes, minlength=65)
    placed = np.zeros(65, int)
    for items, times in plan_patterns(counts, 64):
        assert sum(n * c for n, c in items.items()) <= 64
        for n, c in items.items():
            placed[n] += c * times
    assert (placed == counts).all()


def test_plan_is_near_the_fewest():
    rng = np.random.default_rng(0)
    sizes = np.clip(rng.lognormal(6, 1, 5000).astype(int) + 1, 1, 2048)
    n = sum(times for _, times in plan_patterns(np.bincount(sizes, minlength=2049), 2048))
    assert n <= 1.002 * -(-sizes.sum() // 2048) + 1


def test_exact_single_pair_and_triple():
    for rest in ([40], [30, 10], [15, 14, 11]):
        counts = np.bincount([60, *rest], minlength=101)
        assert [(sorted(i.elements()), t) for i, t in plan_patterns(counts, 100)] == [(sorted([60, *rest]), 1)]


def test_ids_equal_the_tokenizer():
    ids = TextIds()
    texts = ["It's a 1999's TEST\u0085x y", "<|endoftext|> a<|endoftext|>b", "é é ΣΑΣ \x1c z", "", "日本語 テキスト"]
    for t, got in zip(texts, ids.of(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_and_places(spark, edge_docs, no_docs, capacity):
    rows = pack_documents(edge_docs, capacity=capacity, keep_ids=True).collect()
    ids = TextIds()
    want = defaultdict(int)
    for d in edge_docs.collect():
        whole = ids.of([d["text"]])[0] + b"\0\0\0\0"
        for i, at in enumerate(range(0, len(whole), 4 * capacity)):
            part = whole[at : at + 4 * capacity]
            want[(d["doc_id"], i, at // 4, len(part) // 4, zlib.crc32(part))] += 1
    got = defaultdict(int)
    for r in rows:
        got[(r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
    assert got == want
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert pack_documents(no_docs).count() == 0


def test_simple_pieces_go_to_the_model_and_have_the_tokenizers_ids():
    ids = TextIds(remembered=40)
    asked, whole = [], ids._ids
    ids._ids = lambda text: asked.append(text) or whole(text)
    texts = ["the worde naïve, straße($$$) x1y22 don't", "Ÿ ÀÉ× ÿ÷ a.b.c, end. ###", "ABC <|endoftext|> Word", "plain words, and more."]
    found = ids.of(texts)
    assert not any(b"worde" in x or b"$$$" in x or b"plain" in x for x in asked)
    assert any(b"don't" in x for x in asked)
    for text, got in zip(texts, found, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == whole(text.encode())


def test_pieces_of_an_earlier_stage_are_forgotten():
    ids = TextIds.shared(stage=-1)
    first = ids.of(["alpha beta"])
    assert TextIds.shared(stage=-1) is ids and b"alpha" in ids.known
    assert not TextIds.shared(stage=-2).known and ids.of(["alpha beta"]) == first
