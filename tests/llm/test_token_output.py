import os
import zlib

import numpy as np
import pytest

from starloom.llm.token_output import permute, read_sequences, write_training_order
from starloom.llm.tokens import TextIds


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 1000, 65_537])
def test_permutation(n):
    slots = permute(np.arange(n), n)
    assert sorted(slots) == list(range(n))
    if n >= 1000:
        assert (permute(np.arange(n), n, key=7) != slots).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


def test_shards_round_trip(edge_docs, scratch):
    index = write_training_order(edge_docs, scratch, seq_len=64, shard_sequences=100).collect()
    want = sorted(
        (str(d["doc_id"]), np.frombuffer(TextIds(dtype="<u2").of([d["text"]])[0], "<u2").tolist() + [49407])
        for d in edge_docs.collect()
    )
    n = len(index)
    assert sorted(r["slot"] for r in index) == list(range(n))
    rows = read_sequences(scratch, 0, n)
    assert rows.shape == (n, 64)
    pieces = {}
    for r in index:
        ids = rows[r["slot"]]
        assert zlib.crc32(ids.astype("<u2").tobytes()) == r["ids_crc32"] and not ids[r["length"] :].any()
        with open(f"{scratch}/shard-{r['shard']:07d}.bin", "rb") as f:
            f.seek(r["byte_offset"])
            assert f.read(128) == ids.astype("<u2").tobytes()
        pieces.setdefault((str(r["id"]), r["piece"]), []).append(ids[: r["length"]].tolist())
    # equal rows have equal pieces, so piece i of a document is the same in each
    got = []
    for i, whole in want:
        joined, k = [], 0
        while (i, k) in pieces:
            joined += pieces[(i, k)][0]
            k += 1
        got.append((i, joined))
    assert got == want
    assert (read_sequences(scratch, 150, 60) == rows[150:210]).all()
    assert not [f for f in os.listdir(scratch) if f.endswith(".part")]
    again = write_training_order(edge_docs, scratch, seq_len=64, shard_sequences=100).collect()
    assert sorted(map(str, again)) == sorted(map(str, index))


def test_empty_table(no_docs, scratch):
    assert write_training_order(no_docs, scratch).count() == 0
    assert read_sequences(scratch, 0, 10).shape[0] == 0


def test_a_shorter_run_leaves_no_old_shard_and_a_dead_one_no_manifest(spark, edge_docs, scratch, monkeypatch):
    from starloom.llm import token_output as T

    write_training_order(edge_docs, scratch, seq_len=64, shard_sequences=50)
    first = {f for f in os.listdir(scratch) if f.startswith("shard-")}
    few = edge_docs.where("doc_id < 6")
    n = write_training_order(few, scratch, seq_len=64, shard_sequences=50).count()
    assert {f for f in os.listdir(scratch) if f.startswith("shard-")} == {"shard-0000000.bin"} < first
    assert read_sequences(scratch, 0, 10**6).shape == (n, 64)
    real = T.cut_lineage
    monkeypatch.setattr(T, "cut_lineage", lambda df, name: real(df, name) if name == "token-ids" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_training_order(few, scratch, seq_len=64, shard_sequences=50)
    assert "manifest.json" not in os.listdir(scratch)
