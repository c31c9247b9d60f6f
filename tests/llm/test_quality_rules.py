import re
from collections import Counter

from starloom.llm.quality_rules import judge_documents, keep_documents


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def prose(seed, n=60):
    return " ".join(f"w{(seed * 7919 + i * 104729) % 100_003}" for i in range(n))


def test_base_counts(spark, edge_docs, no_docs):
    texts = ["a b c d e " * 4, "x # y <p> |$%&*\n\nx # y\nx # y\n", "a b c d e f g a b c d e\tz", "\n \n", "é ñ ß " + prose(1)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "'s' as source")
    for table in (df, edge_docs):
        texts_of = {}
        for r in table.collect():
            texts_of[r["doc_id"]] = r["text"]
        out = judge_documents(table).collect()
        assert len(out) == table.count()
        for r in out:
            assert tuple(r[f] for f in FIELDS) == base(texts_of[r["id"]])
    assert judge_documents(no_docs).count() == 0


def test_common_lines_deplete_but_copies_do_not(spark):
    """Every host has a line in all its documents; 40 copies of one text, and 40
    copies with one line changed, share all their lines."""
    common = "Subscribe  to our news   and follow us on all of the channels that we have in store for you today"
    rows = [(i, "h", f"{prose(i)}\n{common if i % 2 else common.upper()}\n{prose(i + 500)}") for i in range(60)]
    rows += [(100 + i, "h", f"{common}\n{prose(i, 3)}") for i in range(5)]
    same = "\n".join(prose(900 + j, 12) for j in range(8))
    rows += [(200 + i, "h", same) for i in range(40)]
    rows += [(300 + i, "h", same.replace(prose(900 + i % 8, 12), prose(2000 + i, 12))) for i in range(40)]
    rows += [(400, None, f"{common}\nx"), (400, None, f"{common}\nx")]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string")
    out = {r["id"]: r for r in judge_documents(df).collect()}
    gone = {i for i, r in out.items() if not r["kept"]}
    assert gone == set(range(100, 105))
    assert all(out[i]["n_removed_words"] == len(common.split()) for i in range(60))
    assert out[400]["kept"] and out[400]["n_removed_words"] == 0  # too few documents of that host
    kept = keep_documents(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - len(gone)


def test_stage_keeps_columns(edge_docs, no_docs):
    kept = keep_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    want = [str(r["doc_id"]) for r in edge_docs.collect() if not base(r["text"])[-1]]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(want)
    assert keep_documents(no_docs).count() == 0
