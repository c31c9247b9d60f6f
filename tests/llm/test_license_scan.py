import re

from starloom.llm.license_scan import PHRASES, TEMPLATES, scan_licenses

FILL = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor "


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    w, found = words(text), []
    for phrase, label in PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in found]
    labels = ",".join(sorted({x for _, x in found}))
    return len(w), len(found), min(at, default=None), max(at, default=None), labels


FIELDS = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def check(df):
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    out = scan_licenses(df).collect()
    assert len(out) == df.count()
    for r in out:
        assert tuple(r[f] for f in FIELDS) == base(texts[r["id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    return {r["id"]: r for r in out}


def test_notices_are_found_whole_edited_and_twice(spark):
    rows = []
    for n, (_, text) in enumerate(TEMPLATES):
        rows.append((n, FILL + text.upper().replace(" ", "\n ") + ". " + FILL))
    mit = TEMPLATES[1][1]
    rows.append((100, FILL + mit.replace("free of charge", "wholly free of any charge") + FILL + mit))
    rows.append((101, FILL + mit[: len(mit) // 3] + " " + FILL))
    rows.append((102, "MIT-License, apache license; General\tPublic  License. MIT license"))
    rows.append((103, FILL * 30))
    out = check(spark.createDataFrame(rows, "doc_id int, text string"))
    for n, (label, text) in enumerate(TEMPLATES):
        assert label in out[n]["labels"].split(",") and out[n]["score"] == 1.0
        span = [s for s in out[n]["spans"] if s["label"] == label and s["cover"] == 1.0][0]
        first = len(words(FILL))
        assert span["first"] >= first and span["last"] < first + len(words(text))
    assert out[100]["labels"] == "mit" and len(out[100]["spans"]) == 2
    assert out[101]["labels"] == "" and out[101]["spans"] == []
    assert out[102]["base_labels"] == "apache,gpl,mit" and out[102]["n_base"] == 4
    assert out[103]["labels"] == "" and out[103]["score"] == 0.0


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    assert scan_licenses(no_docs).count() == 0
