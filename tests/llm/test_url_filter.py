import re

import pytest

from starloom.llm.url_filter import RULES, build_cascade, filter_urls

URLS = [
    "https://A.Example.COM/en/x?utm_source=a#b", "http://www.example.com/en/", "http://x.com", "http://x.com/",
    "https://b.net/es/1", "https://b.net/fr", "https://b.net/fr/2#x", "ftp://c.org/p?x://y", "no scheme", "", None,
    "http://notexample.com/en/z", "://h/p", "http://c.org#f/", "http://É.org/a\nb", "http://c.org/p",
]


def split(url):
    rest = (url or "").partition("://")[2]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def brute(url, listed):
    host, path = split(url)
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return (host, path, *max(fits, key=lambda f: len(f[0])))
    return host, path, None, "block" if host + path in listed else "allow"


@pytest.mark.parametrize("options", [{}, {"literal_bytes": 0, "keys_per_segment": 40}, {"keys_per_segment": 40, "bits_per_key": 3, "hashes": 2}])
def test_verdicts_are_exact(spark, options):
    urls = URLS + [f"http://h{i % 90}.org/{i}" for i in range(900)]
    listed = {f"h{i % 90}.org/{i}" for i in range(0, 900, 7)} | {"c.org/p", "never/seen"}
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)], "page_id int, url string, host string, key string")
    keys = spark.createDataFrame([(k,) for k in [*listed, None, "c.org/p"]], "key string")
    out = filter_urls(pages, keys, **options).collect()
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}
    assert len(out) == len(urls)
    assert got == {i: brute(u, listed) for i, u in enumerate(urls)}


def test_empty_list_and_table(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, None)], "page_id int, url string")
    none = spark.createDataFrame([], "key string")
    assert [r["verdict"] for r in filter_urls(pages, none).collect()] == ["allow"] * 3
    assert filter_urls(pages.limit(0), none).count() == 0


def test_mistakes_shrink_from_level_to_level(spark):
    keys = spark.range(20_000).selectExpr("cast(id as string) as key", "id % 5 = 0 as listed")
    cascade = build_cascade(keys)
    assert 2 <= len(cascade.widths) <= 12 and cascade.widths[-1] < cascade.widths[0] / 20
    asked = cascade.attach(keys, keys["key"])
    assert asked.filter(cascade.listed() != asked["listed"]).count() == 0


@pytest.mark.parametrize("literal_bytes", [4 << 20, 0])
def test_no_row_parses_the_filter(spark, literal_bytes):
    keys = spark.range(3_000).selectExpr("cast(id as string) as key", "id % 5 = 0 as listed")
    cascade = build_cascade(keys, keys_per_segment=40, literal_bytes=literal_bytes)
    assert cascade.segments == 15
    asked = cascade.attach(keys, keys["key"]).select("listed", cascade.listed().alias("found"))
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    # a string of many segments was split and cast again for every row
    assert "split(" not in plan and plan.count("Join ") == 1
    assert asked.filter("listed != found").count() == 0
