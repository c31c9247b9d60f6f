import numpy as np

from starloom.llm import embedding_dedup as E


def brute(rows, threshold):
    usable = [
        (i, np.array(v, float) / np.abs(v).max())
        for i, v in rows
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
    ]
    links, at = [], {}
    for n, (i, a) in enumerate(usable):
        at.setdefault(i, []).append(n)
        for m in range(n):
            b = usable[m][1]
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links.append((n, m))
    root = list(range(len(usable)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, m in [*links, *[(k[0], x) for k in at.values() for x in k[1:]]]:
        a, b = find(n), find(m)
        root[max(a, b)] = min(a, b)
    least = {}
    for n, (i, _) in enumerate(usable):
        least[find(n)] = min(least.get(find(n), i), i)
    count = [0] * len(usable)
    for n, m in links:
        count[n] += 1
        count[m] += 1
    told = [(i, count[n], least[find(n)]) for n, (i, _) in enumerate(usable)]
    spare = list(rows)
    for i, v in rows:
        if i is None or not (v and all(c is not None and np.isfinite(c) for c in v) and any(v)):
            told.append((i, 0, i))
    assert len(told) == len(spare)
    return sorted([(str(i), n, str(c), c is None or c == i) for i, n, c in told])


def run(spark, rows, kind="double", **options):
    df = spark.createDataFrame(
        [(i, v, 1, "k", True) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, id int, key string, kept boolean"
    )
    out = E.embedding_near_duplicates(df, **options).collect()
    return sorted((str(r["id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in out)


def clusters(seed, dim, groups, noise):
    rng = np.random.default_rng(seed)
    out = []
    for size in groups:
        centre = rng.standard_normal(dim)
        out += [centre + noise * rng.standard_normal(dim) * rng.random() for _ in range(size)]
    order = rng.permutation(len(out))
    return [(int(i), [float(c) for c in np.float32(out[k])]) for i, k in enumerate(order)]


def test_links_equal_brute_force(spark):
    rows = clusters(5, 24, [1] * 150 + [2, 3, 5, 9, 60, 150], 0.45)
    want = brute(rows, 0.95)
    assert sum(n for _, n, _, _ in want) > 2000
    assert run(spark, rows, "float") == want
    # the same when one bucket is dealt into many cells
    assert run(spark, rows, cell=16) == want


def test_chain_of_vectors_is_one_component(spark):
    rows = [(i + 1, [float(np.cos(0.2 * i / 2)), float(np.sin(0.2 * i / 2)), 0.0]) for i in range(25)]
    assert run(spark, rows) == brute(rows, 0.95)
    assert {c for _, _, c, _ in run(spark, rows)} == {"1"}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [1.0, nan]), (5, [inf, 1.0]),
        (6, [1.0, 0.0]), (7, [1.0, -0.0]), (8, [2e300, 0.0]), (9, [1.0, 0.0, 0.0]),
        (10, [-1.0, 0.0]), (11, [0.0, 3.0]), (11, [0.0, 3.0]), (12, [5.0, 5.0]), (12, [-5.0, 5.0]),
        (None, [1.0, 0.0]), (None, None), (13, [5e-324, 0.0]),
    ]
    got = run(spark, rows)
    assert got == brute(rows, 0.95)
    assert ("6", 3, "6", True) in got and ("8", 3, "6", False) in got
    assert run(spark, []) == []


def test_tables_miss_less_than_asked():
    for n in (2, 500, 10**6, 10**12):
        bits, tables = E.tables_for(n, 0.95)
        agree = 1 - np.arccos(0.95) / np.pi
        assert (1 - agree**bits) ** tables <= E.MISS and bits <= E.MAX_BITS


def test_query_equals_sql_shape(spark):
    out = E.op13_query(spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"] and out.count() == 500
