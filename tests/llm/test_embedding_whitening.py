import numpy as np
import pytest

from starloom.llm import embedding_whitening as W


def random_symmetric(values, seed=1):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [3.0, 3.0],
        list(np.linspace(1, 50, 40)),
        [100.0] * 6 + [99.999999] * 3 + [7.0] * 20,
        [1e12, 1e6, 1.0, 1e-3] + [0.5] * 10,
        [9.0, 4.0] + [0.0] * 12,
    ],
)
def test_eigenvalues_and_vectors(values):
    a = random_symmetric(values)
    got, vectors = W.leading_components(a, 12)
    want = np.sort([v for v in values if v > len(values) * W.EPS * max(values)])[::-1][:12]
    assert len(got) >= len(want) and np.allclose(got[: len(want)], want, rtol=1e-12, atol=1e-14 * max(values) * len(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * got).max() < 1e-13 * len(values) * max(values)


def test_diagonal_and_split_matrices():
    a = np.diag([4.0, 4.0, 4.0, 1.0, 0.0])
    a[3, 4] = a[4, 3] = 0.5
    got, vectors = W.leading_components(a, 5)
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1][: len(got)])
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12


def brute(vectors, components):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    v = (y - y.mean(axis=0)).T @ (y - y.mean(axis=0)) / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return n, deviation, y @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


def test_equals_numpy_and_drops_unusable_rows(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12))
    good[::3, 0] += 40  # a hot direction
    good[10:40] = good[9]
    bad = [None, [], [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [float("-inf")] * 12, [1e300] * 12, [1.0, 2.0]]
    rows = [(i, [float(c) for c in v], 1, 2) for i, v in enumerate(good)]
    rows += [(900 + i, v, 1, 2) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n int, component int").repartition(5)
    got = W.whiten(df, components=7).collect()
    n, deviation, white, explained = brute([v for _, v, *_ in rows[:300]], 7)
    assert len(got) == 300 * 7 and {r["n"] for r in got} == {n}
    table = np.zeros((300, 7))
    for r in got:
        table[r["id"], r["component"] - 1] = r["whitened"]
        assert int(r["deviation"]) == deviation[r["id"]]
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table - signs * white).max() < 1e-6
    centred = table - table.mean(axis=0)
    assert np.abs(centred.T @ centred / 300 - np.eye(7)).max() < 1e-9


def test_deviation_is_exact_beyond_longs():
    x = np.array([[2**47, 5], [-(2**47), 7]])
    centre = W.Centre(10**6, np.array([3, 4]), np.array([11, 999_999]))
    want = [sum((10**6 * (int(a) - w) - r) ** 2 for a, w, r in zip(row, (3, 4), (11, 999_999), strict=True)) for row in x]
    assert [None if w >= 10**38 else w for w in want] == [None if d is None else int(d) for d in centre.deviations(x).to_pylist()]


def test_edges(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    line = W.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (2, [2.0, 4.0]), (2, [2.0, 4.0])], schema)).collect()
    assert [r["component"] for r in line] == [1, 1, 1] and {r["n"] for r in line} == {3}
    assert abs(line[0]["explained"] - 1) < 1e-12


def test_query(spark):
    out = W.op11_query(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes)["deviation"] == "bigint" and out.count() == 500 * 32
