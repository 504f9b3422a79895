"""Whitening against a dense eigensolver, exact search against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import compare, duck
from transferlens.llm import queries, vafile, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, component string, score string"


def frame(spark, rows, parts=3):
    floats = [(k, v and [None if x is None else float(x) for x in v], "clash", "clash") for k, v in rows]
    return spark.createDataFrame(floats, SCHEMA).repartition(parts)


def usable(rows, size):
    return [(k, np.float32(v).astype(float)) for k, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]


def noisy_rows(n, size, seed, tilt=0.2):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, size)) * (1 + tilt * np.arange(size)[::-1] / size) @ np.linalg.qr(rng.standard_normal((size, size)))[0] * 0.1
    rows = [(int(k), [float(y) for y in v]) for k, v in enumerate(x)]
    return [*rows, rows[3], (3, rows[4][1]), (None, rows[5][1]), (5000, None), (5001, [None] * size), (5002, [math.nan] + [0.0] * (size - 1)), (5003, [1.0]), (5004, [])]


# ---- whitening ---------------------------------------------------------------------------------


def dense(rows, size, components=8):
    x = np.array([np.floor(1024 * v).astype(np.int64) + 100_000 for _, v in usable(rows, size)])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    order = [k for k in np.argsort(-values)[:components] if values[k] > 1e-10 * values.max()]
    return x, n, sums, centred @ turn[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize(("n", "size"), [(400, 64), (200, 5), (6, 64)])
def test_whitening_equals_dense_eigenvectors(spark, n, size):
    rows = noisy_rows(n, size, seed=n + size)
    x, count, sums, white, explained = dense(rows, size)
    out = whitening.whitened(frame(spark, rows)).toPandas()
    assert len(out) == white.size and set(out["n"]) == {count} and (out["identity_error"] <= 1e-6).all()
    assert np.allclose(out.groupby("component")["explained"].first(), explained, rtol=1e-9)
    lines = {}
    for (vec_id, deviation), group in out.groupby(["vec_id", "deviation"], dropna=False):
        lines[None if vec_id != vec_id else int(vec_id), int(deviation)] = group.drop_duplicates("component").sort_values("component")["whitened"].tolist()
    got = np.array([lines[k, int(((count * r - sums) ** 2).sum())] for (k, _), r in zip(usable(rows, size), x, strict=True)])
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < 1e-7


def test_whitening_without_variance(spark):
    for rows in ([], [(1, None)], [(k, [0.5, 0.25]) for k in range(9)], [(1, [])]):
        assert whitening.whitened(frame(spark, rows)).collect() == []


def test_equal_eigenvalues_are_certified(spark):
    size = 40  # signed unit vectors: the covariance is a multiple of the identity
    rows = [(2 * k + (s > 0), [s * (j == k) * 1.0 for j in range(size)]) for k in range(size) for s in (-1, 1)]
    out = whitening.whitened(frame(spark, rows)).toPandas()
    assert len(out) == len(rows) * 8 and (out["identity_error"] < 1e-9).all() and np.allclose(out["explained"], 1 / size)


def test_a_first_block_without_the_leading_vector_is_not_certified():
    """The leading direction is missing from the block and comes in with the fresh directions."""
    values = np.concatenate([[50.0], np.linspace(10, 1, 59)])

    class Spans:
        def __call__(self, q):
            return values[:, None] * q

    rng = np.random.default_rng(1)
    q = np.concatenate([np.zeros((1, 24)), rng.standard_normal((59, 24))])
    found, vectors_, product = whitening.rayleigh_ritz(Spans(), q)
    for _ in range(12):
        y = whitening.chebyshev(Spans(), vectors_, product, 0.5, found[-1], found[0], 10)
        found, vectors_, product = whitening.rayleigh_ritz(Spans(), np.where(np.arange(60)[:, None] == 0, 0, y))
    assert np.linalg.norm(product[:, 0] - vectors_[:, 0] * found[0]) < 1e-9 and found[0] == pytest.approx(10)
    fresh = np.concatenate([vectors_[:, :16], rng.standard_normal((60, 8))], axis=1)
    found, vectors_, product = whitening.rayleigh_ritz(Spans(), fresh)
    y = whitening.chebyshev(Spans(), vectors_, product, 0.5, found[-1], found[0], 10)
    assert whitening.rayleigh_ritz(Spans(), y)[0][0] > 49


def test_lanczos_bounds_the_spectrum_from_below():
    rng = np.random.default_rng(2)
    for low in (0.0, 3.0, 14.0):
        values = rng.uniform(low, 16.0, 64)
        bound = whitening.lower_bound(lambda v, d=values: d[:, None] * v, 64, 12, rng)
        assert 0 <= bound <= values.min() + 0.5


def test_exact_deviations_beyond_64_bits():
    x = np.array([[1 << 61, 5], [-(1 << 61), 7], [3, -9]])
    sums = [int(s) for s in x.astype(object).sum(axis=0)]
    want = [min(sum((3 * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)), (1 << 63) - 1) for row in x]
    assert whitening.deviations(x, 3, sums).tolist() == want
    assert [int(s) for s in whitening._exact_sums(np.array([[1 << 62], [1 << 62], [1 << 62]]))] == [3 << 62]


def test_dimension_is_the_commonest(spark):
    assert vectors.dimension(frame(spark, [(1, [1.0]), (2, [1.0, 2.0]), (3, [3.0, 4.0]), (4, None)]), "embedding") == 2
    assert vectors.dimension(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]), "embedding") == 2
    assert vectors.dimension(frame(spark, []), "embedding") == 0


# ---- exact search ------------------------------------------------------------------------------


def all_scores(rows, size, each=50, k=5):
    own = sorted({(i, tuple(int(c) for c in np.floor(256 * v))) for i, v in usable(rows, size) if i is not None})
    out = []
    for query, q in own:
        if query % each == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in own if i != query)[:k]
            out += [(query, place + 1, i, -s) for place, (s, i) in enumerate(best)]
    return sorted(out)


def searched(spark, rows, **settings):
    out = vafile.search(frame(spark, rows), F.col("vec_id") % 50 == 0, **settings)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())


@pytest.mark.parametrize("bits", [1, 4, 6])
def test_search_equals_all_scores(spark, bits):
    rows = noisy_rows(420, 16, seed=bits)
    assert searched(spark, rows, bits=bits, query_bytes=16 * 8 * 3) == all_scores(rows, 16)


def test_search_with_ties_copies_and_zeros(spark):
    rng = random.Random(4)
    some = [[rng.choice([-1.0, 0.0, 1.0]) for _ in range(6)] for _ in range(40)]
    rows = [(k, [0.5] * 6 if k % 3 == 0 else rng.choice(some)) for k in range(400)] + [(450, [0.0] * 6), (500, [0.0] * 6), (451, [0.0] * 6)]
    rows += [(50, [9.0] * 6), (50, [0.5] * 6), (400, [1e9, 0, 0, 0, 0, 1.0])]
    assert searched(spark, rows) == all_scores(rows, 6)


def test_search_of_few_rows(spark):
    assert searched(spark, []) == [] and searched(spark, [(1, [1.0])]) == [] and searched(spark, [(50, [1.0])]) == []
    rows = [(50, [1.0, 2.0]), (100, [2.0, -1.0]), (3, [0.0, 1.0]), (None, [9.0, 9.0])]
    assert searched(spark, rows) == all_scores(rows, 2)


def test_marks_hold_all_values_and_bounds_all_scores(spark):
    rows = noisy_rows(300, 8, seed=9)
    entries = vafile.entries_of(vafile.rows_of(frame(spark, rows), 8), 6).cache()
    marks = vafile.marks_of(entries, 8, 300, bits=3, sample=40)
    x = np.array([np.frombuffer(r["v"], np.int64) for r in entries.orderBy("key").collect()])
    assert (np.diff(marks, axis=1) >= 0).all() and (x >= marks[:, 0]).all() and (x < marks[:, -1]).all()
    query = x[:7].astype(float)
    cells = vafile.cells_of(entries.orderBy("key").coalesce(1), 8, marks).toArrow().to_batches()
    for part in cells:
        for at, keys, _, low, high in vafile._bounds(part, marks, query):
            order = {k: n for n, k in enumerate(sorted(r["key"] for r in entries.collect()))}
            exact = query[at : at + len(low)] @ x[[order[k] for k in keys]].T
            assert (low <= exact).all() and (exact <= high).all()


def test_scores_beyond_64_bits_are_exact_in_order(spark):
    rows = [(0, [3e18 / 256] * 4), (1, [2e18 / 256] * 4), (2, [1e18 / 256] * 4), (3, [-1e18 / 256] * 4), (4, [1.0] * 4)]
    out = searched(spark, rows)
    top = (1 << 63) - 1
    assert [r[2:] for r in out][:2] == [(1, top), (2, top)] and out[-1][2:] == (3, -top - 1)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), folder, "op12_exact_search", queries.QUERIES, queries.CHECKS) is None
