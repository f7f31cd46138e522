import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurepipe.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def usable(rows):
    return [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def checked(found, rows):
    """Compare the rows of the query with exact sums and double-precision eigenvectors."""
    rows = usable(rows)
    n, dimension = len(rows), len(rows[0][1])
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(column) for column in zip(*x, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums, strict=True)] for row in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    shown = min(32, dimension)
    assert len(found) == n * shown
    assert {row.n for row in found} == {n}
    assert len({row.identity_error for row in found}) == 1 and found[0].identity_error <= 1e-9
    deviations = {(k, sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))) for (k, _), row in zip(rows, x, strict=True)}
    assert {(row.vec_id, row.deviation) for row in found} == deviations
    matrix = np.zeros((n, shown))
    place = {k: i for i, (k, _) in enumerate(rows)}
    for row in found:
        matrix[place[row.vec_id], row.component - 1] = row.whitened
        assert abs(row.explained / (values[row.component - 1] / np.trace(covariance)) - 1) < 1e-10
    expected = centred @ vectors[:, :shown] / np.sqrt(values[:shown])
    signs = np.sign((matrix * expected).sum(axis=0))
    gaps = np.abs(values[:, None] - values[None, :]) + np.eye(dimension) * 1e9
    tolerance = 1e-11 * values[0] / gaps.min(axis=0)[:shown]
    assert (np.abs(matrix - expected * signs).max(axis=0) < np.maximum(tolerance, 1e-10)).all()


def test_given_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    checked(queries.QUERIES["op13_whitening"](spark, sf).collect(), rows)


def whole(frame):
    model = whitening.fit(frame)
    white = whitening.whiten(frame, model)
    return whitening.by_component(white, model, whitening.identity_error(white, model))


@pytest.mark.parametrize("parts", [1, 5])
def test_nulls_non_finite_repeated_and_clashing(spark, parts):
    chance = np.random.default_rng(2)
    rows = [(k, [float(c) for c in chance.normal(size=6).astype(np.float32)]) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(150)]
    rows += [(2000, None), (2001, [None] + [0.5] * 5), (2002, [math.nan] * 6), (2003, [math.inf] + [0.0] * 5), (2004, [-math.inf] * 6)]
    frame = spark.createDataFrame([(*row, 1) for row in rows], SCHEMA).repartition(parts)
    wide = frame.withColumns({name: F.lit("x") for name in ("whitened", "component", "n", "place")})
    checked(whole(wide).collect(), rows)
    # Other lengths than the most frequent are left out.
    other = spark.createDataFrame([(3000, [1.0, 2.0], 1), (3001, [], 1)], SCHEMA)
    checked(whole(frame.unionByName(other)).collect(), rows)


def test_results_do_not_depend_on_the_dealing(spark):
    chance = np.random.default_rng(3)
    frame = spark.createDataFrame([(k, chance.normal(size=5).tolist(), 0) for k in range(500)], SCHEMA)
    one, other = whitening.fit(frame.repartition(1)), whitening.fit(frame.repartition(7))
    assert one.sums == other.sums and (one.vectors == other.vectors).all() and (one.eigenvalues == other.eigenvalues).all()


def test_empty_constant_and_fewer_rows_than_dimensions(spark):
    assert whole(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whole(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).count() == 0
    alone = whole(spark.createDataFrame([(1, [0.5, 0.25], 1)], SCHEMA)).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, None, None, None), (2, 0, None, None, None)]
    few = whole(spark.createDataFrame([(1, [0.5, 0.25, 0.0], 1), (2, [1.5, 0.25, 0.0], 1)], SCHEMA)).collect()
    assert {(r.vec_id, abs(r.whitened)) for r in few if r.component == 1} == {(1, 1.0), (2, 1.0)}
    assert all(r.whitened is None for r in few if r.component > 1)


def test_large_entries_do_not_crash(spark):
    rows = [(k, [3e38 * (k % 2), float(k), 1e5 * k], 1) for k in range(8)]
    found = whole(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 24 and all(row.deviation is None for row in found)


def turned(values, seed=4):
    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    matrix = (basis * values) @ basis.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize("values", [
    np.r_[np.full(20, 5.0), np.full(20, 3.0), np.arange(24) + 10.0],
    np.r_[5 + np.arange(20) * 1e-9, 3 + np.arange(20) * 1e-6, np.arange(24) + 10.0],
    np.r_[5 + np.arange(32) * 1e-13, np.arange(32) + 10.0],
    10.0 ** np.linspace(-9, 6, 40),
    np.r_[np.zeros(30), np.arange(34) + 1.0],
])
def test_refinement_of_clustered_eigenvalues(values):
    matrix = turned(values).astype(np.longdouble)
    found, vectors = whitening.refined_eigen(matrix)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-14 * values.max() * len(values)
    own = vectors.astype(np.longdouble)
    assert np.abs(own.T @ own - np.eye(len(values))).max() < 1e-14
    assert np.abs(matrix @ own - own * found).max() < 1e-15 * len(values) * values.max()


def test_close_eigenvalues_get_their_own_vectors():
    # float32 cannot tell these apart; the vectors are known by construction.
    values = np.r_[5 + np.arange(8) * 1e-8, np.arange(8) + 10.0]
    basis, _ = np.linalg.qr(np.random.default_rng(5).normal(size=(16, 16)))
    high = basis.astype(np.longdouble)
    for _ in range(3):
        high = high + high @ (np.eye(16) - high.T @ high) / 2
    _, vectors = whitening.refined_eigen((high * values) @ high.T)
    likeness = np.abs(vectors.T @ basis[:, np.argsort(-values)])
    assert np.abs(likeness - np.eye(16)).max() < 1e-9
