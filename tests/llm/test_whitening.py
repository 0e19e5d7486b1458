"""Whitening against an eigendecomposition of the exact covariance."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import whitening


def grid_of(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v, "x", 1) for i, v in zip(ids, vectors)]
    return whitening.gridded(spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, component int").repartition(5))


def exact_covariance(xs):
    n, width = len(xs), len(xs[0])
    mean = [Fraction(sum(x[i] for x in xs), n) for i in range(width)]
    return np.array([[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in xs) / n) for j in range(width)] for i in range(width)])


def vectors(seed, n, width, offset=0.0, spread=None):
    rng = random.Random(seed)
    spread = spread or [2.0 ** -(j // 2) * (1 + 0.3 * j) for j in range(width)]
    return [[offset + s * rng.gauss(0, 1) for s in spread] for _ in range(n)]


@pytest.mark.parametrize("offset", [0.0, 3000.0])
def test_components_match_the_exact_covariance(spark, offset):
    made = vectors(1, 160, 7, offset)
    made += made[:40] * 2  # copies count once
    grid = grid_of(spark, made)
    model = whitening.fit(grid)
    xs = sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in made})
    covariance = exact_covariance(xs)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:4]
    assert model.rows == len(xs) == 160
    assert list(model.sums) == [sum(x[i] for x in xs) for i in range(7)]
    np.testing.assert_allclose(model.values, values[order], rtol=1e-11)
    np.testing.assert_allclose(model.shares, values[order] / np.trace(covariance), rtol=1e-11)
    assert model.identity_error < 1e-10
    found = whitening.whitened(grid, model).collect()
    assert len(found) == 4 * len(made)
    n, mean = len(xs), np.array([Fraction(s, len(xs)) for s in model.sums])
    for j in range(4):
        axis = axes[:, order[j]]
        sign = np.sign(axis @ model.basis[:, j])
        for r in found:
            if r["component"] == j + 1:
                x = [math.floor(256 * float(np.float32(c))) for c in made[r["key"]]]
                want = float(np.array([float(a - b) for a, b in zip(x, mean)]) @ axis) / math.sqrt(values[order[j]])
                assert abs(r["whitened"] * sign - want) < 1e-8
                assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, model.sums))


def test_floor_of_the_entries(spark):
    grid = grid_of(spark, [[-0.001, 0.0, -0.0, 0.00390625, 0.0078, -1.0]])
    assert grid.first()["x"] == [-1, 0, 0, 1, 1, -256]


def test_unusable_vectors_are_left_out(spark):
    made = [None, [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [], [1.0], [1.0, 2.0], [3.0, 1.0], [1.0, 2.0]]
    grid = grid_of(spark, made, [None, 1, 2, 3, 4, 5, None, 7, 7])
    assert sorted((r["key"] is None, tuple(r["x"])) for r in grid.collect()) == [
        (False, (256, 512)), (False, (768, 256)), (True, (256, 512)),
    ]
    model = whitening.fit(grid)
    assert model.rows == 2 and list(model.sums) == [1024, 768]
    got = whitening.whitened(grid, model).collect()
    assert len(got) == 6
    # two points lie on a line: the second component has no variance
    assert {r["whitened"] is None for r in got if r["component"] == 2} == {True}
    assert {round(abs(r["whitened"]), 9) for r in got if r["component"] == 1} == {1.0}
    np.testing.assert_allclose(model.shares, [1.0, 0.0], atol=1e-20)


def test_one_vector_has_no_variance(spark):
    grid = grid_of(spark, [[1.0, 2.0, 3.0]] * 3)
    model = whitening.fit(grid)
    got = whitening.whitened(grid, model).collect()
    assert len(got) == 9 and {(r["deviation"], r["whitened"]) for r in got} == {(0, None)}
    assert model.identity_error is None and np.isnan(model.shares).all()


def test_constant_and_dependent_entries(spark):
    made = [[a, 2 * a, 5.0, b, a + b, 0.0] for a, b, *_ in vectors(3, 90, 6)]
    xs = [[math.floor(256 * float(np.float32(c))) for c in v] for v in made]
    model = whitening.fit(grid_of(spark, made))
    values = np.sort(np.linalg.eigvalsh(exact_covariance(sorted({tuple(x) for x in xs}))))[::-1]
    np.testing.assert_allclose(model.values[:4], values[:4], rtol=1e-7)
    assert model.identity_error < 1e-9


def test_spread_over_many_orders_of_magnitude(spark):
    made = vectors(5, 300, 5, 0.0, [4000.0, 300.0, 20.0, 1.0, 0.05])
    model = whitening.fit(grid_of(spark, made))
    xs = sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in made})
    values = np.sort(np.linalg.eigvalsh(exact_covariance(xs)))[::-1]
    np.testing.assert_allclose(model.values, values[:4], rtol=1e-6)
    assert model.identity_error < 1e-8


def test_large_entries_and_exact_long_arithmetic(spark):
    made = [[float(2**40), 1.0], [float(2**40) + 2**18, 2.0], [float(2**40), 3.0]]
    grid = grid_of(spark, made)
    model = whitening.fit(grid)
    xs = [[256 * int(c) for c in v] for v in made]
    assert list(model.sums) == [sum(x[i] for x in xs) for i in range(2)]
    got = {r["key"]: r["deviation"] for r in whitening.whitened(grid, model).collect()}
    assert got == {i: sum((3 * a - s) ** 2 for a, s in zip(x, model.sums)) for i, x in enumerate(xs)}
    beyond = whitening.fit(grid_of(spark, [[3e38, 0.0], [-3e38, 1.0]]))
    assert beyond.rows == 2
    assert {r["deviation"] for r in whitening.whitened(grid_of(spark, [[3e38, 0.0], [-3e38, 1.0]]), beyond).collect()} == {None}


def test_triangular_solve():
    rng = np.random.default_rng(1)
    factor = np.triu(rng.normal(size=(6, 6))) + 3 * np.eye(6)
    rows = rng.normal(size=(20, 6))
    np.testing.assert_allclose(whitening.solved(rows, factor) @ factor, rows, atol=1e-12)


def test_query_and_empty_table(spark, tmp_path):
    got = whitening.op11_whitening(spark, "/root/testdata/sf0.001")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = got.collect()
    assert len(found) == 4 * spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert {r["identity_error"] < 1e-9 for r in found} == {True}
    for c in range(1, 5):
        shares = {r["explained"] for r in found if r["component"] == c}
        assert len(shares) == 1
    empty = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where(F.lit(False))
    empty.write.parquet(str(tmp_path / "embeddings.parquet"))
    assert whitening.op11_whitening(spark, str(tmp_path)).collect() == []
