"""Embedding whitening against dense linear algebra."""

import math

import numpy as np
import pytest

from florin.llm import whitening
from florin.llm.bidiagonal import bidiagonalised, leading_directions, squared_singular_values
from florin.llm.vectors import whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, kind="float"):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA.replace("float", kind))


def assert_plain(spark, vectors, kind="float"):
    """The contract by numpy's symmetric eigensolver."""
    found = whitening.embedding_whitening(frame(spark, vectors, kind)).collect()
    held = {i: [math.floor(256 * (float(np.float32(c)) if kind == "float" else c)) for c in v] for i, v in vectors if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)}
    fit = np.array(sorted({tuple(v) for v in held.values()}), dtype=float)
    n, total = len(fit), [sum(int(r[j]) for r in fit) for j in range(fit.shape[1])]
    centred = fit - fit.mean(axis=0)
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(4, int((value > value[0] * 1e-12).sum()))
    assert sorted((r["vec_id"], r["component"]) for r in found) == sorted((i, c) for i in held for c in range(1, k + 1))
    sign = {}
    for r in found:
        x, j = held[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, total, strict=True))
        assert r["explained"] == pytest.approx(value[j] / value.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
        want = float((np.array(x) - fit.mean(axis=0)) @ vector[:, j] / math.sqrt(value[j]))
        if abs(want) > 1e-3:
            sign.setdefault(j, math.copysign(1, want * r["whitened"]))
        assert r["whitened"] == pytest.approx(sign.get(j, 1) * want, abs=1e-7)


def test_random_rows_copies_and_gaps(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(300, 12)) * np.linspace(3, 0.2, 12)
    rows = [(i, v) for i, v in enumerate(base)] + [(1000 + i, base[7]) for i in range(200)]
    rows += [(2000, None), (2001, [None] * 12), (2002, [math.nan] * 12), (2003, [math.inf] + [0.0] * 11), (2004, [])]
    assert_plain(spark, rows)


@pytest.mark.parametrize("dimension,n", [(1, 5), (2, 3), (3, 2), (70, 40)])
def test_few_rows_or_dimensions(spark, dimension, n):
    rng = np.random.default_rng(dimension)
    assert_plain(spark, list(enumerate(rng.normal(size=(n, dimension)) * 5)), "double")


def test_nothing_to_whiten(spark):
    assert whitening.embedding_whitening(frame(spark, [])).collect() == []
    assert whitening.embedding_whitening(frame(spark, [(1, None), (2, [math.nan])])).collect() == []
    assert whitening.embedding_whitening(frame(spark, [(1, [1, 2]), (2, [1, 2])])).collect() == []


def test_other_dimensions_take_no_part(spark):
    found = whitening.embedding_whitening(frame(spark, [(1, [1, 2]), (2, [2, 5]), (3, [0, 1]), (4, [1, 2, 3])])).collect()
    assert {r["vec_id"] for r in found} == {1, 2, 3}


def test_extra_columns_and_missing_identifiers(spark):
    rng = np.random.default_rng(1)
    rows = [(None if i % 3 == 0 else i, [float(c) for c in v], "x") for i, v in enumerate(rng.normal(size=(30, 4)))]
    found = whitening.embedding_whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string"))
    assert found.count() == 120 and found.where("vec_id IS NULL").count() == 40


def test_deviations_are_exact_or_null():
    model = whitening.Whitening(10**6, [3, -5], np.ones(1), np.ones((1, 2)), np.ones(1), 0.0)
    x = np.array([[2000, -2000], [1, 1], [2**50, 0]])
    assert model.deviations(x) == [
        (2 * 10**9 - 3) ** 2 + (5 - 2 * 10**9) ** 2, (10**6 - 3) ** 2 + (10**6 + 5) ** 2, None,
    ]


def test_whole_entries(spark):
    rows = frame(spark, [(1, [0.1, -0.1]), (2, [-0.0, 1e30])], "double")
    found = {r["vec_id"]: np.frombuffer(bytes(r["x"]), "<i8").tolist() for r in whole_vectors(rows, ["vec_id"]).collect()}
    assert found[1] == [25, -26] and found[2][0] == 0 and found[2][1] > 2**62


@pytest.mark.parametrize("case", ["random", "graded", "clustered", "equal", "blocks", "singular"])
def test_solver(case):
    """Values to nearly full relative accuracy, orthonormal directions with small residuals."""
    rng = np.random.default_rng(5)
    d = 24
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    values = {
        "random": np.sort(rng.uniform(1, 9, d))[::-1], "graded": 10.0 ** -np.arange(d), "clustered": np.repeat([5.0, 5.0 - 1e-13, 2.0], 8),
        "equal": np.ones(d), "blocks": np.ones(d), "singular": np.array([4.0, 3.0] + [0.0] * (d - 2)),
    }[case]
    a = np.diag(values) if case == "blocks" else np.linalg.qr(rng.normal(size=(40, d)))[0] @ np.diag(values) @ q.T
    r = np.linalg.qr(a, mode="r")
    diagonal, off, _ = bidiagonalised(r)
    got = squared_singular_values(diagonal, off)
    assert np.allclose(np.sqrt(got), np.linalg.svd(np.diag(diagonal) + np.diag(off, 1), compute_uv=False), rtol=1e-10, atol=1e-15 * values[0])
    chosen, directions, total = leading_directions(r, 4)
    assert total == pytest.approx((values**2).sum()) and len(chosen) == (2 if case == "singular" else 4)
    assert np.abs(directions @ directions.T - np.eye(len(chosen))).max() < 1e-10
    assert np.abs(directions @ (r.T @ r) - chosen[:, None] * directions).max() < 1e-10 * values[0] ** 2


def test_graded_values_are_accurate_relatively():
    """The smallest of values over twenty orders keeps its digits."""
    diagonal, off = 10.0 ** -np.arange(0.0, 20.0), 10.0 ** -np.arange(1.0, 20.0)
    got = np.sqrt(squared_singular_values(diagonal, off))
    assert np.prod(got) == pytest.approx(np.prod(diagonal), rel=1e-12)


def test_merging_of_many_triangles(spark):
    """More tasks than one merge takes."""
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(900, 3)) * [5, 3, 1])]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert_plain(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
