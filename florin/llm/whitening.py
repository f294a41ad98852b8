"""Embedding whitening by a bidiagonal qd solver.

Every task centres its rows and reduces them block by block to a triangular R; the Rs
are merged in groups of ``FAN_IN`` until one is left, whose task bidiagonalises it, finds
the singular values by dqds and the directions by twisted factorisations (see
``bidiagonal``). The driver gets the column sums, and as many directions as asked for;
what a task holds is bounded by the dimension, not by the number of rows.

The fit list is every distinct vector once, by a shuffle with sums on the map side, so
copies of one vector never come together in more than one row a task.

Defined results: rows with a NULL or empty vector or a NULL or non-finite entry take no
part, nor do rows whose dimension is not that of most distinct vectors (of several, the
largest); repeated rows get equal results, each its own; a direction without variance
(one vector only, or fewer distinct ones than components) is not returned; of equal
eigenvalues any orthonormal directions are; a deviation beyond a long is NULL; a NULL
identifier stays NULL; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.llm.bidiagonal import leading_directions
from florin.llm.shipping import ship_package
from florin.llm.vectors import of_dimension, unpacked, usual_dimension, whole_vectors
from florin.session import cut_lineage

COMPONENTS = 4
BLOCK_ROWS = 4096
FAN_IN = 16


@dataclass
class Whitening:
    """What a fit list of ``n`` vectors with the column sums ``sums`` gives."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the covariance, falling
    directions: np.ndarray  # one unit vector a row
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows x components."""
        return (x - self.mean) @ (self.directions / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n x - sum)^2 of every row; None beyond a long."""
        if not len(x):
            return []
        largest = self.n * int(np.abs(x).max()) + max(map(abs, self.sums))
        if largest**2 * x.shape[1] < 2**63:
            return ((self.n * x - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [v if v < 2**63 else None for v in exact]


def _column_sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums; halves of 32 bits keep a batch's sums within 64."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for batch in batches:
            x = unpacked(batch.column("x"), dimension)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dimension, n)), pa.array(np.arange(dimension)), pa.array(high), pa.array(low)],
            names=["n", "place", "high", "low"],
        )

    per_task = fit.select("x").mapInArrow(partial, "n long, place long, high long, low long")
    exact = (F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low"))
    rows = per_task.groupBy("place").agg(*exact).orderBy("place").collect()
    return int(rows[0]["n"]), [int(r["high"]) * 2**32 + int(r["low"]) for r in rows]


def _triangle(rows: np.ndarray, dimension: int) -> np.ndarray:
    """R of the rows, square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((dimension - len(r), dimension))]) if len(r) < dimension else r


def _triangles(fit: DataFrame, dimension: int, mean: np.ndarray) -> DataFrame:
    """(part, r): of every task with rows one triangle of its centred rows."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                x = unpacked(batch.column("x")[first : first + BLOCK_ROWS], dimension) - mean
                r = _triangle(x if r is None else np.vstack([r, x]), dimension)
        if r is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["part", "r"]
            )

    return fit.select("x").mapInArrow(reduce, "part long, r binary")


def _directions(triangles: DataFrame, parts: int, dimension: int, count: int) -> list:
    """(component, value, total, direction) of the whole fit list, values not yet divided by its size."""

    def merged(group: pa.Table) -> np.ndarray:
        r = None
        for one in group.column("r").to_pylist():
            block = np.frombuffer(one).reshape(dimension, dimension)
            r = block if r is None else _triangle(np.vstack([r, block]), dimension)
        return r

    def merge(group: pa.Table) -> pa.Table:
        return pa.table({"part": group.column("part")[:1], "r": pa.array([merged(group).tobytes()], pa.binary())})

    def solve(group: pa.Table) -> pa.Table:
        values, directions, total = leading_directions(merged(group), count)
        return pa.table(
            {
                "component": pa.array(range(1, len(values) + 1), pa.int32()),
                "value": pa.array(values, pa.float64()),
                "total": pa.array([total] * len(values), pa.float64()),
                "direction": pa.array(list(directions), pa.list_(pa.float64())),
            }
        )

    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        grouped = triangles.select((F.col("part") / FAN_IN).cast("long").alias("part"), "r")
        triangles = grouped.groupBy("part").applyInArrow(merge, "part long, r binary")
    last = triangles.select(F.lit(0).cast("long").alias("part"), "r").groupBy("part")
    found = last.applyInArrow(solve, "component int, value double, total double, direction array<double>")
    return sorted(found.collect(), key=lambda r: r["component"])


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, dimension = len(model.values), len(model.sums)
    shared = fit.sparkSession.sparkContext.broadcast(model)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            z = shared.value.whitened(unpacked(batch.column("x"), dimension))
            total += np.column_stack([z.T @ z, z.sum(axis=0)])
        at = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total.ravel())], names=["i", "j", "s"])

    summed = fit.select("x").mapInArrow(products, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    total = np.zeros((k, k + 1))
    for row in summed.collect():
        total[row["i"], row["j"]] = row["s"]
    mean = total[:, k] / model.n
    return float(np.abs(total[:, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors among ``vectors`` (x, packed); None where no direction has variance."""
    fit = cut_lineage(vectors.select("x").distinct())
    dimension = usual_dimension(fit)
    if not dimension:
        return None
    parts, fit = fit.rdd.getNumPartitions(), of_dimension(fit, dimension)
    n, sums = _column_sums(fit, dimension)
    rows = _directions(_triangles(fit, dimension, np.array([s / n for s in sums])), parts, dimension, components)
    if not rows:
        return None
    value, total = np.array([r["value"] for r in rows]), rows[0]["total"]
    model = Whitening(n, sums, value / n, np.array([r["direction"] for r in rows]), value / total, 0.0)
    model.identity_error = _identity_error(fit, model)
    return model


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def embedding_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row that takes part."""
    spark = embeddings.sparkSession
    ship_package(spark)
    vectors = whole_vectors(embeddings, ["vec_id"])
    schema = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, {RESULT}"
    model = fit_whitening(vectors, components)
    if model is None:
        return spark.createDataFrame([], schema)
    dimension, shared = len(model.sums), spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.values)
        for batch in batches:
            x = unpacked(batch.column("x"), dimension)
            rows = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(rows),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(rows),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(x) * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return of_dimension(vectors, dimension).mapInArrow(project, schema)
