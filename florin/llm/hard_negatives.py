"""Hard-negative mining by a BOND vertical scan.

Rows are held block by block as columns, one per dimension. For an anchor the columns are
read in falling order of the anchor's magnitudes; what the columns not yet read can add
lies between bounds from each column's least and largest entry, so that after a few
columns most rows are known not to matter and leave the block's bitmap. The first scan
finds the best rows of the anchor's label, the second, for every window below one of
their scores, the best rows of other labels. Scores are exact whole numbers.

Anchors go to the tasks in batches of at most ``ANCHOR_BYTES``; every batch is scanned
against all rows where they lie, and each task returns its best few rows per anchor and
window, of which window functions keep the best of all. No two rows are ever paired
outside a block's scan, and labels play no part in how rows are dealt, so one label,
vector or identifier may hold any share of them.

Defined results: rows with a NULL label, a NULL or empty vector or a NULL or non-finite
entry take no part, nor do rows whose dimension is not that of most rows (of several, the
largest); ties go to the smaller identifier, NULL after all others; repeated rows are
rows of their own: a copy of an anchor is one of its positives; an anchor whose windows
hold no row gives none; other columns do not matter; an empty table gives no rows.
Entries beyond 64 bits become the largest of their sign; a score beyond a long fails the
run instead of wrapping.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from florin.llm.shipping import ship_package
from florin.llm.vectors import of_dimension, unpacked, usual_dimension, whole_vectors
from florin.session import cut_lineage

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score in per cent of the positive's
ANCHOR_BYTES = 16 << 20  # of anchors broadcast at a time
BLOCK_ROWS = 8192
BLOCK_BYTES = 32 << 20
TASK_ROWS = 65_536
FEW_ROWS = 1024  # a task gets at least so many
STEPS = (8, 8, 16)  # columns read between two looks at the bounds; then 32 at a time


class Block:
    """Rows as columns, ordered by label and identifier."""

    def __init__(self, x: np.ndarray, label: np.ndarray, identifier: np.ndarray, nameless: np.ndarray, row: np.ndarray):
        order = np.lexsort((row, identifier, nameless, label))
        # Doubles add whole numbers exactly while every sum stays below 2^53.
        self.columns = np.ascontiguousarray(x[order].T)
        self.label, self.row = label[order], row[order]
        self.identifier, self.nameless = identifier[order], nameless[order]
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def of_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, side="right")))

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, alive: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the rows in ``bitmap`` that ``alive(lower, upper)`` leaves in it to the end."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        sides = np.sort(np.stack([anchor * self.least, anchor * self.most]), axis=0)[:, order]
        rest = np.cumsum(sides[:, ::-1], axis=1)[:, ::-1]
        at, partial, first = np.flatnonzero(bitmap), None, 0
        while first < len(order) and len(at):
            step = STEPS[min(len(STEPS) - 1, first // 8)] if first < 32 else 32
            dims = order[first : first + step]
            first += len(dims)
            added = anchor[dims] @ (self.columns[dims] if len(at) == len(bitmap) else self.columns[np.ix_(dims, at)])
            partial = added if partial is None else partial + added
            low, high = (rest[0, first], rest[1, first]) if first < len(order) else (0, 0)
            left = alive(partial + low, partial + high)
            at, partial = at[left], partial[left]
        return at, partial if partial is not None else np.zeros(0)

    def best(self, at: np.ndarray, score: np.ndarray, count: int) -> list[tuple]:
        """The best rows as (-score, nameless, identifier, row)."""
        if len(at) > count:
            # All ties of the last one take part.
            near = score >= np.partition(score, len(score) - count)[len(score) - count]
            at, score = at[near], score[near]
        order = np.lexsort((self.row[at], self.identifier[at], self.nameless[at], -score))[:count]
        return [
            (-int(score[i]), bool(self.nameless[at[i]]), int(self.identifier[at[i]]), int(self.row[at[i]])) for i in order
        ]


def _kth(values: np.ndarray, count: int) -> float:
    """The count-th largest, below all numbers where there are fewer."""
    return np.partition(values, len(values) - count)[len(values) - count] if len(values) >= count else -np.inf


def _merged(old: list[tuple], new: list[tuple], count: int) -> list[tuple]:
    return sorted(old + new)[:count]


@dataclass
class Anchors:
    """A batch of anchors; ``windows`` are the score ranges (positive's score, low, high) of each."""

    row: np.ndarray
    label: np.ndarray
    x: np.ndarray
    windows: list[list[tuple[int, int, int]]] = field(default_factory=list)


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int, anchors: Anchors) -> Iterator[tuple[Block, np.ndarray]]:
    """Blocks of the rows, with the anchors in the same kind of number."""
    height = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dimension)))
    largest = int(np.abs(anchors.x).max(initial=0))
    for batch in batches:
        for first in range(0, batch.num_rows, height):
            part = batch.slice(first, height)
            x = unpacked(part.column("x"), dimension)
            kind = float if largest * int(np.abs(x).max()) * dimension < 2**53 else object
            identifier = part.column("vec_id")
            yield (
                Block(
                    x.astype(kind),
                    part.column("label").to_numpy(),
                    identifier.fill_null(0).to_numpy(zero_copy_only=False),
                    identifier.is_null().to_numpy(zero_copy_only=False),
                    part.column("row").to_numpy(),
                ),
                anchors.x.astype(kind),
            )


FOUND = "anchor_row long, window long, score long, vec_id long, row long"


def _rows(found: list[tuple[int, int, list[tuple]]]) -> pa.RecordBatch:
    """(anchor's row, window, best rows) as Arrow rows."""
    flat = [(a, w, -s, None if nameless else i, r) for a, w, best in found for s, nameless, i, r in best]
    columns = zip(*flat, strict=True) if flat else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_row", "window", "score", "vec_id", "row"])


def positives_in(batches: Iterator[pa.RecordBatch], dimension: int, anchors: Anchors, count: int) -> Iterator[pa.RecordBatch]:
    """The task's best rows of each anchor's label, without the anchor."""
    best: list[list[tuple]] = [[] for _ in anchors.row]
    for block, own in _blocks(batches, dimension, anchors):
        for i, anchor in enumerate(own):
            same = block.of_label(anchors.label[i])
            bitmap = np.zeros(len(block.row), bool)
            bitmap[same] = block.row[same] != anchors.row[i]
            so_far = -best[i][-1][0] if len(best[i]) == count else -np.inf
            at, score = block.scan(
                anchor, bitmap, lambda low, high, t=so_far: high >= max(t, _kth(low, count))
            )
            best[i] = _merged(best[i], block.best(at, score, count), count)
    yield _rows([(int(r), 0, b) for r, b in zip(anchors.row, best, strict=True)])


def negatives_in(batches: Iterator[pa.RecordBatch], dimension: int, anchors: Anchors, count: int) -> Iterator[pa.RecordBatch]:
    """The task's best rows of other labels in each of an anchor's windows."""
    best: list[list[list[tuple]]] = [[[] for _ in w] for w in anchors.windows]
    for block, own in _blocks(batches, dimension, anchors):
        for i, anchor in enumerate(own):
            windows = anchors.windows[i]
            if not windows:
                continue
            bitmap = np.ones(len(block.row), bool)
            bitmap[block.of_label(anchors.label[i])] = False
            # The worst of the best so far, or the window's lower end.
            floors = [max(w[1], -b[-1][0]) if len(b) == count else w[1] for w, b in zip(windows, best[i], strict=True)]
            at, score = block.scan(anchor, bitmap, lambda low, high, f=floors, w=windows: _may_count(low, high, w, f, count))
            for j, (_, low, high) in enumerate(windows):
                inside = (score >= low) & (score <= high)
                best[i][j] = _merged(best[i][j], block.best(at[inside], score[inside], count), count)
    found = zip(anchors.row, anchors.windows, best, strict=True)
    yield _rows([(int(r), w[0], b) for r, windows, each in found for w, b in zip(windows, each, strict=True)])


def _may_count(low: np.ndarray, high: np.ndarray, windows: list, floors: list, count: int) -> np.ndarray:
    """Which rows may be among the best of a window, whatever the columns not yet read add."""
    alive = np.zeros(len(low), bool)
    near = np.flatnonzero((high >= min(floors)) & (low <= max(w[2] for w in windows)))
    low, high = low[near], high[near]
    for (_, _, top), least in zip(windows, floors, strict=True):
        sure = low[(low >= least) & (high <= top)]
        alive[near] |= (high >= max(least, _kth(sure, count))) & (low <= top)
    return alive


def _best_of_all(found: DataFrame, count: int) -> DataFrame:
    """Of every anchor and window the best rows of all tasks, with their rank."""
    order = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _windows(positives: pa.Table, rows: np.ndarray, low: int, high: int) -> list[list[tuple[int, int, int]]]:
    """For every anchor its different positive scores with the least and largest score of a negative."""
    scores: dict[int, set[int]] = {}
    for row, score in zip(positives.column("anchor_row").to_pylist(), positives.column("score").to_pylist(), strict=True):
        scores.setdefault(row, set()).add(score)
    ranges = [[(s, -(-low * s // 100), high * s // 100) for s in sorted(scores.get(row, ()))] for row in rows.tolist()]
    return [[w for w in each if w[1] <= w[2]] for each in ranges]


def mined(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and embedding, all as they count; ``is_anchor`` says which are anchors.
    """
    spark = rows.sparkSession
    ship_package(spark)
    chosen = rows.where(F.col("label").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        "embedding",
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    size = chosen.count()
    tasks = max(-(-size // TASK_ROWS), min(-(-size // FEW_ROWS), 2 * spark.sparkContext.defaultParallelism), 1)
    vectors = whole_vectors(chosen, ["vec_id", "label", "is_anchor"])
    # Numbers of rows already written: they stay the same however often a task runs.
    table = cut_lineage(vectors.repartition(tasks)).withColumn("row", F.monotonically_increasing_id())
    dimension = usual_dimension(table)
    table = of_dimension(table, dimension)
    anchors = table.where("is_anchor").select("row", "vec_id", "label", "x")
    rounds = -(-anchors.count() * 8 * dimension // ANCHOR_BYTES)
    anchors = anchors.withColumn("round", F.pmod(F.xxhash64("row"), F.lit(max(rounds, 1))))
    scanned = table.select("vec_id", "label", "row", "x")

    def of_round(number: int) -> DataFrame:
        held = anchors.where(F.col("round") == number).toArrow().combine_chunks()
        batch = Anchors(
            held.column("row").to_numpy(), held.column("label").to_numpy(), unpacked(held.column("x").combine_chunks(), dimension)
        )
        sent = spark.sparkContext.broadcast(batch)
        near = scanned.mapInArrow(lambda b: positives_in(b, dimension, sent.value, positives), FOUND)
        best = cut_lineage(_best_of_all(near, positives))
        batch.windows = _windows(best.select("anchor_row", "score").toArrow(), batch.row, low, high)
        sent_windows = spark.sparkContext.broadcast(batch)
        hard = scanned.mapInArrow(lambda b: negatives_in(b, dimension, sent_windows.value, negatives), FOUND)
        hard = _best_of_all(hard, negatives).select(
            "anchor_row", F.col("window").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
        )
        named = best.select("anchor_row", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"))
        own = anchors.where(F.col("round") == number).select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
        whole = hard.join(named, ["anchor_row", "positive_score"]).join(own, "anchor_row")
        return cut_lineage(
            whole.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        )

    if not rounds:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    return reduce(DataFrame.union, [of_round(i) for i in range(rounds)])


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The mined rows of the stated anchors: identifiers divisible by 50; labels moved on where divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", moved.alias("label"), "embedding")
    return mined(rows, F.col("vec_id") % 50 == 0)
