"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from florin.llm import hard_negatives
from florin.llm.hard_negatives import Block

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, is_anchor, move):
    """(anchor, positive, rank, negative, scores) of the contract, by comparing every anchor with every row."""
    held = []
    for row, (i, v, label) in enumerate(rows):
        if v and label is not None and all(c is not None and math.isfinite(c) for c in v):
            held.append((i, (label + 1) % 10 if move and i is not None and i % 7 == 0 else label, [math.floor(256 * c) for c in v], row))
    usual = max({len(h[2]) for h in held}, key=lambda d: (sum(len(h[2]) == d for h in held), d), default=0)
    held = [h for h in held if len(h[2]) == usual]
    found = []
    for a in held:
        if a[0] is None or not is_anchor(a[0]):
            continue
        scored = [(-sum(p * q for p, q in zip(a[2], b[2], strict=True)), b[0] is None, b[0] or 0, b) for b in held if b is not a]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[3][1] == a[1]][:5]:
            fits = [s for s in scored if s[3][1] != a[1] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            found += [(a[0], p[3][0], r, s[3][0], -p[0], -s[0]) for r, s in enumerate(fits[:3], 1)]
    return sorted(found, key=repr)


def assert_plain(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    found = [tuple(r) for r in hard_negatives.hard_negatives(frame).collect()]
    assert sorted(found, key=repr) == plain(rows, lambda i: i % 50 == 0, True)
    return found


def vectors(seed, n, d=12, spread=0.5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, d)) * spread
    return [(i, (centre[i % 6] + rng.normal(size=d)).tolist(), i % 5) for i in range(n)]


@pytest.mark.parametrize("d", [1, 3, 12, 70])
def test_random_rows(spark, d):
    assert assert_plain(spark, vectors(d, 800, d))


def test_ties_repeats_and_missing_values(spark):
    rows = vectors(1, 400, 4)
    rows += [(i, [0.5, 0.5, 0.0, 0.1], i % 3) for i in range(1000, 1200)]  # one very common vector
    rows += [(50, rows[50][1], rows[50][2])] * 2 + [(None, rows[100][1], 0), (None, rows[100][1], 1)]
    rows += [(2000, None, 1), (2050, [None] * 4, 1), (2100, [math.nan] * 4, 1), (2150, [1.0] * 4, None), (2200, [1.0] * 3, 1), (2250, [], 1)]
    assert_plain(spark, rows)


def test_one_label_with_most_rows_and_anchors_without_partners(spark):
    assert_plain(spark, [(i, v, 1) for i, v, _ in vectors(2, 300)] + [(700, [1.0] * 12, 8)])
    assert_plain(spark, [(0, [1.0], 3), (50, [1.0], 4)])


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=3) * 3e6).tolist(), i % 2) for i in range(120)]
    found = assert_plain(spark, rows)
    assert max(r[4] for r in found) > 2**53


def test_nothing_to_mine(spark):
    assert_plain(spark, [])
    assert_plain(spark, [(0, None, 1), (50, [1.0], None)])
    assert_plain(spark, [(i, [1.0, 2.0], 1) for i in range(1, 40)])


def test_small_batches_and_blocks_give_the_same(spark, monkeypatch):
    rows = vectors(4, 600)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 400)
    assert_plain(spark, rows)


def test_general_form(spark):
    """Other anchors, counts and windows."""
    rows = vectors(5, 200, 3)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("x", F.lit("x"))
    found = hard_negatives.mined(frame, F.col("vec_id") < 3, positives=2, negatives=1, low=0, high=100).collect()
    assert {r["anchor_id"] for r in found} <= {0, 1, 2} and all(r["rank"] == 1 for r in found)
    assert all(0 <= r["negative_score"] <= r["positive_score"] for r in found)


def test_scan_looks_at_few_columns_of_most_rows():
    """After the anchor's large dimensions most rows have left the bitmap."""
    rng = np.random.default_rng(6)
    x = rng.integers(-100, 100, (2000, 64)).astype(float)
    block = Block(x, np.zeros(2000, int), np.arange(2000), np.zeros(2000, bool), np.arange(2000))
    anchor = np.zeros(64)
    anchor[[5, 9, 40]] = [1000.0, -900.0, 800.0]
    left = []

    def alive(low, high):
        left.append(len(low))
        return high >= np.partition(low, len(low) - 5)[len(low) - 5]

    at, score = block.scan(anchor, np.ones(2000, bool), alive)
    assert left[0] == 2000 and left[1] < 20
    assert set(np.argsort(-(x @ anchor))[:5]) <= set(at.tolist()) and sorted(score)[-1] == (x @ anchor).max()
