"""Packing of documents into bins of one capacity: conflict-constrained best fit.

Bins are kept in order of what is left in them. A piece goes into the bin with the
least room that still holds it; where that bin conflicts, the search goes on to its
successors until the tightest compatible one is found, and else opens a new bin. A bin
carries a bitmap of the duplicate clusters in it (two documents of one cluster never
share a bin) and bitmaps of its sources in layers (at most ``per_source`` documents of
a source).

Documents longer than a bin are cut into full bins and a rest. Rows are dealt at random
into groups of a few thousand, each packed by itself from the largest piece down; a
group moves numbers only, no texts.

Defined results: NULL and empty texts are one piece of length 0; a NULL source or
cluster conflicts with nothing; repeated rows are packed each for itself; an empty table
gives no bins; every character of every row is in exactly one piece.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.session import cut_lineage

CAPACITY = 32_768  # code points of a bin
PER_SOURCE = 16
GROUP_ROWS = 4096

PLACED = "doc_id long, bin_id long, piece long, start long, length long, place long"


def best_fit(sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int, per_source: int) -> list[int]:
    """The bin of every item; items are taken from the largest down, none is larger than a bin."""
    counted = Counter(c for c in clusters if c is not None)
    # Only clusters of several items, and sources of more than a bin may take, can conflict.
    cluster_bit = {c: 1 << i for i, c in enumerate(c for c, n in counted.items() if n > 1)}
    often = Counter(s for s in sources if s is not None)
    source_bit = {s: 1 << i for i, s in enumerate(s for s, n in often.items() if n > per_source)}
    cluster_map: list[int] = []
    source_layers: list[list[int]] = []
    by_room: list[tuple[int, int]] = []  # (room left, bin), sorted
    chosen = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        cluster = cluster_bit.get(clusters[item], 0)
        source = source_bit.get(sources[item], 0)
        at = bisect_left(by_room, (size, -1))
        while at < len(by_room):
            number = by_room[at][1]
            if not cluster_map[number] & cluster and not source_layers[number][-1] & source:
                break
            at += 1
        if at < len(by_room):
            room, number = by_room.pop(at)
        else:
            room, number = capacity, len(cluster_map)
            cluster_map.append(0)
            source_layers.append([0] * per_source)
        cluster_map[number] |= cluster
        if source:
            layers = source_layers[number]
            level = next(i for i, layer in enumerate(layers) if not layer & source)
            layers[level] |= source
        insort(by_room, (room - size, number))
        chosen[item] = number
    return chosen


def pack_group(rows: pa.Table, capacity: int, per_source: int) -> pa.Table:
    """PLACED of one group's rows (group, doc_id, source, cluster, size)."""
    # An order of the rows' own, so that a repeated task ends in the same bins.
    rows = rows.sort_by([("size", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("source", "ascending")])
    size = rows.column("size").to_numpy()
    full = np.where(size > 0, (size - 1) // capacity, 0)  # full bins before the last piece
    rest = size - full * capacity
    sources, clusters = rows.column("source").to_pylist(), rows.column("cluster").to_pylist()
    bins = np.asarray(best_fit(rest.tolist(), sources, clusters, capacity, per_source), np.int64)
    packed = int(bins.max()) + 1
    n = len(size)
    row = np.concatenate([np.arange(n), np.repeat(np.arange(n), full)])
    inner = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)
    bin_id = np.concatenate([bins, packed + np.arange(len(inner))])
    piece = np.concatenate([full, inner])
    length = np.concatenate([rest, np.full(len(inner), capacity, np.int64)])
    # Where a piece starts in its bin: the lengths of the pieces before it.
    order = np.argsort(bin_id, kind="stable")
    before = np.cumsum(length[order]) - length[order]
    first = np.concatenate([[True], bin_id[order][1:] != bin_id[order][:-1]])
    place = np.empty_like(length)
    place[order] = before - before[first][np.cumsum(first) - 1]
    group = rows.column("group")[0].as_py()
    return pa.table(
        {
            "doc_id": rows.column("doc_id").take(pa.array(row)),
            "bin_id": bin_id + (group << 32),
            "piece": piece,
            "start": piece * capacity,
            "length": length,
            "place": place,
        }
    )


def pack(items: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """PLACED of ``items`` (doc_id, source, cluster, size)."""
    known = cut_lineage(items.select("doc_id", "source", "cluster", "size"))
    groups = max(1, -(-known.count() // group_rows))
    # Rows equal in all columns are told apart by their place in the stored table.
    dealt = F.pmod(F.xxhash64(F.lit(5), "doc_id", "cluster", "size", F.monotonically_increasing_id()), F.lit(groups))
    return (
        known.withColumn("group", dealt)
        .groupBy("group")
        .applyInArrow(lambda rows: pack_group(rows, capacity, per_source), PLACED)
    )


def text_cluster(text: Column) -> Column:
    """Texts that are equal but for case and white space share it; NULL for texts without content."""
    bare = F.translate(F.lower(text), " \t\r\n", "")
    return F.when(F.length(bare) > 0, F.xxhash64(bare))


def items_of(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", text_cluster(F.col("text")).alias("cluster"), size.alias("size"))


def packed_texts(docs: DataFrame, placed: DataFrame, separator: str = "\n\n") -> DataFrame:
    """(bin_id, text): the pieces of every bin in their order. ``doc_id`` must be unique in ``docs``.

    A bin is bounded by its capacity, so gathering one in a task is bounded too.
    """
    pieces = placed.join(docs.select("doc_id", "text"), "doc_id").select(
        "bin_id", "place", "doc_id", F.expr("substring(text, cast(start + 1 as int), cast(length as int))").alias("part")
    )
    gathered = pieces.groupBy("bin_id").agg(F.array_sort(F.collect_list(F.struct("place", "doc_id", "part"))).alias("p"))
    return gathered.select("bin_id", F.array_join(F.col("p.part"), separator).alias("text"))


def best_fit_packing(docs: DataFrame) -> DataFrame:
    """doc_id, bin_id, piece, start, length, place: one row per piece of every document, in code points."""
    return pack(items_of(docs))
