"""Shards that match the mixture of sources: proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked; a row's fraction is
(rank - shift) / rows of the source, with a seeded shift per source. Sorted by fraction,
every stretch of rows holds each source in proportion, to within a row; the sorted rows
are cut into shards of equal numbers of rows.

Ranks are made without gathering a source or the table in one task: rows fall into hash
ranges (then fraction ranges), are numbered inside a range, and the ranges' sizes are
summed up.

Defined results: a NULL source is a source of its own; a NULL text has no bytes; rows
with equal identifier and text are interchangeable, and where they are many (more than one
row in RANGES) their hash also depends on their place in the input, which spreads them over
the ranges; texts of any length count by their bytes; fewer rows than shards leave shards
empty; extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from florin.session import cut_lineage

SHARDS = 40
SEED = 20
RANGES = 4096  # ranges per source, and of the fractions
LAW = "rows"


def _numbered(rows: DataFrame, within: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """Rank from 1 over the ranges of ``_range``, in order, separately for every ``within``."""
    keys = [*within, "_range"]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    # One row per range: RANGES of them at most for every value of ``within``.
    by_range = Window.partitionBy(*within).orderBy("_range")
    sizes = sizes.select(
        *keys,
        (F.sum("_size").over(by_range) - F.col("_size")).alias("_before"),
        F.sum("_size").over(Window.partitionBy(*within)).alias("_total"),
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = rows.withColumn("_inside", inside).join(sizes, keys)
    return numbered.withColumn(name, F.col("_before") + F.col("_inside")).drop("_inside", "_before")


def _spread(hashed: DataFrame) -> DataFrame:
    """``hashed``, already written, with hashes of their own for rows whose ``_hash`` more than one row in RANGES has."""
    many = hashed.count() // RANGES
    # At most RANGES hashes.
    frequent = hashed.groupBy("_hash").count().where((F.col("count") > F.lit(many)) & (F.col("count") > 1))
    frequent = frequent.select("_hash", F.lit(True).alias("_frequent"))
    own = F.xxhash64("_hash", F.monotonically_increasing_id())
    marked = hashed.withColumn("_own", own).join(F.broadcast(frequent), "_hash", "left")
    return marked.withColumn("_hash", F.when(F.col("_frequent"), F.col("_own")).otherwise(F.col("_hash"))).drop("_own", "_frequent")


def interleave(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, identifier: str = "doc_id",
               stratum: str = "source", content: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0, without gaps).

    ``content``: columns that tell rows of equal identifier apart.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    # The prefix keeps a NULL source apart from every text.
    source = F.coalesce(F.concat(F.lit("="), F.col(f"`{stratum}`").cast("string")), F.lit(""))
    # The caller's columns travel as one, so that their names are free for the ranks.
    hashed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        source.alias("_source"),
        F.xxhash64(F.lit(seed), identifier, *content).alias("_hash"),
    )
    hashed = _spread(cut_lineage(hashed)).withColumn("_range", F.pmod(F.shiftright("_hash", 32), F.lit(RANGES)))
    ties = [F.col("_hash"), *[F.col("_row").getField(c) for c in (identifier, *content)]]
    ranked = _numbered(hashed, ["_source"], ties, "_rank")
    shift = F.pmod(F.xxhash64(F.lit(seed), "_source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    fraction = (F.col("_rank") - shift) / F.col("_total")
    placed = ranked.withColumn("_fraction", fraction).drop("_total", "_range")
    span = F.least(F.floor(F.col("_fraction") * RANGES), F.lit(RANGES - 1))
    placed = placed.withColumn("_range", span).withColumn("_whole", F.lit(0))
    placed = cut_lineage(placed)
    order = [F.col("_fraction"), F.col("_source"), F.col("_rank")]
    sorted_ = _numbered(placed, ["_whole"], order, "_place").withColumn("_place", F.col("_place") - 1)
    exact = sorted_.withColumn("shard", F.expr(f"cast((_place * {shards}) div _total as int)"))
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return exact.withColumn("slot", F.col("_place") - first).select("_row.*", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Whole rows into one folder per shard, in slot order within a file."""
    placed = interleave(docs, shards, seed, content=["text"])
    placed.hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def sharding(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row; texts are read, not moved."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = interleave(rows, shards, seed, content=["text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
