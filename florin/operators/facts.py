"""Tagged facts: the common shape of every metric.

A source row is tagged with the metrics it counts towards and becomes
``(report_date, metric, amount)`` rows, at most one per family of mutually
exclusive metrics. Facts of all sources are then summed together in one
aggregate, whatever the number of metrics, sources or report dates.

Where a metric needs a join, the facts are summed per join key first
(``compact``) and the other side is reduced to a row count per key, so a key
that holds a third of the rows reaches the join as a handful of rows and equal
keys on both sides never multiply out. A side without a date of its own is a whole
history: ``of_window`` sorts out the rows whose key the report dates do not have before
anything of it is summed or shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florin.functions.amounts import AMOUNT, FACT
from florin.operators.report_dates import ReportSpan


# A set of key hashes is 2^KEY_BITS bits in rows of 64: at most 262 144 rows to broadcast,
# whatever the number of keys. A fuller set only lets more rows pass.
KEY_BITS = 24
# Estimated size from which on sorting out a history is worth reading the window's keys for it.
HISTORY_BYTES = 10 << 30
HASHED_KEYS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.StringType(), T.DateType())


def estimated_bytes(rows: DataFrame) -> int:
    """The optimizer's estimate, for files their size; rows of unknown size count as very large."""
    return int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def of_window(history: DataFrame, key: str, window: DataFrame, window_key: str) -> DataFrame:
    """Rows of ``history`` whose key may be among the keys of ``window``; none of those is lost.

    For the side of an equality join that is not kept whole. The history stays where it
    is: sums on the map side and their handling of hot keys come after it. Keys of two
    different types, which a join would convert first, are not sorted out, nor is a history
    estimated below HISTORY_BYTES; the result is the same either way.
    """
    kinds = history.schema[key].dataType, window.schema[window_key].dataType
    if kinds[0] != kinds[1] or kinds[0] not in HASHED_KEYS:
        return history
    if estimated_bytes(history) < HISTORY_BYTES:
        return history

    def place(column: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(column), 64 - KEY_BITS)

    def bit(at: Column) -> Column:
        return (at % 64).cast("int")

    one = F.lit(1).cast("bigint")
    words = (
        window.where(F.col(window_key).isNotNull())
        .select(place(window_key).alias("_place"))
        .groupBy(F.shiftright("_place", 6).alias("_word"))
        .agg(F.bit_or(F.call_function("shiftleft", one, bit(F.col("_place")))).alias("_bits"))
    )
    set_bit = F.call_function("shiftright", F.col("_bits"), bit(place(key))).bitwiseAND(one) == 1
    joined = history.join(F.broadcast(words), (F.shiftright(place(key), 6) == F.col("_word")) & set_bit)
    return joined.select(*[history[c] for c in history.columns])


# A list of so many rows and bytes at most is held as a local table and broadcast.
HELD_ROWS = 100_000
HELD_BYTES = 32 << 20


def held(rows: DataFrame) -> DataFrame | None:
    """``rows`` as a local table to broadcast, or None where they are more than HELD_ROWS or HELD_BYTES.

    The size is found by reading one row more than may be held, not from statistics. Where
    it is None, sum the other side by the join's key first: the result is the same.
    """
    table = rows.limit(HELD_ROWS + 1).toArrow()
    if table.num_rows > HELD_ROWS or table.nbytes > HELD_BYTES:
        return None
    return F.broadcast(rows.sparkSession.createDataFrame(table, rows.schema))


def one_of(cases: Mapping[str, Column]) -> Column:
    """Name of the first true predicate; NULL when none is true."""
    if not cases:
        return F.lit(None).cast("string")
    pairs = iter(cases.items())
    name, condition = next(pairs)
    chosen = F.when(condition, F.lit(name))
    for name, condition in pairs:
        chosen = chosen.when(condition, F.lit(name))
    return chosen


# The metric of credit transfers, which only tell the amounts to net third-party movements of.
TRANSFER = "transfer"


def entry(metric: Column | str, amount: Column) -> Column:
    tag = F.lit(metric) if isinstance(metric, str) else metric
    return F.struct(tag.alias("metric"), amount.cast(FACT).alias("amount"))


def matched_entry(metric: Column | str, amount: Column, match: Column | None = None) -> Column:
    """An entry with ``match_amount``, the amount by which it is netted; NULL where it is not."""
    own = F.lit(None) if match is None else match
    return F.struct(entry(metric, amount).alias("fact"), own.cast(AMOUNT).alias("match_amount"))


def matched(rows: DataFrame, entries: Sequence[Column], keep: Sequence[str] = ("report_date",)) -> DataFrame:
    """``tagged`` for entries with a match_amount."""
    facts = rows.select(*keep, F.inline(F.array(*entries)))
    return facts.select(*keep, "fact.metric", "fact.amount", "match_amount").where(F.col("metric").isNotNull())


def tagged(rows: DataFrame, entries: Sequence[Column], keep: Sequence[str] = ("report_date",)) -> DataFrame:
    """Facts of the rows: one per non-NULL metric among the entries."""
    if len(entries) == 1:
        facts = rows.select(*keep, entries[0].alias("_fact")).select(*keep, "_fact.metric", "_fact.amount")
    else:
        facts = rows.select(*keep, F.inline(F.array(*entries)))
    return facts.where(F.col("metric").isNotNull())


def compact(facts: DataFrame, *keys: str) -> DataFrame:
    """Facts summed per key, report date and metric."""
    return facts.groupBy(*keys, "report_date", "metric").agg(F.sum("amount").cast(FACT).alias("amount"))


def count_by(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """Row count ``n`` per key."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def times_n(amount: str = "amount") -> Column:
    return (F.col(amount) * F.col("n")).cast(FACT).alias(amount)


def pivoted(facts: DataFrame, names: Sequence[str], *dims: str) -> DataFrame:
    """One row per dims, one DECIMAL column per metric, 0 where a metric has no rows."""
    wide = facts.groupBy(*dims).pivot("metric", list(names)).agg(F.sum("amount"))
    return wide.selectExpr(*dims, *[f"CAST(COALESCE({n}, 0) AS {FACT}) AS {n}" for n in names])


def per_report_date(span: ReportSpan, facts: DataFrame, names: Sequence[str]) -> DataFrame:
    """``pivoted`` over report_date, with a row for every report date even without facts."""
    present = span.listed.select(
        "report_date", F.lit(None).cast("string").alias("metric"), F.lit(None).cast(FACT).alias("amount")
    )
    return pivoted(facts.select("report_date", "metric", "amount").unionByName(present), names, "report_date")
