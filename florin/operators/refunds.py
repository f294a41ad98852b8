"""Clearing-house adapter: refund parsing, cycle totals, matched refunds, originated credit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import FACT, drop_last_two, second_token_int
from florin.operators import losses
from florin.operators.facts import entry, per_report_date, tagged
from florin.operators.report_dates import PREVIOUS, REPORT, ReportSpan, on_dates, read_dates
from florin.settings import DEFAULT, Settings
from florin.sources.catalog import Sources


def cycle_metrics(conf: Settings = DEFAULT) -> list[str]:
    return [f"cud_{i}" for i in range(1, conf.cycles + 1)]


def metrics(conf: Settings = DEFAULT) -> list[str]:
    return cycle_metrics(conf) + ["late_yesterday", "matched_today", "matched_yesterday", "adaptor"]


# What makes an outgoing refund and a sent refund the same one.
MATCH_KEYS = [
    "reg6_cuenta_receptora",
    "receiver",
    "reg5_nombre_originador",
    "originator",
    "reg6_nombre_cliente_receptor",
    "reg6_valor_transaccion",
]


def scan_adapter(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Adapter rows of the report date (``today``) and the business day before (``yesterday``)."""
    rows = on_dates(src["adapter"], "fecha_consulta", span, [REPORT, PREVIOUS])
    return rows.withColumn("which_day", _which_day()).drop("cut")


def latest_date(src: Mapping[str, DataFrame]) -> DataFrame:
    """The date taken as today when no report date is given.

    Where the catalog lists the adapter's partitions by date, only the newest one that is
    not empty is read; else the column of the whole table.
    """
    rows = src["adapter"]
    days = src.partition_days("adapter", "fecha_consulta") if isinstance(src, Sources) else None
    for day in reversed(days or []):
        of_day = rows.where(F.col("fecha_consulta") == F.lit(day))
        if not of_day.isEmpty():
            rows = of_day
            break
    return rows.agg(F.max("fecha_consulta").alias("latest"))


def parsed(rows: DataFrame) -> DataFrame:
    """Add cycle and amount; malformed names and amounts become NULL and are not summed."""
    return rows.withColumns(
        {"cycle": second_token_int(F.col("name")), "amount": drop_last_two(F.col("reg6_valor_transaccion"))}
    )


def _outgoing(conf: Settings) -> Column:
    return F.col("name").endswith(conf.out_suffix) & (F.col("status") == conf.unauthorized)


def _which_day() -> Column:
    return F.when(F.col("cut") == REPORT, "today").otherwise("yesterday")


def matched_by_date(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Multiset match of late outgoing and sent refunds per adapter date.

    Every row is counted under its role with the parties oriented the same way,
    so one aggregate replaces a join of two: n outgoing and m sent refunds with
    equal keys match min(n, m) times.
    """
    conf, rows = span.settings, parsed(read_dates(src["adapter"], "fecha_consulta", span, [REPORT, PREVIOUS]))
    receiver, originator = F.col("reg6_entidad_receptora"), F.col("reg5_entidad_originadora")

    def role(applies: Column, to: Column, by: Column, is_out: int) -> Column:
        return F.when(
            applies, F.struct(to.alias("receiver"), by.alias("originator"), F.lit(is_out).alias("is_out"))
        )

    roles = F.array(
        role(_outgoing(conf) & (F.col("cycle") >= conf.late_cycle), receiver, originator, 1),
        role(F.col("transaction_type") == conf.sent_refund, originator, receiver, 0),
    )
    by_role = (
        rows.select("*", F.explode(roles).alias("role"))
        .where(F.col("role").isNotNull())
        .select("*", "role.receiver", "role.originator", "role.is_out")
        .dropna(subset=[*MATCH_KEYS, "amount"])
    )
    per_key = by_role.groupBy("fecha_consulta", "amount", *MATCH_KEYS).agg(
        F.sum("is_out").alias("n_out"), F.sum(1 - F.col("is_out")).alias("n_sent")
    )
    pairs = F.least("n_out", "n_sent")
    return per_key.groupBy("fecha_consulta").agg(
        F.sum(pairs * F.col("amount")).cast(FACT).alias("matched"), F.sum(F.col("n_out") - pairs).alias("n_unmatched")
    )


def _matches_of_days(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Matched amount of each report date's two days, and how many late refunds found no counterpart."""
    days = span.bridge.where(F.col("cut").isin(REPORT, PREVIOUS))
    found = matched_by_date(span, src)
    if span.is_held:
        # One row per date of the bridge at most.
        found = F.broadcast(found)
    rows = days.join(found, F.col("source_date") == F.col("fecha_consulta"), "left")
    none = F.lit(0).cast(FACT)
    return rows.select(
        "report_date", _which_day().alias("which_day"), F.coalesce("matched", none).alias("matched"), "n_unmatched"
    )


def matched_refunds(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Matched amount of each report date's two days (today, yesterday), 0 where nothing matches."""
    return _matches_of_days(span, src).drop("n_unmatched")


def _malformed(conf: Settings) -> Column:
    """Refunds whose cycle or amount cannot be read."""
    sent = F.col("transaction_type") == conf.sent_refund
    unread = F.col("amount").isNull() | (_outgoing(conf) & F.col("cycle").isNull())
    return F.coalesce(_outgoing(conf) | sent, F.lit(False)) & unread


def refund_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    conf, rows = span.settings, parsed(scan_adapter(span, src))
    today = F.col("which_day") == "today"
    cycle_metric = F.when(
        _outgoing(conf),
        F.when(today & F.col("cycle").between(1, conf.cycles), F.concat(F.lit("cud_"), F.col("cycle"))).when(
            ~today & (F.col("cycle") >= conf.late_cycle), "late_yesterday"
        ),
    )
    originator = F.ltrim(F.trim("reg5_datos_originador"), F.lit("0"))
    text = F.trim("reg6_valor_transaccion")
    paid = F.when(F.length(text) > 2, drop_last_two(text)).otherwise(F.lit(0).cast(FACT))
    adaptor = F.when(today & (originator == conf.originator_account), "adaptor")
    entries = [entry(cycle_metric, F.col("amount")), entry(adaptor, -paid)]
    of_day = [entry(F.concat(F.lit("matched_"), "which_day"), F.col("matched"))]
    if count_rows:
        entries += losses.counted("adapter", _malformed(conf))
        of_day.append(losses.unmatched("adapter", F.col("n_unmatched") > 0, F.col("n_unmatched")))
    return tagged(rows, entries).unionByName(tagged(_matches_of_days(span, src), of_day))


# Returns to send: late ones of yesterday still unmatched, today's early cycles, today's matches.
def to_send(conf: Settings = DEFAULT) -> list[str]:
    early = cycle_metrics(conf)[: conf.late_cycle - 1]
    return ["late_yesterday - matched_yesterday", *early, "matched_today"]


def ach_refunds(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    wide = per_report_date(span, refund_facts(span, src), metrics(span.settings))
    sends = [f"{sql} AS send_{i}" for i, sql in enumerate(to_send(span.settings))]
    return wide.selectExpr("report_date", *cycle_metrics(span.settings), *sends)


def credit_adaptor_outcome(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    wide = per_report_date(span, refund_facts(span, src), metrics(span.settings))
    return wide.select("report_date", F.col("adaptor").alias("credit_adaptor_outcome"))


def refund_parse(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """What the parser makes of the adapter rows of the report dates, per cycle."""
    rows = parsed(read_dates(src["adapter"], "fecha_consulta", span, [REPORT, PREVIOUS]))
    return rows.groupBy("fecha_consulta", "cycle").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("amount").alias("n_amounts"), F.sum("amount").alias("total")
    )
