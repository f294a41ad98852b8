"""Named queries over the sample tables: one per operator of the report."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florin import params
from florin.functions import calendar
from florin.functions.amounts import amount
from florin.operators import banks, channels, deposits, market, movements, refunds, securities
from florin.operators.facts import TRANSFER, per_report_date
from florin.operators.merge import merge_by_keys, read_partitioned, schema_sync, upsert_partitioned
from florin.operators.newest import maintain_newest
from florin.operators.report_dates import ReportSpan, business_day_span, window_span
from florin.operators.transpose import unpivoted
from florin.plans import daily, job
from florin.plans.incremental import run_incremental, statements_of
from florin.session import fresh_path
from florin.settings import DEFAULT, Settings
from florin.sources.catalog import CONTRACTS, Sources, from_frames, from_tables
from florin.sources.samples import sample_sources

REPORT_DATE = date(2024, 1, 12)
BACKFILL = (date(2024, 1, 1), date(2024, 1, 31))
# A second institution over the same sources.
OTHER = Settings(
    holder="OTHER HOLDER",
    central_bank_accounts={"central": ["62015990", "62015991"]},
    commercial_accounts={"payroll": ["423816990", "434381323"], "operating": ["61100001577"]},
    usd_accounts={"dollars": ["86110", "1901751916"]},
)
# The first one, with statements of a few lines and instant payments.
CONDENSED = replace(
    DEFAULT,
    income_statement={
        "treasury": "mm_sell_tes + sd_sell_tes + mm_sell_priv + sd_sell_priv + yields",
        "deposits": "account_variation + renewals + cdt_issued + bonds_issued",
        "payments": "income_ach + cop_in + usd_income + instant_income",
    },
    expense_statement={
        "treasury": "ABS(mm_buy_tes) + sd_buy_tes + ABS(mm_buy_priv) + sd_buy_priv",
        "certificates": "ABS(repurchases) + ABS(renewals - due_cdt)",
        "payments": "ABS(outcome_ach) + ABS(cop_out) + usd_outcome + instant_expense",
    },
    instant_payment_income="1250.75",
    instant_payment_expense=300,
)

Query = Callable[[SparkSession, str], DataFrame]


def _doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE rounded to cents, the form in which results are compared."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.round(F.col(f"`{c}`"), 2).cast("double").alias(c) if kinds[c].startswith("decimal") else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def _over_window(build: Callable[[ReportSpan, Sources], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = sample_sources(spark, sf_dir)
        return _doubles(build(window_span(spark, REPORT_DATE), src))

    return query


def _over_sources(build: Callable[[Sources], DataFrame]) -> Query:
    return lambda spark, sf_dir: _doubles(build(sample_sources(spark, sf_dir)))


def _metrics(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    return daily.daily_metrics(span, src)


def _statements(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    return daily.report(span, src)


def condensed_report(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """The long report of an institution with lines of its own."""
    stated = _statements(span.under(CONDENSED), src)
    return unpivoted(stated, job.sections(stated))


def concept_codes(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """The concept codes of each report date, with the number of their names."""
    names = src["homologation"].groupBy("codigo_contable").agg(F.count_distinct("concepto_cud").alias("n_names"))
    codes = movements.concept_codes(span, src)
    named = codes.join(names, codes["code"] == names["codigo_contable"], "left")
    return named.select("report_date", "code", F.coalesce("n_names", F.lit(0)).alias("n_names"))


def _balances(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    return daily.available_balances(daily.available_metrics(span, src), span.settings)


def available_by_institution(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Available funds of two institutions in one plan."""
    parts = [
        daily.available_union(_balances(span.under(settings), src)).withColumn("institution", F.lit(name))
        for name, settings in (("first", DEFAULT), ("second", OTHER))
    ]
    return parts[0].unionByName(parts[1])


# --- calendar over the dates found in the tables ------------------------------------


def business_calendar(src: Sources) -> DataFrame:
    """Calendar attributes of every account-modification date, with the rows that carry it."""
    days = src["accounts"].groupBy(F.col("fecha_ultima_modificacion").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return calendar.with_calendar(days, "day")


def _movement_days(src: Sources) -> DataFrame:
    return src["cc_movements"].groupBy(F.col("fecha").alias("report_date")).agg(F.count(F.lit(1)).alias("n_rows"))


def business_window(src: Sources) -> DataFrame:
    """The report window of every movement date."""
    return _movement_days(src).select(
        F.col("report_date").alias("anchor"),
        "n_rows",
        F.posexplode(calendar.business_window(F.col("report_date"))).alias("seq", "report_date"),
    )


def report_dates(src: Sources) -> DataFrame:
    return calendar.with_report_dates(_movement_days(src), "report_date")


def bank_dates(src: Sources) -> DataFrame:
    """Bank dates of the account-modification dates, 25 years on: over year ends and the cut-over."""
    day = F.add_months(F.col("fecha_ultima_modificacion").cast("date"), 25 * 12)
    days = src["accounts"].groupBy(day.alias("report_date")).agg(F.count(F.lit(1)).alias("n_rows"))
    return calendar.with_report_dates(days, "report_date").select("report_date", "n_rows", "bank_t0", "bank_t1")


def parse_report_dates(src: Sources) -> DataFrame:
    """Report dates parsed from the accepted text forms, rows per date."""
    at, style = F.col("fecha_hora_valor"), F.col("clave_canal") % 3
    text = (
        F.when(style == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(style == 1, F.date_format(at, "yyyy-MM-dd"))
        .otherwise(F.date_format(at, "'DATE 'yyyy-MM-dd"))
    )
    parsed = calendar.parse_report_date(text)
    return src["transactions"].groupBy(parsed.alias("report_date")).agg(F.count(F.lit(1)).alias("n_rows"))


def date_bridge(span: ReportSpan, src: Sources) -> DataFrame:
    """Every source date a report date reads, with the movements found there."""
    found = src["cc_movements"].groupBy(F.col("fecha").alias("source_date")).agg(F.count(F.lit(1)).alias("n_rows"))
    return span.bridge.join(found, "source_date", "left").select(
        "report_date", "cut", "source_date", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


# --- scans: rows and totals of what each source contributes --------------------------


def _rows_and_total(value: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(amount(value)).alias("total")]


def scan_bank_balances(span: ReportSpan, src: Sources) -> DataFrame:
    rows = banks.scan_bank_balances(span, src)
    return rows.groupBy("report_date", "cut").agg(*_rows_and_total(F.col("saldo_bancario_final")))


def scan_unity_movements(span: ReportSpan, src: Sources) -> DataFrame:
    return movements.summed_movements(span, src).groupBy("report_date").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("gross").alias("total")
    )


def scan_adapter(span: ReportSpan, src: Sources) -> DataFrame:
    return refunds.scan_adapter(span, src).groupBy("report_date", "which_day").agg(F.count(F.lit(1)).alias("n_rows"))


# The rows of the scans themselves, as the joins define them.


def _channel_rows(span: ReportSpan, src: Sources) -> DataFrame:
    rows = channels.scan_channel_transactions(span, src)
    return rows.withColumn("hora", F.date_format("fecha_hora_valor", "HH:mm:ss")).drop("fecha_hora_valor")


def _concept_rows(span: ReportSpan, src: Sources) -> DataFrame:
    return movements.process_concept(movements.scan_unity_movements(span, src))


def _value_rows(span: ReportSpan, src: Sources) -> DataFrame:
    return movements.process_value(_concept_rows(span, src), src["homologation"])


def daily_inputs_as_of(span: ReportSpan, src: Sources) -> DataFrame:
    """The inputs as the last report date itself sees them: its own are not there yet."""
    return daily.daily_inputs(daily.daily_metrics(span, src, REPORT_DATE))


def rates(span: ReportSpan, src: Sources) -> DataFrame:
    return per_report_date(span, banks.rate_facts(span, src), banks.RATE_METRICS)


def sebra_net_movements(span: ReportSpan, src: Sources) -> DataFrame:
    transfers = channels.channel_facts(span, src, transfers=True).where(F.col("metric") == TRANSFER)
    facts = movements.netted(movements.third_party_facts(span, src).unionByName(transfers))
    wide = per_report_date(span, facts, movements.THIRD_METRICS)
    return wide.select("report_date", F.col("third_in").alias("sebra_in"), F.col("third_out").alias("sebra_out"))


# --- sinks ----------------------------------------------------------------------------


def _stale(table: DataFrame) -> DataFrame:
    """An earlier state of the available table: older figures, without the last report date."""
    return table.where(F.col("fecha_reporte") < F.lit(REPORT_DATE)).withColumn("total", F.lit(0.0))


def schema_sync_union(span: ReportSpan, src: Sources) -> DataFrame:
    """T-0 rows from before the type column existed, and typed T-1 rows."""
    balances = _balances(span, src)
    typed = daily.available_funds(balances, "t1").withColumn("tipo_disponible", F.lit(params.AVAILABLE_T1))
    return schema_sync(daily.available_funds(balances, "t0"), typed)


def upsert_merge_result(span: ReportSpan, src: Sources) -> DataFrame:
    """The merge as a plan: a batch with the T-1 rows over an earlier state of the table."""
    table = daily.available_union(_balances(span, src))
    batch = table.where(F.col("tipo_disponible") == params.AVAILABLE_T1)
    return merge_by_keys(_stale(table), batch, params.MERGE_KEYS_AVAILABLE)


def upsert_written(span: ReportSpan, src: Sources) -> DataFrame:
    """The same merge through files: create, then upsert, then read back."""
    path = fresh_path(src.spark, "available")
    table = daily.available_union(_balances(span, src))
    batch = table.where(F.col("tipo_disponible") == params.AVAILABLE_T1)
    for frame in (_stale(table), batch):
        upsert_partitioned(frame, path, params.MERGE_KEYS_AVAILABLE, params.PARTITION_KEYS)
    return read_partitioned(src.spark, path).select(*table.columns)


def cash_summary_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of every business day of the month, with the same plan as five days."""
    return daily.cash_summary(_statements(business_day_span(spark, *BACKFILL), sample_sources(spark, sf_dir)))


def latest_account_maintained(src: Sources) -> DataFrame:
    """The newest version of every account, merged from changes in batches, late ones and a repeated one among them."""
    path = fresh_path(src.spark, "newest-accounts")
    changes = src["accounts"].withColumn("_batch", F.year("fecha_ultima_modificacion") % 3)
    for batch in (F.col("_batch") == 2, F.col("_batch") == 0, (F.col("_batch") == 1) | F.col("_batch").isNull(), F.col("_batch") == 0):
        maintain_newest(changes.where(batch).drop("_batch"), path, buckets=8)
    return channels.latest_accounts(read_partitioned(src.spark, path))


def adapter_latest_partition(src: Sources) -> DataFrame:
    """The latest adapter date, from the catalog's list of partitions."""
    table = f"florin_adapter_{uuid.uuid4().hex}"
    rows = src["adapter"].where(F.col("fecha_consulta").isNotNull())
    files = fresh_path(src.spark, "adapter")
    rows.hint("rebalance", "fecha_consulta").write.partitionBy("fecha_consulta").option("path", files).saveAsTable(table)
    return refunds.latest_date(from_tables(src.spark, {"adapter": table}))


def cash_summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's summary by two runs: one before some rows came, and one that computes what they concern."""
    src, span = sample_sources(spark, sf_dir), business_day_span(spark, *BACKFILL)
    late = {"transactions": ("fecha_valor", "2024-01-17"), "balance": ("fecha_saldo", "2024-01-23"), "adapter": ("fecha_consulta", "2024-01-30")}
    early = {name: src[name] for name in CONTRACTS}
    early |= {name: src[name].where(f"NOT {day} <=> DATE '{on}'") for name, (day, on) in late.items()}
    folder = fresh_path(spark, "statements")
    run_incremental(span, from_frames(spark, early), folder)
    run_incremental(span, src, folder)
    return daily.cash_summary(statements_of(span, folder))


QUERIES: dict[str, Query] = {
    "business_calendar": _over_sources(business_calendar),
    "business_window": _over_sources(business_window),
    "report_dates": _over_sources(report_dates),
    "bank_dates": _over_sources(bank_dates),
    "parse_report_dates": _over_sources(parse_report_dates),
    "date_bridge": _over_window(date_bridge),
    "scan_bank_balances": _over_window(scan_bank_balances),
    "scan_money_market": _over_window(market.scan_totals),
    "scan_unity_movements": _over_window(scan_unity_movements),
    "scan_bank_transactions": _over_window(deposits.scan_transaction_totals),
    "scan_money_market_rows": _over_window(market.scan_money_market),
    "scan_unity_movements_rows": _over_window(movements.scan_unity_movements),
    "scan_bank_transactions_rows": _over_window(deposits.scan_bank_transactions),
    "scan_channel_transactions_rows": _over_window(_channel_rows),
    "scan_repurchases_rows": _over_window(securities.scan_repurchases),
    "process_concept": _over_window(_concept_rows),
    "process_value": _over_window(_value_rows),
    "trm_validity_join": _over_window(rates),
    "scan_repurchases": _over_window(securities.scan_totals),
    "latest_account_version": _over_sources(lambda src: channels.latest_accounts(src["accounts"])),
    "latest_account_maintained": _over_sources(latest_account_maintained),
    "scan_channel_transactions": _over_window(channels.scan_totals),
    "deposit_balance_by_date": _over_window(deposits.deposit_balance_by_date),
    "scan_adapter": _over_window(scan_adapter),
    "adapter_latest_date": _over_sources(refunds.latest_date),
    "adapter_latest_partition": _over_sources(adapter_latest_partition),
    "bank_account_balances": _over_window(banks.bank_account_balances),
    "available_funds_t0": _over_window(lambda span, src: daily.available_funds(_balances(span, src), "t0")),
    "available_funds_t1": _over_window(lambda span, src: daily.available_funds(_balances(span, src), "t1")),
    "available_union": _over_window(lambda span, src: daily.available_union(_balances(span, src))),
    "available_by_institution": _over_window(available_by_institution),
    "money_market_settlement": _over_window(market.money_market_settlement),
    "money_market_same_day": _over_window(market.money_market_same_day),
    "concept_derivation": _over_window(movements.concept_derivation),
    "concept_codes": _over_window(concept_codes),
    "concept_homologation": _over_window(movements.concept_homologation),
    "unmapped_concepts": _over_window(movements.unmapped_concepts),
    "unity_totals": _over_window(movements.unity_totals),
    "cdt_renewals": _over_window(securities.cdt_renewals),
    "issuance_repurchase": _over_window(securities.issuance_repurchase),
    "derivatives_pnl": _over_window(securities.derivatives_pnl),
    "ach_time_slots": _over_window(channels.ach_time_slots),
    "sebra_transfer_totals": _over_window(channels.sebra_transfer_totals),
    "account_variation": _over_window(deposits.account_variation),
    "ach_refund_parse": _over_window(refunds.refund_parse),
    "ach_matched_refunds": _over_window(refunds.matched_refunds),
    "ach_refunds": _over_window(refunds.ach_refunds),
    "credit_confirming": _over_window(channels.credit_confirming),
    "credit_adaptor_outcome": _over_window(refunds.credit_adaptor_outcome),
    "sebra_net_movements": _over_window(sebra_net_movements),
    "bank_transaction_totals": _over_window(deposits.bank_transaction_totals),
    "daily_inputs": _over_window(lambda span, src: daily.daily_inputs(_metrics(span, src))),
    "daily_inputs_as_of": _over_window(daily_inputs_as_of),
    "ach_net_flow": _over_window(lambda span, src: daily.ach_net_flow(_metrics(span, src))),
    "fx_variation": _over_window(lambda span, src: daily.fx_variation(_metrics(span, src))),
    "income_statement": _over_window(lambda span, src: daily.income_statement(_statements(span, src))),
    "expense_statement": _over_window(lambda span, src: daily.expense_statement(_statements(span, src))),
    "cash_summary": _over_window(lambda span, src: daily.cash_summary(_statements(span, src))),
    "cash_summary_backfill": cash_summary_backfill,
    "cash_summary_incremental": cash_summary_incremental,
    "condensed_report": _over_window(condensed_report),
    "report_transpose": _over_window(lambda span, src: job.transposed_report(span, _statements(span, src))),
    "uncounted_rows": _over_window(daily.uncounted_rows),
    "schema_sync_union": _over_window(schema_sync_union),
    "upsert_merge_result": _over_window(upsert_merge_result),
    "upsert_partitioned": _over_window(upsert_written),
}
