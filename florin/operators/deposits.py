"""Bank statement movements and deposit balances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import AMOUNT, FACT, amount
from florin.operators import losses
from florin.operators.facts import compact, count_by, entry, held, per_report_date, tagged, times_n
from florin.operators.report_dates import PREVIOUS, REPORT, STATEMENTS, ReportSpan, on_dates, read_dates
from florin.settings import DEFAULT, Settings

STATEMENT_METRICS = ["cop_in", "cop_out", "usd_in", "usd_out"]
BALANCE_METRICS = ["balance_today", "balance_prev", "balance_today_n", "balance_prev_n"]


def own_accounts(src: Mapping[str, DataFrame], conf: Settings = DEFAULT) -> DataFrame:
    """Active accounts of the holder by statement account number, without leading zeros."""
    active = src["umbrella"].where((F.col("titular") == conf.holder) & (F.col("estado") == conf.active))
    own = count_by(active, F.regexp_replace("cuenta_bancaria", "^0+", "").alias("cuenta_bancaria"))
    return _small(own)


def _small(dimension: DataFrame) -> DataFrame:
    """Held where it is small; the other side of its joins is summed by the key either way."""
    local = held(dimension)
    return dimension if local is None else local


def scan_bank_transactions(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Row-level statement movements of active own accounts."""
    conf, rows = span.settings, on_dates(src["multicash"], "fecha_mvto", span, [STATEMENTS])
    own = src["umbrella"].where((F.col("titular") == conf.holder) & (F.col("estado") == conf.active))
    account = own.select(F.regexp_replace("cuenta_bancaria", "^0+", "").alias("cuenta_bancaria"))
    return rows.join(account, "cuenta_bancaria").drop("cut")


def scan_transaction_totals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and amount of ``scan_bank_transactions`` per report date."""
    rows = on_dates(src["multicash"], "fecha_mvto", span, [STATEMENTS])
    per_account = rows.groupBy("cuenta_bancaria", "report_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(amount("monto")).alias("amount")
    )
    joined = per_account.join(own_accounts(src, span.settings), "cuenta_bancaria")
    return joined.groupBy("report_date").agg(
        F.sum(F.col("n_rows") * F.col("n")).alias("n_rows"), F.sum(times_n()).alias("total")
    )


def statement_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    value = amount("monto")
    currency = F.when(F.col("moneda") == "COP", "cop").when(F.col("moneda") == "USD", "usd")
    metric = F.concat(currency, F.when(value >= 0, "_in").when(value < 0, "_out"))
    rows = on_dates(src["multicash"], "fecha_mvto", span, [STATEMENTS]).where(
        ~F.col("cuenta_bancaria").isin(list(span.settings.statement_excluded_accounts))
    )
    entries = [entry(metric, value)]
    if count_rows:
        entries += losses.counted("multicash", value.isNull() | F.col("moneda").isNull())
    summed = compact(tagged(rows, entries, keep=("cuenta_bancaria", "report_date")), "cuenta_bancaria")
    if count_rows:
        joined = summed.join(own_accounts(src, span.settings), "cuenta_bancaria", "left")
        return losses.through_join(joined, "multicash", F.col("n"))
    weighted = summed.join(own_accounts(src, span.settings), "cuenta_bancaria")
    return weighted.select("report_date", "metric", times_n())


def bank_transaction_totals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    wide = per_report_date(span, statement_facts(span, src), STATEMENT_METRICS)
    return wide.select(
        "report_date",
        *[(-F.col(m) if m.endswith("_out") else F.col(m)).alias(m) for m in STATEMENT_METRICS],
    )


def _product_accounts(src: Mapping[str, DataFrame], conf: Settings) -> DataFrame:
    accepted = src["deposit_account"].where(F.col("id_producto").isin(conf.deposit_products))
    return _small(count_by(accepted, F.col("id_cuenta_deposito").alias("id_cuenta")))


def _balance() -> Column:
    return F.coalesce(amount("total_balance"), F.lit(0).cast(AMOUNT))


def deposit_balance_by_date(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Total balance of the accepted products per balance date the report reads."""
    rows = read_dates(src["balance"], "fecha_saldo", span, [REPORT, PREVIOUS])
    per_account = rows.groupBy("id_cuenta", "fecha_saldo").agg(F.sum(_balance()).alias("amount"))
    weighted = per_account.join(_product_accounts(src, span.settings), "id_cuenta")
    return weighted.groupBy("fecha_saldo").agg(F.sum(times_n()).cast(FACT).alias("total_balance"))


def _balances_and_rows(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """``deposit_balance_by_date`` with the rows read, unmatched and malformed; no balance where none matches."""
    rows = read_dates(src["balance"], "fecha_saldo", span, [REPORT, PREVIOUS])
    per_account = rows.groupBy("id_cuenta", "fecha_saldo").agg(
        F.sum(_balance()).alias("amount"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("total_balance").isNull()).alias("n_bad")
    )
    joined = per_account.join(_product_accounts(src, span.settings), "id_cuenta", "left")
    return joined.groupBy("fecha_saldo").agg(
        F.sum(times_n()).cast(FACT).alias("total_balance"),
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(F.col("n").isNull(), F.col("n_rows"))).alias("n_lost"),
        F.sum("n_bad").alias("n_bad"),
    )


def balance_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    """Balance of the report date and of the day before; ``*_n`` tells whether a date has one."""
    by_date = _balances_and_rows(span, src) if count_rows else deposit_balance_by_date(span, src)
    rows = on_dates(by_date, "fecha_saldo", span, [REPORT, PREVIOUS])
    name = F.when(F.col("cut") == REPORT, "balance_today").otherwise("balance_prev")
    if not count_rows:
        return tagged(rows, [entry(name, F.col("total_balance")), entry(F.concat(name, F.lit("_n")), F.lit(1))])
    name = F.when(F.col("total_balance").isNotNull(), name)
    entries = [entry(name, F.col("total_balance")), entry(F.concat(name, F.lit("_n")), F.lit(1))]
    entries.append(entry(losses.name(losses.READ, "balance"), F.col("n_rows")))
    entries.append(entry(losses.name(losses.UNMATCHED, "balance"), F.col("n_lost")))
    entries.append(entry(losses.name(losses.MALFORMED, "balance"), F.col("n_bad")))
    return tagged(rows, entries)


# Today's balance minus the previous one; zero unless both dates have a balance.
VARIATION = (
    "CASE WHEN balance_today_n > 0 AND balance_prev_n > 0 THEN balance_today - balance_prev ELSE 0 END"
)


def account_variation(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    wide = per_report_date(span, balance_facts(span, src), BALANCE_METRICS)
    return wide.selectExpr("report_date", f"CAST({VARIATION} AS {FACT}) AS account_variation")
