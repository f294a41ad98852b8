"""Core-banking channel transactions: time slots, transfers, credit and confirming."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import amount
from florin.operators import losses
from florin.operators.facts import (
    TRANSFER,
    compact,
    count_by,
    entry,
    held,
    matched,
    matched_entry,
    of_window,
    one_of,
    per_report_date,
    tagged,
    times_n,
)
from florin.operators.report_dates import REPORT, ReportSpan, on_dates
from florin.settings import DEFAULT, Settings, Slots, seconds_of_day

TRANSFER_METRICS = ["debit_sebra", "credit_sebra", "debit_returns_sebra", "credit_returns_sebra"]
CREDIT_METRICS = ["credit_income", "credit_negative", "deposit_cros", "confirming_income", "confirming_negative"]


def slot_metrics(conf: Settings = DEFAULT) -> list[str]:
    slots = {"ret": conf.withdrawal_slots, "dep": conf.deposit_slots, "dev": conf.deposit_slots}
    return [f"{kind}_{i}" for kind, listed in slots.items() for i in range(len(listed))]


def metrics(conf: Settings = DEFAULT) -> list[str]:
    return slot_metrics(conf) + TRANSFER_METRICS + CREDIT_METRICS


def latest_accounts(accounts: DataFrame) -> DataFrame:
    """The most recently modified version of every account.

    An aggregate, not a window: versions are combined on the map side, so an
    account with a huge history is never sorted in one task.
    """
    order = F.struct("fecha_ultima_modificacion", "version")
    newest = F.max(F.struct(order.alias("modified"), F.col("id").alias("id"))).alias("newest")
    return accounts.groupBy("clave_codificada").agg(newest).select(
        "clave_codificada", F.col("newest.id").alias("id"), F.col("newest.modified.version").alias("version")
    )


def _used_accounts(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """All versions of the accounts that the report dates' transactions are on."""
    transactions = on_dates(src["transactions"], "fecha_valor", span, [REPORT])
    return of_window(src["accounts"], "clave_codificada", transactions, "clave_cuenta_padre")


def _channel_names(src: Mapping[str, DataFrame]) -> DataFrame:
    return src["channels"].select(F.col("clave_codificada").alias("_channel"), F.col("nombre").alias("canal"))


def _with_channel(span: ReportSpan, src: Mapping[str, DataFrame], how: str = "inner") -> DataFrame:
    """(account, report date, channel name, value, time slots, n): transactions, equal ones counted where that helps.

    A short list of channels is held and broadcast. With a longer one the rows are counted per
    account, channel and value first, so that no raw row is shuffled by its channel.
    """
    conf = span.settings
    second = F.hour("fecha_hora_valor") * 3600 + F.minute("fecha_hora_valor") * 60 + F.second("fecha_hora_valor")
    rows = on_dates(src["transactions"], "fecha_valor", span, [REPORT]).select(
        "clave_cuenta_padre",
        "report_date",
        "clave_canal",
        amount("monto").alias("value"),
        F.col("fecha_hora_valor").isNull().alias("timeless"),
        _slot("ret", second, conf.withdrawal_slots).alias("ret"),
        _slot("dep", second, conf.deposit_slots).alias("dep"),
        _slot("dev", second, conf.deposit_slots).alias("dev"),
    )
    names = held(_channel_names(src))
    if names is None:
        names = _channel_names(src)
        rows = count_by(rows, *rows.columns)
    else:
        rows = rows.withColumn("n", F.lit(1))
    return rows.join(names, F.col("clave_canal") == F.col("_channel"), how)


def scan_channel_transactions(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Row-level transactions with channel name and account id."""
    latest = latest_accounts(_used_accounts(span, src)).drop("version")
    names = held(_channel_names(src))
    rows = on_dates(src["transactions"], "fecha_valor", span, [REPORT])
    rows = rows.join(_channel_names(src) if names is None else names, F.col("clave_canal") == F.col("_channel"))
    rows = rows.drop("_channel", "clave_canal", "cut")
    return rows.join(latest, rows["clave_cuenta_padre"] == latest["clave_codificada"]).drop("clave_codificada")


def scan_totals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and amount of ``scan_channel_transactions`` per date and channel."""
    per_account = _with_channel(span, src).groupBy("clave_cuenta_padre", "report_date", "canal").agg(
        F.sum("n").alias("n_rows"), F.sum(times_n("value")).alias("amount")
    )
    keys = _used_accounts(span, src).select(F.col("clave_codificada").alias("clave_cuenta_padre")).distinct()
    return per_account.join(keys, "clave_cuenta_padre").groupBy("report_date", "canal").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("total")
    )


def _slot(prefix: str, second_of_day: Column, slots: Slots) -> Column:
    """Name of the time slot. Bounds are whole seconds, inclusive; fractions were truncated."""
    within = [second_of_day.between(seconds_of_day(a), seconds_of_day(b)) for a, b in slots]
    return one_of({f"{prefix}_{i}": inside for i, inside in enumerate(within)})


def channel_facts(
    span: ReportSpan, src: Mapping[str, DataFrame], transfers: bool = False, count_rows: bool = False
) -> DataFrame:
    """Slot totals, transfer totals, and credit/confirming totals.

    Transactions are summed per account before the account join; which account
    is the credit or the confirming one is only known after it. With ``transfers`` the
    same pass gives the distinct amounts (match_amount) of transfers on these two.
    """
    conf = span.settings
    channel, value, n = F.col("canal"), F.col("value"), F.col("n")
    metric = (
        F.when(channel == conf.ach_withdrawal, F.col("ret"))
        .when(channel == conf.ach_deposit, F.col("dep"))
        .when(channel == conf.ach_return, F.col("dev"))
        .when(channel == conf.transfer_debit, "debit_sebra")
        .when(channel == conf.transfer_credit, "credit_sebra")
        .when(channel == conf.transfer_debit_return, "debit_returns_sebra")
        .when(channel == conf.transfer_credit_return, "credit_returns_sebra")
        .when((channel == conf.cross_deposit) & (value > 0), "deposit_cros")
    )
    metric_value = (
        F.when(channel == conf.ach_withdrawal, -value)
        .when(channel.isin(conf.transfer_debit, conf.transfer_credit_return), F.abs(value))
        .otherwise(value)
    )
    by_account = F.when(
        ~channel.isin(conf.excluded_channels), F.when(value >= 0, "account_in").when(value < 0, "account_out")
    )
    entries = [matched_entry(metric, metric_value * n), matched_entry(by_account, value * n)]
    if transfers:
        is_transfer = channel.isin(conf.transfer_channels) & value.isNotNull()
        entries.append(matched_entry(F.when(is_transfer, TRANSFER), F.lit(0), F.when(is_transfer, value)))
    if count_rows:
        known = F.col("_channel").isNotNull()
        entries += [matched_entry(F.when(known, READ_TRANSACTIONS).otherwise(LOST_TRANSACTIONS), n)]
        malformed = losses.name(losses.MALFORMED, "transactions")
        entries += [matched_entry(F.when(value.isNull() | F.col("timeless"), malformed), n)]
    rows = _with_channel(span, src, "left" if count_rows else "inner")
    facts = matched(rows, entries, keep=("clave_cuenta_padre", "report_date"))
    latest = latest_accounts(_used_accounts(span, src)).select(
        F.col("clave_codificada").alias("clave_cuenta_padre"), "id", F.lit(True).alias("is_known")
    )
    per_account = compact(facts, "clave_cuenta_padre", "match_amount")
    joined = per_account.join(latest, "clave_cuenta_padre", "left" if count_rows else "inner")
    owner = F.when(F.col("id") == conf.credit_account, "credit").when(
        F.col("id") == conf.confirming_account, "confirming"
    )
    final = (
        F.when(F.col("metric") == "account_in", F.concat(owner, F.lit("_income")))
        .when(F.col("metric") == "account_out", F.concat(owner, F.lit("_negative")))
        .when(F.col("metric") == TRANSFER, F.when(owner.isNotNull(), TRANSFER))
        .otherwise(F.col("metric"))
    )
    if not count_rows:
        return tagged(joined, [entry(final, F.col("amount"))], keep=("report_date", "match_amount"))
    name, summed = F.col("metric"), F.col("amount")
    # Rows without a channel give counts only; their account does not matter.
    row_count = F.when(name.isin(READ_TRANSACTIONS, LOST_TRANSACTIONS), READ_TRANSACTIONS)
    row_count = row_count.when(name == losses.name(losses.MALFORMED, "transactions"), name)
    lost = (name == LOST_TRANSACTIONS) | ((name == READ_TRANSACTIONS) & F.col("is_known").isNull())
    first = F.coalesce(row_count, F.when(F.col("is_known"), final))
    entries = [entry(first, summed), losses.unmatched("transactions", lost, summed)]
    return tagged(joined, entries, keep=("report_date", "match_amount"))


READ_TRANSACTIONS = losses.name(losses.READ, "transactions")
LOST_TRANSACTIONS = "lost_transactions"


def credit_amounts(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct (report_date, amount) of transfers on the credit and confirming accounts."""
    found = channel_facts(span, src, transfers=True).where(F.col("metric") == TRANSFER)
    return found.select("report_date", F.col("match_amount").alias("amount")).distinct()


def ach_time_slots(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    return per_report_date(span, channel_facts(span, src), slot_metrics(span.settings))


def sebra_transfer_totals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    return per_report_date(span, channel_facts(span, src), TRANSFER_METRICS)


CREDIT_OUTCOME = "deposit_cros - credit_negative"


def credit_confirming(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    wide = per_report_date(span, channel_facts(span, src), CREDIT_METRICS)
    return wide.selectExpr(
        "report_date",
        "credit_income",
        f"{CREDIT_OUTCOME} AS credit_outcome",
        "confirming_income",
        "-confirming_negative AS confirming_outcome",
    )
