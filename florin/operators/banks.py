"""Bank balances, exchange rates and available funds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import FACT, amount, convert, line
from florin.operators import losses
from florin.operators.facts import entry, one_of, pivoted, tagged
from florin.operators.report_dates import BANK_T0, BANK_T1, PREVIOUS, REPORT, ReportSpan, on_dates
from florin.settings import DEFAULT, Settings

RATE_METRICS = ["rate_t0", "rate_t1"]

CUT_NAMES = {"t0": BANK_T0, "t1": BANK_T1}


def balance_metrics(conf: Settings = DEFAULT) -> list[str]:
    """The account groups, and the clearing of those in dollars."""
    groups = [*conf.central_bank_accounts, *conf.commercial_accounts, *conf.usd_accounts]
    return groups + [f"{name}_clearing" for name in conf.usd_accounts]


def report_metrics(conf: Settings = DEFAULT) -> list[str]:
    return [f"{cut}_{metric}" for cut in CUT_NAMES for metric in balance_metrics(conf)]


def scan_bank_balances(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Balances on the bank dates of each report date; ``cut`` is t0 or t1."""
    rows = on_dates(src["bank_balances"], "fecha_movimiento", span, CUT_NAMES.values())
    return rows.withColumn("cut", F.when(F.col("cut") == BANK_T0, "t0").otherwise("t1"))


def balance_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    """(report_date, cut, metric, amount): final balance per account group, and clearing of USD accounts."""
    conf, account = span.settings, F.col("numero_cuenta")
    held = F.col("nombre_titular_cuenta") == conf.holder
    usd = one_of({g: account.isin(a) & held for g, a in conf.usd_accounts.items()})
    group = F.coalesce(
        one_of({g: account.isin(a) for g, a in conf.central_bank_accounts.items()}),
        one_of({g: account.isin(a) & held for g, a in conf.commercial_accounts.items()}),
        usd,
    )
    rows = scan_bank_balances(span, src).select(
        "report_date", "cut", "saldo_bancario_final", "saldo_en_canje", group.alias("group"), usd.alias("usd")
    )
    entries = [
        entry(F.col("group"), amount("saldo_bancario_final")),
        entry(F.concat("usd", F.lit("_clearing")), amount("saldo_en_canje")),
    ]
    no_group = F.col("group").isNull()
    if count_rows:
        entries += losses.counted("bank_balances", F.col("saldo_bancario_final").isNull())
        entries.append(losses.unmatched("bank_balances", no_group))
    return tagged(rows if count_rows else rows.where(~no_group), entries, keep=("report_date", "cut"))


def net_of_clearing(group: str, prefix: str = "") -> str:
    """USD balance: sum of final balances minus the magnitude of the summed clearing."""
    return f"({prefix}{group} - ABS({prefix}{group}_clearing))"


def bank_account_balances(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """One row per report date and cut, one column per account group."""
    present = span.listed.select(
        "report_date",
        F.explode(F.array(*[F.lit(c) for c in CUT_NAMES])).alias("cut"),
        F.lit(None).cast("string").alias("metric"),
        F.lit(None).cast(FACT).alias("amount"),
    )
    conf = span.settings
    wide = pivoted(balance_facts(span, src).unionByName(present), balance_metrics(conf), "report_date", "cut")
    return wide.selectExpr(
        "report_date",
        "cut",
        *conf.central_bank_accounts,
        *conf.commercial_accounts,
        *[f"CAST({net_of_clearing(g)} AS {FACT}) AS {g}" for g in conf.usd_accounts],
    )


def rate_facts(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Rates valid on the previous business day (t0) and on the report date (t1).

    The validity interval is clipped to the dates that can be read and turned
    into days, which makes the lookup an equi-join.
    """
    low, high = (F.lit(d) for d in span.source_bounds)
    start, end = F.greatest("vigencia_desde", low), F.least("vigencia_hasta", high)
    valid = src["trm"].where(
        (F.col("vigencia_desde") <= high)
        & (F.col("vigencia_hasta") >= low)
        & (F.col("vigencia_desde") <= F.col("vigencia_hasta"))
    )
    days = valid.select("valor", F.explode(F.sequence(start, end)).alias("fecha"))
    rows = on_dates(days, "fecha", span, [PREVIOUS, REPORT])
    return tagged(rows, [entry(F.when(F.col("cut") == PREVIOUS, "rate_t0").otherwise("rate_t1"), amount("valor"))])


def available_expressions(cut: str, conf: Settings = DEFAULT) -> dict[str, str]:
    """SQL of the available-funds measures of one cut over the wide balances, unrounded."""
    prefix, rate = f"{cut}_", f"rate_{cut}"
    net = " + ".join(net_of_clearing(g, prefix) for g in conf.usd_accounts)
    return {
        "banco_republica": line(" + ".join(prefix + g for g in conf.central_bank_accounts) or "0"),
        "bancos_comerciales": line(" + ".join(prefix + g for g in conf.commercial_accounts) or "0"),
        "bancos_usd": convert(net or "0", rate),
        "trm": line(rate),
    }


def report_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    """Balance facts with the cut as metric prefix, for the whole-report aggregate."""
    metric = F.concat_ws("_", "cut", "metric")
    if count_rows:
        metric = F.when(F.col("metric").isin(losses.METRICS), F.col("metric")).otherwise(metric)
    return balance_facts(span, src, count_rows).select("report_date", metric.alias("metric"), "amount")

