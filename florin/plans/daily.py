"""All metrics of every report date in one aggregate, and the statements over them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin import params
from florin.functions.amounts import FACT, convert, line, money, total
from florin.operators import banks, channels, deposits, losses, market, movements, refunds, securities
from florin.operators.facts import per_report_date
from florin.operators.report_dates import ReportSpan
from florin.settings import DEFAULT, Settings


def metric_names(conf: Settings = DEFAULT) -> list[str]:
    return (
        banks.report_metrics(conf)
        + banks.RATE_METRICS
        + market.METRICS
        + movements.METRICS
        + movements.THIRD_METRICS
        + channels.metrics(conf)
        + refunds.metrics(conf)
        + deposits.STATEMENT_METRICS
        + deposits.BALANCE_METRICS
        + ["renewals", "pnl"]
        + securities.ISSUANCE_METRICS
    )


# Metrics that a report for the current day does not have yet.
DAY_INPUTS = [f"sd_{n}" for n in market.SAME_DAY] + deposits.STATEMENT_METRICS + securities.ISSUANCE_METRICS
DAY_INPUTS += movements.THIRD_METRICS + deposits.BALANCE_METRICS


def available_metrics(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Wide balances and rates only, for the available-funds tables."""
    facts = banks.report_facts(span, src).unionByName(banks.rate_facts(span, src))
    return per_report_date(span, facts, banks.report_metrics(span.settings) + banks.RATE_METRICS)


def daily_metrics(
    span: ReportSpan, src: Mapping[str, DataFrame], as_of: date | None = None, count_rows: bool = False
) -> DataFrame:
    """One row per report date with every metric of every source.

    ``as_of`` is the current day; a report date equal to it gets zero day inputs. With
    ``count_rows`` the metrics of ``losses`` are there, too, from the same aggregate.
    """
    moved = movements.third_party_facts(span, src, count_rows)
    booked = channels.channel_facts(span, src, transfers=True, count_rows=count_rows)
    facts = reduce(
        DataFrame.unionByName,
        [
            banks.report_facts(span, src, count_rows),
            banks.rate_facts(span, src),
            market.market_facts(span, src, count_rows),
            movements.netted(moved.unionByName(booked)),
            refunds.refund_facts(span, src, count_rows),
            deposits.statement_facts(span, src, count_rows),
            deposits.balance_facts(span, src, count_rows),
            securities.renewal_facts(span, src, count_rows),
            securities.derivative_facts(span, src, count_rows),
            securities.issuance_facts(span, src),
        ],
    )
    names = metric_names(span.settings) + (losses.METRICS if count_rows else [])
    return without_day_inputs(per_report_date(span, facts, names), as_of)


def uncounted_rows(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """report_date, source, rows_read, unmatched, malformed of every report date."""
    return losses.uncounted_rows(daily_metrics(span, src, count_rows=True))


def without_day_inputs(metrics: DataFrame, as_of: date | None) -> DataFrame:
    if as_of is None:
        return metrics
    zeroed = {
        name: F.when(F.col("report_date") == F.lit(as_of), F.lit(0).cast(FACT)).otherwise(F.col(name))
        for name in DAY_INPUTS
        if name in metrics.columns
    }
    return metrics.withColumns(zeroed)


# --- statements over daily_metrics: SQL text per column, in output order ---------------

CUTS = {"t0": params.AVAILABLE_T0, "t1": params.AVAILABLE_T1}


def _plus(names: Iterable[str]) -> str:
    return " + ".join(names) or "0"


def _available(conf: Settings) -> dict[str, str]:
    return {f"{cut}_{name}": sql for cut in CUTS for name, sql in banks.available_expressions(cut, conf).items()}


def basics(conf: Settings = DEFAULT) -> dict[str, str]:
    """First step: values that need nothing but metrics."""
    return {
        "account_variation": deposits.VARIATION,
        "credit_outcome": channels.CREDIT_OUTCOME,
        "returns_to_send": " + ".join(refunds.to_send(conf)),
        "cdt_issued": securities.issuance_value("iss_cdt"),
        "bonds_issued": securities.issuance_value("iss_bonds"),
        "dollar_comp": "mm_dollar_sell - ABS(mm_dollar_buy) + sd_dollar_sell - sd_dollar_buy",
        "usd_income": convert("usd_in", "rate_t0"),
        "usd_outcome": convert("ABS(usd_out)", "rate_t0"),
        "instant_income": f"{conf.instant_payment_income:f}",
        "instant_expense": f"{conf.instant_payment_expense:f}",
        **_available(conf),
    }


TOTALS = {f"{cut}_total": f"{cut}_banco_republica + {cut}_bancos_comerciales + {cut}_bancos_usd" for cut in CUTS}


def flows(conf: Settings = DEFAULT) -> dict[str, str]:
    """Second step: values over the first."""
    slots = channels.slot_metrics(conf)
    withdrawn = [name for name in slots if name.startswith("ret_")]
    paid_in = [name for name in slots if name not in withdrawn] + refunds.cycle_metrics(conf)
    return {
        "income_ach": f"{_plus(paid_in)} - (credit_income + confirming_income) - account_variation",
        # The originated credit is added and taken away again, so it does not appear.
        "outcome_ach": f"{_plus(withdrawn)} + returns_to_send - (ABS(credit_outcome) + ABS(confirming_negative))",
        "dollar_variation": "t0_bancos_usd - t1_bancos_usd",
        "change_variation": "(usd_income - usd_outcome) - (t0_bancos_usd - t1_bancos_usd)",
        **TOTALS,
    }


def with_flows(metrics: DataFrame, conf: Settings = DEFAULT) -> DataFrame:
    """Metrics plus the derived values the statements share."""
    first = metrics.selectExpr("*", *[f"{line(sql)} AS {name}" for name, sql in basics(conf).items()])
    return first.selectExpr("*", *[f"{line(sql)} AS {name}" for name, sql in flows(conf).items()])


def _income(name: str) -> str:
    return f"`income_{name}`"


def _expense(name: str) -> str:
    return f"`expense_{name}`"


def _unplanned(shared: DataFrame, lines: Mapping[str, str]) -> ValueError | None:
    """What is wrong with the first line that cannot be planned; None where all can."""
    for name, sql in lines.items():
        try:
            shared.selectExpr("report_date", sql)
        except (AnalysisException, ParseException) as error:
            return ValueError(f"statement line {name}: {error}")
    return None


def statements(metrics: DataFrame, conf: Settings = DEFAULT) -> DataFrame:
    """Unrounded statements, available funds and summary, one row per report date.

    ``conf``: the settings of the span that the metrics are of; ``report`` takes them from there.
    """
    shared = with_flows(metrics, conf)
    columns = {_income(name): sql for name, sql in conf.income_statement.items()}
    columns |= {_expense(name): sql for name, sql in conf.expense_statement.items()}
    own = {name: f"{line(sql)} AS {name}" for name, sql in columns.items()}
    try:
        lines = shared.selectExpr(
            "report_date",
            *[f"{cut}_{name}" for cut in CUTS for name in params.AVAILABLE_COLUMNS],
            *own.values(),
            *[m for m in losses.METRICS if m in metrics.columns],
        )
    except (AnalysisException, ParseException) as error:
        raise _unplanned(shared, own) or error from error
    totals = lines.selectExpr(
        "*",
        f"{total(map(_income, conf.income_statement))} AS income_total",
        f"{total(map(_expense, conf.expense_statement))} AS expense_total",
        f"{line('t0_total - t1_total')} AS variation",
    )
    flows = totals.selectExpr("*", f"{line('income_total - expense_total')} AS flow")
    difference = flows.selectExpr("*", f"{line('variation - flow')} AS difference")
    ratio = f"CAST(CAST(difference AS {FACT}) AS DOUBLE) / CAST(CAST(variation AS {FACT}) AS DOUBLE)"
    return difference.selectExpr(
        "*", f"CASE WHEN variation <> 0 THEN BROUND({ratio} * 100, 3) END AS percentage"
    )


def report(
    span: ReportSpan, src: Mapping[str, DataFrame], as_of: date | None = None, count_rows: bool = False
) -> DataFrame:
    """``statements`` of the span under its own settings."""
    return statements(daily_metrics(span, src, as_of, count_rows), span.settings)


# Output tables: column -> SQL over statements().


def _statement_table(stated: DataFrame, side: str) -> dict[str, str]:
    names = [c.removeprefix(f"{side}_") for c in stated.columns if c.startswith(f"{side}_") and c != f"{side}_total"]
    return {**{f"`{n}`": money(f"`{side}_{n}`") for n in names}, "total": money(f"{side}_total")}


def income_table(stated: DataFrame) -> dict[str, str]:
    """The lines that ``stated`` has, so that no settings are needed again."""
    return _statement_table(stated, "income")


def expense_table(stated: DataFrame) -> dict[str, str]:
    return _statement_table(stated, "expense")


SUMMARY_TABLE = {
    "variacion_disponible": money("variation"),
    "total_flujo": money("flow"),
    "diferencia": money("difference"),
    params.PERCENTAGE_COLUMN: "percentage",
}


def available_table(cut: str) -> dict[str, str]:
    return {name: money(f"{cut}_{name}") for name in params.AVAILABLE_COLUMNS}


def _table(stated: DataFrame, columns: dict[str, str]) -> DataFrame:
    return stated.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()], "report_date AS fecha_reporte")


def income_statement(stated: DataFrame) -> DataFrame:
    return _table(stated, income_table(stated))


def expense_statement(stated: DataFrame) -> DataFrame:
    return _table(stated, expense_table(stated))


def cash_summary(stated: DataFrame) -> DataFrame:
    return _table(stated, SUMMARY_TABLE)


def available_balances(metrics: DataFrame, conf: Settings = DEFAULT) -> DataFrame:
    """Unrounded available funds of both cuts over ``available_metrics``."""
    parts = metrics.selectExpr("report_date", *[f"{sql} AS {name}" for name, sql in _available(conf).items()])
    return parts.selectExpr("*", *[f"{line(sql)} AS {name}" for name, sql in TOTALS.items()])


def available_funds(balances: DataFrame, cut: str) -> DataFrame:
    """Available funds of one cut (t0 or t1) over ``available_balances`` or ``statements``."""
    return _table(balances, available_table(cut))


def available_union(balances: DataFrame) -> DataFrame:
    """Both cuts with their type, in one pass."""
    rows = ", ".join(
        "STRUCT(" + ", ".join(f"{sql} AS {n}" for n, sql in available_table(cut).items()) + f", '{kind}' AS tipo_disponible)"
        for cut, kind in CUTS.items()
    )
    return balances.selectExpr("report_date AS fecha_reporte", f"INLINE(ARRAY({rows}))").select(
        *params.AVAILABLE_COLUMNS, "tipo_disponible", "fecha_reporte"
    )


def stamped(table: DataFrame) -> DataFrame:
    """Add the generation date of an output table."""
    return table.withColumn("fecha_generacion", F.current_date())


# Inputs of the statements by cash-flow category (fixed values: names as the report's users know them).
DAILY_INPUTS = {
    "incomeComercialesCop": "0",
    "incomeRepos": "sd_repo_passive_sell",
    "incomeSimultaneaTES": "sd_sim_tes_passive",
    "incomeSimultaneaPrivada": "sd_sim_priv_passive",
    "incomeVentaDivisas": "sd_dollar_sell",
    "incomeSwapCaja": "sd_repo_active_sell",
    "incomeCDT": securities.issuance_value("iss_cdt"),
    "incomeBonos": securities.issuance_value("iss_bonds"),
    "incomeCreditoCapital": "0",
    "incomeCreditoINT8ereses": "0",
    "incomeTIDIS": "sd_sell_tes",
    "incomeTCO": "sd_sell_priv",
    "incomeTDA": "sd_ttv_sell",
    "outcomeEncaje": "0",
    "outcomeComercialesCop": "0",
    "outcomeDepositoRemunerado": "0",
    "outcomeRepos": "sd_repo_active_buy",
    "outcomeSimultaneaTES": "sd_sim_tes_active",
    "outcomeSimultaneaPrivada": "sd_sim_priv_active",
    "outcomeCompraDivisas": "sd_dollar_buy",
    "outcomeSwapCaja": "sd_repo_passive_buy",
    "outcomeRecompras": securities.issuance_value("iss_repurchases"),
    "outcomeDesembolsos": "0",
    "outcomeTIDIS": "sd_buy_tes",
    "outcomeTCO": "sd_buy_priv",
    "outcomeTDA": "sd_ttv_buy",
    "outcomeSEBRA": "0",
    "BancosCopIncome": "cop_in",
    "BancosCopOutcome": "-cop_out",
    "BancosUsdIncome": "usd_in",
    "BancosUsdOutcome": "-usd_out",
    "account_variation": deposits.VARIATION,
    "sebra_in": "third_in",
    "sebra_out": "third_out",
}


def daily_inputs(metrics: DataFrame) -> DataFrame:
    return metrics.selectExpr("report_date", *[f"{money(line(sql))} AS {n}" for n, sql in DAILY_INPUTS.items()])


def ach_net_flow(metrics: DataFrame, conf: Settings = DEFAULT) -> DataFrame:
    names = ["dollar_comp", "income_ach", "outcome_ach"]
    withdrawals = params.EXPENSE_STATEMENT["045_retiros_ach"]
    return with_flows(metrics, conf).selectExpr(
        "report_date", *[f"{money(n)} AS {n}" for n in names], f"{money(withdrawals)} AS retiros_ach"
    )


def fx_variation(metrics: DataFrame, conf: Settings = DEFAULT) -> DataFrame:
    names = ["usd_income", "usd_outcome", "dollar_variation", "change_variation"]
    return with_flows(metrics, conf).selectExpr("report_date", *[f"{money(n)} AS {n}" for n in names])
