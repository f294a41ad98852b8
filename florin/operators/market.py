"""Money-market operations: settling today, and traded and settled the same day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import amount
from florin.operators import losses
from florin.operators.facts import compact, count_by, entry, of_window, per_report_date, tagged, times_n
from florin.operators.report_dates import REPORT, ReportSpan, on_dates
from florin.settings import DEFAULT, Settings

SETTLING = [
    "sim_tes_active",
    "sim_tes_passive",
    "sim_priv_active",
    "sim_priv_passive",
    "buy_tes",
    "sell_tes",
    "buy_priv",
    "sell_priv",
    "repo_active",
    "repo_passive",
    "dollar_buy",
    "dollar_sell",
    "ttv_sell",
    "ttv_buy",
]
# Cash leaves on these, so the settling report shows them negative.
SETTLING_OUTFLOWS = {"sim_tes_passive", "sim_priv_passive", "buy_tes", "buy_priv", "repo_passive", "dollar_buy", "ttv_buy"}
SAME_DAY = [
    "sim_tes_active",
    "sim_tes_passive",
    "sim_priv_active",
    "sim_priv_passive",
    "buy_tes",
    "sell_tes",
    "buy_priv",
    "sell_priv",
    "repo_active_sell",
    "repo_passive_sell",
    "repo_active_buy",
    "repo_passive_buy",
    "dollar_buy",
    "dollar_sell",
    "ttv_sell",
    "ttv_buy",
]
METRICS = [f"mm_{name}" for name in SETTLING] + [f"sd_{name}" for name in SAME_DAY]


def _traded(src: Mapping[str, DataFrame], conf: Settings) -> DataFrame:
    return src["money_market"].where(F.col("tipo_operacion").isin(conf.traded_sides))


def operation_counts(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Operations per number and control date, for the report dates."""
    rows = on_dates(src["unity_operations"], "fecha_cuadre", span, [REPORT])
    return count_by(rows, "consecutivo", "report_date")


def scan_money_market(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Row-level join of traded operations with their control dates."""
    control = on_dates(src["unity_operations"], "fecha_cuadre", span, [REPORT]).select("consecutivo", "fecha_cuadre")
    return of_window(_traded(src, span.settings), "consecutivo", control, "consecutivo").join(control, "consecutivo")


def scan_totals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and turnover of ``scan_money_market`` per control date, without building its rows."""
    control = on_dates(src["unity_operations"], "fecha_cuadre", span, [REPORT])
    per_operation = of_window(_traded(src, span.settings), "consecutivo", control, "consecutivo").groupBy("consecutivo").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(amount("valor_de_giro")).alias("amount")
    )
    joined = per_operation.join(operation_counts(span, src), "consecutivo")
    return joined.groupBy(F.col("report_date").alias("fecha_cuadre")).agg(
        F.sum(F.col("n_rows") * F.col("n")).alias("n_rows"), F.sum(times_n()).alias("total")
    )


def metric_names(same_day: Column, conf: Settings = DEFAULT) -> tuple[Column, Column]:
    """The metric of an operation, and its second one: private simultaneous operations
    may also match the government pattern."""
    kind = F.col("clasificacion")
    deposited = F.col("cod_central_deposito").isin(conf.depositories)
    government = F.col("codigo_especie").rlike(conf.government_species)
    private = F.col("codigo_especie").rlike(conf.private_species)
    stance = F.when(F.col("tipo_sim") == "A", "active").when(F.col("tipo_sim") == "P", "passive")
    side = F.when(F.col("tipo_operacion") == "C", "buy").when(F.col("tipo_operacion") == "V", "sell")
    simultaneous = (kind == "SIM") & deposited
    name = (
        F.when(simultaneous & government, F.concat(F.lit("sim_tes_"), stance))
        .when(
            (kind == "NORMAL") & (F.col("nemotecnico") != conf.dollar_nemo) & deposited,
            F.concat(side, F.when(government, "_tes").when(~government, "_priv")),
        )
        .when(
            (kind == "NORMAL") & (F.col("nemotecnico") == conf.dollar_nemo) & (F.col("genera_detalle") == "SI"),
            F.concat(F.lit("dollar_"), side),
        )
        .when(
            (kind == "REPO") & deposited,
            F.when(same_day, F.concat(F.lit("repo_"), stance, F.lit("_"), side)).otherwise(
                F.concat(F.lit("repo_"), stance)
            ),
        )
        .when(kind == "TTV", F.concat(F.lit("ttv_"), side))
    )
    return name, F.when(simultaneous & private, F.concat(F.lit("sim_priv_"), stance))


def market_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    """Facts of both variants: ``mm_*`` traded earlier, ``sd_*`` traded on the report date.

    A metric needs the settlement date and the control date to equal the report
    date, so the report date is part of the join key.
    """
    rows = on_dates(_traded(src, span.settings), "fecha_cumplimiento", span, [REPORT])
    same_day = F.col("fecha_operacion") == F.col("report_date")
    prefix = F.when(same_day, "sd_").when(~same_day, "mm_")
    first, second = metric_names(same_day, span.settings)
    value = amount("valor_de_giro")
    entries = [entry(F.concat(prefix, first), value), entry(F.concat(prefix, second), value)]
    if count_rows:
        entries += losses.counted("money_market", value.isNull())
    summed = compact(tagged(rows, entries, keep=("consecutivo", "report_date")), "consecutivo")
    if count_rows:
        joined = summed.join(operation_counts(span, src), ["consecutivo", "report_date"], "left")
        return losses.through_join(joined, "money_market", F.col("n"))
    weighted = summed.join(operation_counts(span, src), ["consecutivo", "report_date"])
    return weighted.select("report_date", "metric", times_n())


def money_market_settlement(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """The fourteen settling totals, outflows negative."""
    wide = per_report_date(span, market_facts(span, src), METRICS)
    return wide.select(
        "report_date",
        *[(-F.col(f"mm_{n}") if n in SETTLING_OUTFLOWS else F.col(f"mm_{n}")).alias(n) for n in SETTLING],
    )


def money_market_same_day(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """The sixteen same-day totals, unsigned."""
    wide = per_report_date(span, market_facts(span, src), METRICS)
    return wide.select("report_date", *[F.col(f"sd_{n}").alias(n) for n in SAME_DAY])
