"""Certificate renewals, issuances and repurchases, derivative profit and loss."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import FACT, amount
from florin.operators import losses
from florin.operators.facts import entry, of_window, per_report_date, tagged
from florin.operators.report_dates import AGREED, PREVIOUS, REPORT, ReportSpan, on_dates
from florin.settings import Settings

ISSUANCE_METRICS = ["iss_repurchases", "iss_repurchases_n", "iss_cdt", "iss_cdt_n", "iss_bonds", "iss_bonds_n"]


def renewal_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    rows, value = on_dates(src["renewals"], "fecha_operacion", span, [REPORT]), amount("total_renovacion")
    return tagged(rows, [entry("renewals", value), *(losses.counted("renewals", value.isNull()) if count_rows else [])])


def cdt_renewals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    return per_report_date(span, renewal_facts(span, src), ["renewals"])


def derivative_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    conf = span.settings
    own = src["derivatives"].where(
        (F.col("descripcion") == conf.holder) & (F.col("tipo_cumplimiento") == conf.derivative_settlement)
    )
    rows, value = on_dates(own, "fecha_inicial", span, [PREVIOUS]), amount("utilidad")
    return tagged(rows, [entry("pnl", value), *(losses.counted("derivatives", value.isNull()) if count_rows else [])])


def derivatives_pnl(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    return per_report_date(span, derivative_facts(span, src), ["pnl"])


def _parents(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Operations starting on a report date and agreed on it or on one of the business days before it.

    The days belong to the report date, so its result does not depend on the run's other dates.
    """
    conf, isin = span.settings, F.col("codigo_isin")
    certificate, bond = isin.startswith(conf.certificate_isin), isin.startswith(conf.bond_isin)
    rows = src["operations_a"].where(certificate | bond).withColumn("kind", F.when(certificate, "cdt").otherwise("bonds"))
    rows = rows.where(span.reads("fecha_operacion", [AGREED]))
    agreed = span.bridge_for([AGREED]).select(F.col("report_date").alias("agreed_for"), F.col("source_date").alias("agreed_on"))
    rows = on_dates(rows, "fecha_inicio", span, [REPORT]).drop("cut")
    same = (F.col("report_date") == F.col("agreed_for")) & (F.col("fecha_operacion") == F.col("agreed_on"))
    return rows.join(agreed, same, "left_semi")


def _children(parents: DataFrame, src: Mapping[str, DataFrame], conf: Settings) -> DataFrame:
    kind = F.col("tipo_participacion").try_cast("int")
    return of_window(src["operations_b"], "id_padre", parents, "id").withColumn("tipo_participacion", kind).where(
        kind.isin(conf.repurchase_participation, conf.issuance_participation)
        & (F.col("nombre_inversion") == conf.investment_holder)
    )


def scan_repurchases(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Row-level join of parent and child operations."""
    parents = _parents(span, src)
    children = _children(parents, src, span.settings)
    return parents.join(children, parents["id"] == children["id_padre"]).drop("id_padre")


def _summed(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Parent/child join with both sides summed per operation first."""
    parents = _parents(span, src).groupBy("id", "report_date", "kind").agg(
        F.count(F.lit(1)).alias("n_parents"), F.sum(amount("precio_contado")).alias("price")
    )
    children = _children(_parents(span, src), src, span.settings).groupBy("id_padre", "tipo_participacion").agg(
        F.count(F.lit(1)).alias("n_children"), F.sum(amount("saldo")).alias("balance")
    )
    joined = parents.join(children, parents["id"] == children["id_padre"])
    return joined.select(
        "report_date",
        "kind",
        "tipo_participacion",
        (F.col("n_parents") * F.col("n_children")).alias("n_rows"),
        (F.col("price") * F.col("n_children")).cast(FACT).alias("price"),
        (F.col("balance") * F.col("n_parents")).cast(FACT).alias("balance"),
    )


def scan_totals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and measures of ``scan_repurchases`` per date, kind and participation."""
    return _summed(span, src).groupBy("report_date", "kind", "tipo_participacion").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("price").alias("total_price"), F.sum("balance").alias("total_balance")
    )


def issuance_facts(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Sums and row counts of repurchases, certificate issuances and bond issuances.

    Bonds count as issuances only; repurchases stay limited to certificates.
    """
    issued = F.col("tipo_participacion") == span.settings.issuance_participation
    metric = F.when(issued, F.concat(F.lit("iss_"), "kind")).when(F.col("kind") == "cdt", "iss_repurchases")
    value = F.when(issued, F.col("balance")).otherwise(F.col("price"))
    return tagged(
        _summed(span, src), [entry(metric, value), entry(F.concat(metric, F.lit("_n")), F.col("n_rows"))]
    )


def issuance_value(name: str) -> str:
    """A single row counts with its value rounded to cents, several with their plain sum."""
    return f"CASE WHEN {name}_n = 1 THEN BROUND({name}, 2) ELSE {name} END"


def issuance_repurchase(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    wide = per_report_date(span, issuance_facts(span, src), ISSUANCE_METRICS)
    names = {"iss_repurchases": "repurchases", "iss_cdt": "cdt_issuances", "iss_bonds": "bond_issuances"}
    return wide.selectExpr("report_date", *[f"{issuance_value(m)} AS {name}" for m, name in names.items()])
