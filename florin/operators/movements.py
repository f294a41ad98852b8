"""Account movements: concept derivation, homologation, totals, third-party netting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import AMOUNT, FACT, amount
from florin.operators import losses
from florin.operators.facts import TRANSFER, count_by, entry, held, of_window, one_of, per_report_date, tagged, times_n
from florin.operators.report_dates import MOVEMENTS, ReportSpan, on_dates
from florin.settings import DEFAULT, Settings


def value_concepts(conf: Settings = DEFAULT) -> dict[str, Sequence[str]]:
    return {
        "repurchases": [conf.repurchase_concept],
        "due_cdt": [conf.issuer_payment_concept],
        "yields": [conf.yield_concept],
        "gmf": [conf.gmf_concept],
        "pay_findeter": [conf.credit_interest_concept],
        "expense_sebra": conf.clearing_expense_concepts,
    }


def signed_concepts(conf: Settings = DEFAULT) -> dict[str, Sequence[str]]:
    """Concepts whose movements count by their sign, in and out."""
    return {
        "sebra_fx": [conf.fx_concept],
        "otc": [conf.otc_concept],
        "other": conf.other_concepts,
        "other_ops": conf.other_operation_concepts,
    }


THIRD_METRICS = ["third_in", "third_out"]
METRICS = list(value_concepts()) + [f"{n}_{way}" for n in signed_concepts() for way in ("in", "out")]
# Reported with the sign flipped.
FLIPPED = {"repurchases", "due_cdt", "gmf", "pay_findeter", "expense_sebra"} | {f"{n}_out" for n in signed_concepts()}


def derived_code(conf: Settings = DEFAULT) -> Column:
    """Accounting code of a movement without a concept, from its operation."""
    kind, side, suffix = F.col("clasificacion"), F.col("tipo_operacion"), F.right("liquidacion", F.lit(2))
    spot = F.col("fecha_futura").isNull()
    normal = F.when(suffix == "SB", conf.code_normal_sb).when(suffix == "OF", conf.code_normal_of).when(
        suffix.isNotNull(), conf.code_normal_other
    )
    simultaneous = F.when(
        side == "V", F.when(spot, conf.code_sim_sell_spot).otherwise(conf.code_sim_sell_future)
    ).when(side == "C", F.when(spot, conf.code_sim_buy_spot).otherwise(conf.code_sim_buy_future))
    repo = F.when(side == "C", conf.code_repo_buy).when(side == "V", conf.code_repo_sell)
    return (
        F.when(kind == "NORMAL", normal)
        .when(kind == "SIM", simultaneous)
        .when(kind == "TTV", conf.code_ttv)
        .when(kind == "REPO", repo)
    )


def concept_name(code: Column, mapped: Column, has_yield: Column, conf: Settings = DEFAULT) -> Column:
    """Report name of a concept code; unmapped codes stay visible under a marker."""
    named = F.when(has_yield, conf.yield_concept)
    for fixed_code, name in conf.named_codes.items():
        named = named.when(code == fixed_code, F.lit(name))
    return named.otherwise(F.coalesce(mapped, F.concat(F.lit(conf.unmapped_prefix), code)))


def signed(value: Column, conf: Settings = DEFAULT) -> Column:
    return F.when(F.col("cod_tipo_movimiento") == conf.debit_note, -value).otherwise(value)


def scan_unity_movements(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Row-level left join of the movements of each report date with their operations."""
    moves = on_dates(src["cc_movements"], "fecha", span, [MOVEMENTS])
    operations = of_window(src["unity_operations"].drop("fecha_cuadre"), "consecutivo", moves, "operacion")
    return moves.join(operations, moves["operacion"] == operations["consecutivo"], "left").drop("consecutivo")


def process_concept(moves: DataFrame, conf: Settings = DEFAULT) -> DataFrame:
    """Row-level concept derivation over ``scan_unity_movements``."""
    return moves.withColumn("concepto", F.coalesce("concepto", derived_code(conf)))


def process_value(moves: DataFrame, homologation: DataFrame, conf: Settings = DEFAULT) -> DataFrame:
    """Row-level concept naming and signing over ``process_concept``."""
    named = moves.join(homologation, moves["concepto"] == homologation["codigo_contable"], "left")
    name = concept_name(F.col("concepto"), F.col("concepto_cud"), F.col("rendimiento").isNotNull(), conf)
    return named.withColumns({"concepto": name, "valor": signed(F.col("valor"), conf)})


def summed_movements(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Movements of each report date with their operations, summed before the join.

    Columns: report_date, code, has_yield, sign, match_amount, amount (signed sum),
    gross (unsigned sum), n_rows. All rows of an operation and concept collapse,
    except that a movement whose concept is, or can still become, the third-party
    one keeps its signed amount in ``match_amount``: those are netted by amount.
    """
    conf = span.settings
    third_codes = held(
        src["homologation"]
        .where(F.col("concepto_cud") == conf.third_party_concept)
        .select(F.col("codigo_contable").alias("third_code"))
        .distinct()
    )
    moves = on_dates(src["cc_movements"], "fecha", span, [MOVEMENTS])
    if third_codes is None:
        # Not known here: every given concept may be a third-party one.
        may_be_given = F.col("concepto").isNotNull()
    else:
        moves = moves.join(third_codes, moves["concepto"] == third_codes["third_code"], "left")
        may_be_given = F.col("third_code").isNotNull()
    value = amount("valor")
    has_yield = F.col("rendimiento").isNotNull()
    undecided = F.col("concepto").isNull() & F.col("operacion").isNotNull()
    may_be_third = ~has_yield & (undecided | may_be_given)
    rows = moves.select(
        "operacion",
        "report_date",
        "concepto",
        has_yield.alias("has_yield"),
        signed(value, conf).alias("signed"),
        value.alias("value"),
        may_be_third.alias("may_be_third"),
    )
    per_operation = rows.groupBy(
        "operacion",
        "report_date",
        "concepto",
        "has_yield",
        F.signum(F.col("signed")).cast("int").alias("sign"),
        F.when(F.col("may_be_third"), F.col("signed")).alias("match_amount"),
    ).agg(
        F.sum("signed").cast(FACT).alias("amount"),
        F.sum("value").cast(FACT).alias("gross"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    asked = on_dates(src["cc_movements"], "fecha", span, [MOVEMENTS])
    known = of_window(src["unity_operations"], "consecutivo", asked, "operacion")
    derived = known.select("consecutivo", derived_code(conf).alias("derived"))
    operations = count_by(derived, "consecutivo", "derived")
    joined = per_operation.join(operations, per_operation["operacion"] == operations["consecutivo"], "left").withColumn(
        "n", F.coalesce("n", F.lit(1))
    )
    return joined.select(
        "report_date",
        F.coalesce("concepto", "derived").alias("code"),
        "has_yield",
        "sign",
        "match_amount",
        times_n(),
        times_n("gross"),
        (F.col("n_rows") * F.col("n")).alias("n_rows"),
    )


def concept_codes(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """(report_date, code): the concept codes, given or derived, of each report date's movements, once each."""
    moves = on_dates(src["cc_movements"], "fecha", span, [MOVEMENTS]).select("report_date", "operacion", "concepto")
    asked = moves.where("concepto IS NULL AND operacion IS NOT NULL").select("report_date", "operacion").distinct()
    operations = of_window(src["unity_operations"], "consecutivo", asked, "operacion")
    derived = operations.select("consecutivo", derived_code(span.settings).alias("code")).distinct()
    by_operation = asked.join(derived, asked["operacion"] == derived["consecutivo"]).select("report_date", "code")
    given = moves.select("report_date", F.col("concepto").alias("code"))
    return given.union(by_operation).where("code IS NOT NULL").distinct()


def named_movements(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """``summed_movements`` under their concept names; only third-party ones keep a match_amount."""
    conf, summed = span.settings, summed_movements(span, src)
    names = src["homologation"].select("codigo_contable", "concepto_cud")
    local = held(names)
    named = summed.join(names if local is None else local, F.col("code") == F.col("codigo_contable"), "left")
    name = concept_name(F.col("code"), F.col("concepto_cud"), F.col("has_yield"), conf)
    return named.select(
        "report_date",
        name.alias("name"),
        "sign",
        F.when(name == conf.third_party_concept, F.col("match_amount")).alias("match_amount"),
        "amount",
        "n_rows",
    )


def concept_derivation(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Movements per (given or derived) concept code."""
    return summed_movements(span, src).groupBy("report_date", F.col("code").alias("concepto")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("gross").alias("total")
    )


def concept_homologation(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Signed movements per concept name."""
    return named_movements(span, src).groupBy("report_date", F.col("name").alias("concepto")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("total")
    )


def unmapped_concepts(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """Concepts without a homologation, for the master's owners."""
    rows = concept_homologation(span, src).where(F.col("concepto").startswith(span.settings.unmapped_prefix))
    return rows.groupBy("concepto").agg(F.sum("n_rows").alias("n_rows"))


def third_party_facts(span: ReportSpan, src: Mapping[str, DataFrame], count_rows: bool = False) -> DataFrame:
    """Concept totals, and third-party movements with the amount they are netted by; see ``netted``."""
    conf = span.settings
    name, sign, value = F.col("name"), F.col("sign"), F.col("amount")
    way = F.when(sign > 0, "_in").when(sign < 0, "_out")
    family = one_of({m: name.isin(c) for m, c in signed_concepts(conf).items()})
    value_metric = one_of({m: name.isin(c) for m, c in value_concepts(conf).items()})
    third = F.when(name == conf.third_party_concept, F.concat(F.lit("third"), way))
    entries = [entry(value_metric, value), entry(F.concat(family, way), value), entry(third, value)]
    if count_rows:
        n, unnamed = F.col("n_rows"), name.isNull() | name.startswith(conf.unmapped_prefix)
        entries += [*losses.counted("cc_movements", sign.isNull(), n), losses.unmatched("cc_movements", unnamed, n)]
    facts = tagged(named_movements(span, src), entries, keep=("report_date", "match_amount"))
    return facts.withColumn("match_amount", F.col("match_amount").cast(AMOUNT))


def netted(facts: DataFrame) -> DataFrame:
    """``facts`` without third-party movements whose amount a credit transfer of the date has, and without transfers.

    One row per date, amount and metric comes together, so that a list holds one row per
    metric at most; nothing is read twice and no list of amounts is kept.
    """
    summed = facts.groupBy("report_date", "match_amount", "metric").agg(F.sum("amount").cast(FACT).alias("amount"))
    by_amount = summed.groupBy("report_date", "match_amount").agg(F.collect_list(F.struct("metric", "amount")).alias("facts"))
    credited = F.col("match_amount").isNotNull() & F.exists("facts", lambda f: f["metric"] == TRANSFER)
    kept = F.filter("facts", lambda f: (f["metric"] != TRANSFER) & ~(credited & f["metric"].isin(THIRD_METRICS)))
    return by_amount.select("report_date", F.inline(kept))


def movement_facts(
    span: ReportSpan, src: Mapping[str, DataFrame], credits: DataFrame | None = None
) -> DataFrame:
    """Concept totals; with ``credits`` (report_date, amount) also the third-party
    movements whose amount is not among the credit transfers of the date."""
    facts = third_party_facts(span, src)
    if credits is None:
        return facts.where(~F.col("metric").isin(THIRD_METRICS)).drop("match_amount")
    transfers = credits.select(
        "report_date",
        F.lit(TRANSFER).alias("metric"),
        F.lit(0).cast(FACT).alias("amount"),
        F.col("amount").cast(AMOUNT).alias("match_amount"),
    )
    return netted(facts.unionByName(transfers))


def unity_totals(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """The concept totals with expenses turned positive, plus the instant-payment amounts of the settings."""
    conf = span.settings
    wide = per_report_date(span, movement_facts(span, src), METRICS)
    return wide.select(
        "report_date",
        *[(-F.col(m) if m in FLIPPED else F.col(m)).alias(m) for m in METRICS],
        F.lit(conf.instant_payment_income).cast(FACT).alias("breb_in"),
        F.lit(conf.instant_payment_expense).cast(FACT).alias("breb_out"),
    )
