"""Backfills that recompute only the report dates whose sources have changed.

With every run a count and a checksum of each source's parts is stored: a part is a source
date, or, of a source without dates of its own, a hash range of its key. A changed part
leads to report dates through the bridge, or through the rows of the dated source that its
key is joined to (a concept name: through the codes, given or derived, of the movements);
these dates are computed again, all others keep their stored rows.

Checksums are sums of row hashes: they depend on neither order nor files. The state is
read before the report, so that what changes while it runs is found by the next run.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.operators.merge import existing, upsert
from florin.operators.movements import concept_codes
from florin.operators.report_dates import (
    BANK_T0,
    BANK_T1,
    MOVEMENTS,
    PREVIOUS,
    REPORT,
    STATEMENTS,
    ReportSpan,
    listed_span,
    on_dates,
)
from florin.plans import daily
from florin.session import cut_lineage

# Source -> its date, and the cuts by which a report date reads it.
DATED = {
    "bank_balances": ("fecha_movimiento", [BANK_T0, BANK_T1]),
    "money_market": ("fecha_cumplimiento", [REPORT]),
    "cc_movements": ("fecha", [MOVEMENTS]),
    "multicash": ("fecha_mvto", [STATEMENTS]),
    "renewals": ("fecha_operacion", [REPORT]),
    "operations_a": ("fecha_inicio", [REPORT]),
    "derivatives": ("fecha_inicial", [PREVIOUS]),
    "transactions": ("fecha_valor", [REPORT]),
    "balance": ("fecha_saldo", [REPORT, PREVIOUS]),
    "adapter": ("fecha_consulta", [REPORT, PREVIOUS]),
}
# Source without a date -> its key, and the keys of the dated sources that it is joined to.
KEYED = {
    "unity_operations": ("consecutivo", [("cc_movements", "operacion"), ("money_market", "consecutivo")]),
    "operations_b": ("id_padre", [("operations_a", "id")]),
    "accounts": ("clave_codificada", [("transactions", "clave_cuenta_padre")]),
    "channels": ("clave_codificada", [("transactions", "clave_canal")]),
    "deposit_account": ("id_cuenta_deposito", [("balance", "id_cuenta")]),
    "umbrella": ("cuenta_bancaria", [("multicash", "cuenta_bancaria")]),
}
# Concept names are joined to codes that are in part derived: see ``movements.concept_codes``.
CONCEPTS, CONCEPT_KEY = "homologation", "codigo_contable"
# A change of the settings concerns every date; they are a part of their own.
SETTINGS = "settings"
RATES = "trm"  # valid from day to day: a part is a day
RATE_CUTS = [PREVIOUS, REPORT]
KEY_RANGES = 1 << 20


def _key_part(key: str) -> Column:
    """The hash range of a key, equal for all forms in which the report joins it."""
    text = F.ltrim(F.col(key).cast("string"), F.lit("0"))
    return F.pmod(F.xxhash64(text), F.lit(KEY_RANGES))


# A row hash is summed in three pieces, lowest first: as longs, that 2^39 rows of a part do not overflow.
PIECES = (20, 20, 24)


def _checksum() -> Column:
    """The sum of the row hashes, out of the sums of their pieces."""
    low, middle, high = (F.col(f"_sum{i}").cast("decimal(20,0)") for i in range(3))
    scale = [F.lit(1 << sum(PIECES[:i])).cast("decimal(13,0)") for i in (1, 2)]
    return (high * scale[1] + middle * scale[0] + low).cast("decimal(38,0)")


def _summed(rows: DataFrame, source: str, part: Column) -> DataFrame:
    """(source, part, n, checksum): parts are compared as they are and become text once summed."""
    hashed = rows.select(part.alias("part"), F.xxhash64(*[F.col(c) for c in rows.columns]).alias("_hash"))
    mask = F.lit((1 << PIECES[0]) - 1).cast("bigint")
    pieces = [
        F.col("_hash").bitwiseAND(mask),
        F.shiftright("_hash", PIECES[0]).bitwiseAND(mask),
        F.shiftright("_hash", PIECES[0] + PIECES[1]),
    ]
    sums = [F.sum(piece).alias(f"_sum{i}") for i, piece in enumerate(pieces)]
    return hashed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *sums).select(
        F.lit(source).alias("source"), F.col("part").cast("string").alias("part"), "n", _checksum().alias("checksum")
    )


def _read_dates(span: ReportSpan, source: str) -> DataFrame:
    """(report_date, part) of a dated source."""
    cuts = RATE_CUTS if source == RATES else DATED[source][1]
    return span.bridge_for(cuts).select("report_date", F.col("source_date").cast("string").alias("part"))


def source_state(span: ReportSpan, src: Mapping[str, DataFrame]) -> DataFrame:
    """(source, part, n, checksum) of all that the report dates read."""
    parts = []
    for source, (day, cuts) in DATED.items():
        rows = src[source].where(span.reads(day, cuts))
        parts.append(_summed(rows, source, F.col(day)))
    for source, key in [*((s, key) for s, (key, _) in KEYED.items()), (CONCEPTS, CONCEPT_KEY)]:
        parts.append(_summed(src[source], source, _key_part(key)))
    first, last = (F.lit(d) for d in span.source_bounds)
    valid = src[RATES].where("vigencia_desde <= vigencia_hasta").where((F.col("vigencia_desde") <= last) & (F.col("vigencia_hasta") >= first))
    days = F.sequence(F.greatest("vigencia_desde", first), F.least("vigencia_hasta", last))
    by_day = valid.select("valor", F.explode(days).alias("fecha"))
    parts.append(_summed(by_day, RATES, F.col("fecha")))
    told = F.lit(span.settings.digest()).alias("digest")
    parts.append(_summed(span.anchors.sparkSession.range(0, 1, 1, 1).select(told), SETTINGS, F.lit("all")))
    return reduce(DataFrame.unionByName, parts)


def changed_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(source, part) of the parts that are new, gone or different."""
    counted = before.unionByName(after).groupBy("source", "part", "n", "checksum").agg(F.count(F.lit(1)).alias("sides"))
    return counted.where("sides < 2").select("source", "part").distinct()


def dates_to_redo(span: ReportSpan, src: Mapping[str, DataFrame], changes: DataFrame) -> list[date]:
    """The report dates of the span that read a changed part; the driver gets these dates only."""
    concerned = {r[0] for r in changes.select("source").distinct().collect()}
    if SETTINGS in concerned:
        return sorted(r[0] for r in span.listed.distinct().collect())
    if not concerned:
        return []

    def of(source: str) -> DataFrame:
        return changes.where(F.col("source") == source).select("part")

    found = [
        _read_dates(span, source).join(of(source), "part", "left_semi") for source in [*DATED, RATES] if source in concerned
    ]
    for source in concerned & set(KEYED):
        for partner, key in KEYED[source][1]:
            day, cuts = DATED[partner]
            rows = on_dates(src[partner], day, span, cuts).select("report_date", _key_part(key).cast("string").alias("part")).distinct()
            found.append(rows.join(of(source), "part", "left_semi"))
    if CONCEPTS in concerned:
        rows = concept_codes(span, src).select("report_date", _key_part("code").cast("string").alias("part")).distinct()
        found.append(rows.join(of(CONCEPTS), "part", "left_semi"))
    days = reduce(DataFrame.union, [f.select("report_date") for f in found]).distinct()
    return sorted(r[0] for r in days.collect())


def refreshed(
    span: ReportSpan, src: Mapping[str, DataFrame], state: DataFrame, stored_state: DataFrame, stored: DataFrame
) -> tuple[DataFrame | None, list[date]]:
    """The statements of the dates to compute again, None where there are none, and these dates.

    ``stored`` are statements of an earlier run; report dates that it lacks are computed, too.
    """
    changes = cut_lineage(changed_parts(stored_state, state))
    absent = span.listed.join(stored.select("report_date"), "report_date", "left_anti").distinct().collect()
    days = sorted({r[0] for r in absent} | set(dates_to_redo(span, src, changes)))
    if not days:
        return None, []
    again = listed_span(span.anchors.sparkSession, days).under(span.settings)
    return daily.report(again, src), days


def run_incremental(span: ReportSpan, src: Mapping[str, DataFrame], folder: str) -> list[date]:
    """Bring the statements under ``folder`` up to date; returns the report dates that were computed.

    The statements are written before the state: a run that ends between the two repeats
    its dates the next time. Without a stored state every date is computed.
    """
    spark = span.anchors.sparkSession
    kept, notes = f"{folder.rstrip('/')}/statements", f"{folder.rstrip('/')}/state"
    state = cut_lineage(source_state(span, src))
    stored, stored_state = existing(spark, kept), existing(spark, notes)
    if stored is None or stored_state is None:
        days = sorted(r[0] for r in span.listed.distinct().collect())
        stated = daily.report(span, src)
    else:
        stated, days = refreshed(span, src, state, stored_state, stored)
        # Parts that only other report dates read stay as they were.
        read = reduce(DataFrame.union, [_read_dates(span, s).select(F.lit(s).alias("source"), "part") for s in [*DATED, RATES]])
        dated = F.col("source").isin([*DATED, RATES])
        others = stored_state.where(dated).join(read, ["source", "part"], "left_anti")
        others = others.join(state.where(dated).select("source", "part"), ["source", "part"], "left_anti")
        # What is left of the stored state is read before it is overwritten; the new one lies stored already.
        state = state.unionByName(cut_lineage(others))
    if stated is not None:
        upsert(stated, kept, ["report_date"], ["report_date"])
    state.write.mode("overwrite").parquet(notes)
    return days


def statements_of(span: ReportSpan, folder: str) -> DataFrame:
    """The stored statements of the span's report dates, with the lines of its settings in their order.

    Lines that only runs under other settings had are left out.
    """
    stored, conf = existing(span.anchors.sparkSession, f"{folder.rstrip('/')}/statements"), span.settings
    lines = [f"income_{n}" for n in conf.income_statement] + [f"expense_{n}" for n in conf.expense_statement]
    own = [c for c in stored.columns if c.endswith("_total") or not c.startswith(("income_", "expense_"))]
    kept = stored.select(*[F.col(f"`{c}`") for c in own if c not in lines], *[F.col(f"`{c}`") for c in lines])
    return kept.join(span.listed.distinct(), "report_date", "left_semi")
