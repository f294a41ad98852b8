"""Runs that compute only the report dates whose sources changed, uncounted rows, and checks of the sources."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from florin import params
from florin.operators import losses, movements
from florin.operators.merge import read_partitioned
from florin.operators.report_dates import business_day_span, window_span
from florin.plans import daily, incremental, job
from florin.plans.incremental import run_incremental, source_state, statements_of
from florin.sources.catalog import CONTRACTS, from_frames
from florin.sources.samples import sample_sources
from tiny import schema_of, span_of, tiny_sources

SF_DIR = "/root/testdata/sf0.001"
FIRST, LAST = date(2024, 1, 9), date(2024, 1, 19)


@pytest.fixture(scope="module")
def sample(spark):
    """The sample sources, stored, so that a change is one frame in another's place."""
    src = sample_sources(spark, SF_DIR)
    frames = {n: src[n].cache() for n in CONTRACTS}
    yield frames
    for frame in frames.values():
        frame.unpersist()


def rows(df):
    return sorted(map(repr, df.collect()))


def without_one(frame, condition):
    """All rows but one of those that meet the condition."""
    lost = frame.where(condition).limit(1)
    return frame.exceptAll(lost)


DAY = date(2024, 1, 16)
# Source -> which of its rows goes, and the report dates that read it (business days; the 15th follows the 12th).
CHANGES = {
    "transactions": (f"fecha_valor = DATE '{DAY}'", [DAY]),
    "adapter": (f"fecha_consulta = DATE '{DAY}'", [DAY, date(2024, 1, 17)]),
    "balance": (f"fecha_saldo = DATE '{DAY}'", [DAY, date(2024, 1, 17)]),
    "money_market": (f"fecha_cumplimiento = DATE '{DAY}'", [DAY]),
    "multicash": ("fecha_mvto = DATE '2024-01-13'", [date(2024, 1, 12)]),
    "cc_movements": ("fecha = DATE '2024-01-14'", [date(2024, 1, 15)]),
    "renewals": ("fecha_operacion = DATE '2024-03-03'", []),
}


@pytest.mark.parametrize("source", sorted(CHANGES))
def test_a_change_on_one_date_computes_the_dates_that_read_it(spark, sample, tmp_path, source):
    condition, expected = CHANGES[source]
    span = business_day_span(spark, FIRST, LAST)
    early = {**sample, source: without_one(sample[source], condition)}
    folder = str(tmp_path / "run")
    assert len(run_incremental(span, from_frames(spark, early), folder)) == 9
    src = from_frames(spark, sample)
    assert run_incremental(span, src, folder) == expected
    assert run_incremental(span, src, folder) == []
    whole = daily.statements(daily.daily_metrics(span, src))
    assert rows(statements_of(span, folder).select(*whole.columns)) == rows(whole)


def test_changes_of_sources_without_dates(spark, sample, tmp_path):
    """A key leads to the dates on which it occurs, a rate to the days it is valid, a concept name to its code's dates."""
    span, folder = business_day_span(spark, FIRST, LAST), str(tmp_path / "run")
    src = from_frames(spark, sample)
    run_incremental(span, src, folder)

    used = sample["transactions"].where(F.col("fecha_valor").between(FIRST, LAST)).select("clave_cuenta_padre", "fecha_valor")
    account, = used.where(f"fecha_valor = DATE '{DAY}'").first()[:1]
    days = {r[0] for r in used.where(F.col("clave_cuenta_padre") == account).select("fecha_valor").distinct().collect()}
    newer = sample["accounts"].limit(1).select(
        F.lit(account).cast(sample["accounts"].schema["clave_codificada"].dataType).alias("clave_codificada"),
        F.lit(params.CREDIT_ACCOUNT).alias("id"),
        F.lit(datetime(2030, 1, 1)).alias("fecha_ultima_modificacion"),
        F.lit(1).cast(sample["accounts"].schema["version"].dataType).alias("version"),
    )
    changed = {**sample, "accounts": sample["accounts"].unionByName(newer)}
    open_days = set(job.report_days(span))
    assert set(run_incremental(span, from_frames(spark, changed), folder)) == days & open_days

    rate = spark.createDataFrame([(1.0, DAY, DAY)], "valor double, vigencia_desde date, vigencia_hasta date")
    changed["trm"] = sample["trm"].unionByName(rate.select(*[F.col(c).cast(sample["trm"].schema[c].dataType) for c in sample["trm"].columns]))
    assert run_incremental(span, from_frames(spark, changed), folder) == [DAY, date(2024, 1, 17)]

    by_code = {}
    for r in movements.concept_derivation(span, src).collect():
        by_code.setdefault(r["concepto"], set()).add(r["report_date"])
    known = {r[0] for r in sample["homologation"].select("codigo_contable").collect()}
    code = min(known & set(by_code), key=lambda c: (len(by_code[c]), c))
    changed["homologation"] = sample["homologation"].where(F.col("codigo_contable") != code)
    assert run_incremental(span, from_frames(spark, changed), folder) == sorted(by_code[code])
    whole = daily.statements(daily.daily_metrics(span, from_frames(spark, changed)))
    assert rows(statements_of(span, folder).select(*whole.columns)) == rows(whole)


def test_a_concept_name_concerns_the_dates_of_its_code(spark, tmp_path):
    """Given codes and derived ones; a code that no date has, and one with leading zeros, which only redo too much."""
    days = [date(2024, 1, 10), date(2024, 1, 11), date(2024, 1, 12)]
    operation = {"consecutivo": 5, "clasificacion": "TTV"}
    moves = [
        {"fecha": days[0], "concepto": "7001", "valor": 3.0},
        {"fecha": days[1], "operacion": 5, "valor": 4.0},
        {"fecha": days[2], "operacion": 6, "valor": 5.0},
        {"fecha": days[2], "valor": 6.0},
    ]
    span, folder = span_of(spark, *days), str(tmp_path / "run")

    def src(**names):
        homologation = [{"codigo_contable": c, "concepto_cud": n} for c, n in names.items()]
        return tiny_sources(spark, cc_movements=moves, unity_operations=[operation] * 2, homologation=homologation)

    gmf = params.GMF_CONCEPT
    assert run_incremental(span, src(), folder) == days
    assert run_incremental(span, src(**{"9": gmf}), folder) == []
    assert run_incremental(span, src(**{"9": gmf, "7001": gmf}), folder) == days[:1]
    assert run_incremental(span, src(**{"7001": gmf, params.CODE_TTV: gmf}), folder) == days[1:2]
    found = statements_of(span, folder)
    whole = daily.report(span, src(**{"7001": gmf, params.CODE_TTV: gmf}))
    assert rows(found.select(*whole.columns)) == rows(whole)
    codes = {(r["report_date"], r["code"]) for r in movements.concept_codes(span, src()).collect()}
    assert codes == {(days[0], "7001"), (days[1], params.CODE_TTV)}


def test_other_spans_and_runs_that_end_early(spark, sample, tmp_path, monkeypatch):
    folder, src = str(tmp_path / "run"), from_frames(spark, sample)
    early, late = business_day_span(spark, FIRST, date(2024, 1, 12)), business_day_span(spark, date(2024, 1, 12), DAY)
    run_incremental(early, src, folder)
    assert run_incremental(late, src, folder)[-2:] == [date(2024, 1, 15), DAY]
    # What the first span alone reads is still known.
    assert run_incremental(early, src, folder) == []
    changed = from_frames(spark, {**sample, "transactions": without_one(sample["transactions"], f"fecha_valor = DATE '{DAY}'")})
    writer = type(spark.range(1).write)
    real = writer.parquet

    def ends(self, path, *args, **kwargs):
        if path.endswith("/state"):
            raise RuntimeError("the driver is gone")
        return real(self, path, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(writer, "parquet", ends)
        with pytest.raises(RuntimeError):
            run_incremental(late, changed, folder)
    assert run_incremental(late, changed, folder) == [DAY]
    whole = daily.statements(daily.daily_metrics(late, changed))
    assert rows(statements_of(late, folder).select(*whole.columns)) == rows(whole)


def test_checksums_are_exact_and_summed_as_longs(spark, sample):
    span, src = business_day_span(spark, FIRST, DAY), from_frames(spark, sample)
    state = source_state(span, src)
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert "RegExpReplace" not in plan and "regexp_replace" not in plan
    assert "sum(cast(xxhash64" not in plan
    found = {r["part"]: (r["n"], r["checksum"]) for r in state.where("source = 'accounts'").collect()}
    plain = {}
    text = F.regexp_replace(F.col("clave_codificada").cast("string"), "^0+", "")
    part = F.pmod(F.xxhash64(text), F.lit(incremental.KEY_RANGES)).cast("string")
    for key, value in src["accounts"].select(part, F.xxhash64(*src["accounts"].columns)).collect():
        n, total = plain.get(key, (0, 0))
        plain[key] = (n + 1, total + value)
    assert found and found == plain


def test_the_state_is_stored_once_a_run(spark, sample, tmp_path, monkeypatch):
    folder, src, span = str(tmp_path / "run"), from_frames(spark, sample), business_day_span(spark, FIRST, DAY)
    real, cut = incremental.cut_lineage, []

    def counting(frame):
        stored = real(frame)
        cut.append(stored.count())
        return stored

    monkeypatch.setattr(incremental, "cut_lineage", counting)
    run_incremental(span, src, folder)
    assert cut[1:] == []
    assert run_incremental(span, src, folder) == []
    # The state again, no change, and nothing of the stored state that other dates alone read.
    assert cut[1:] == [cut[0], 0, 0]


# --- rows that were not counted ---------------------------------------------------------


def test_uncounted_rows_by_hand(spark):
    day, before = date(2024, 1, 10), date(2024, 1, 9)
    refund = {"status": params.UNAUTHORIZED, "transaction_type": "_ach_out", "fecha_consulta": day, "reg6_valor_transaccion": "500"}
    pair = {"reg6_cuenta_receptora": "C", "reg5_nombre_originador": "O", "reg6_nombre_cliente_receptor": "N"}
    sides = {"reg6_entidad_receptora": "E", "reg5_entidad_originadora": "E"}
    src = tiny_sources(
        spark,
        transactions=[
            {"clave_cuenta_padre": 1, "clave_canal": 1, "monto": 5.0, "fecha_hora_valor": datetime(2024, 1, 10, 9), "fecha_valor": day},
            {"clave_cuenta_padre": 2, "clave_canal": 1, "monto": 5.0, "fecha_hora_valor": datetime(2024, 1, 10, 9), "fecha_valor": day},
            {"clave_cuenta_padre": 1, "clave_canal": 7, "monto": 5.0, "fecha_valor": day},
            {"clave_cuenta_padre": None, "clave_canal": None, "fecha_valor": day},
            {"clave_cuenta_padre": 1, "clave_canal": 1, "monto": 5.0, "fecha_valor": before},
        ],
        channels=[{"clave_codificada": 1, "nombre": params.ACH_DEPOSIT}],
        accounts=[{"clave_codificada": 1, "id": None, "version": i} for i in range(3)],
        adapter=[
            {**refund, "name": "a.1.OUT"},
            {**refund, "name": "a.x.OUT"},
            {**refund, "name": "a.2.OUT", "reg6_valor_transaccion": "abc00"},
            {**refund, **pair, **sides, "name": "a.5.OUT"},
            {**refund, **pair, **sides, "name": "a.5.OUT"},
            {**refund, **pair, **sides, "name": "", "transaction_type": params.SENT_REFUND},
            {**refund, "name": "anything", "status": "sent", "reg6_valor_transaccion": ""},
        ],
        multicash=[
            {"cuenta_bancaria": "777", "moneda": "COP", "monto": 1.0, "fecha_mvto": day},
            {"cuenta_bancaria": "8", "moneda": None, "monto": 1.0, "fecha_mvto": day},
        ],
        umbrella=[{"cuenta_bancaria": "0777", "titular": params.HOLDER, "estado": params.ACTIVE}] * 2,
    )
    found = {r["source"]: tuple(r)[2:] for r in daily.uncounted_rows(span_of(spark, day), src).collect()}
    assert found["transactions"] == (4, 3, 2)
    assert found["adapter"] == (7, 1, 2)
    assert found["multicash"] == (2, 1, 1)
    assert found["renewals"] == (0, 0, 0) and len(found) == len(losses.MEANINGS)


def test_counting_changes_no_metric(spark, sample):
    span, src = window_span(spark, date(2024, 1, 12)), from_frames(spark, sample)
    plain = daily.daily_metrics(span, src)
    counted = daily.daily_metrics(span, src, count_rows=True)
    assert rows(counted.select(*plain.columns)) == rows(plain)


def test_the_job_reports_uncounted_rows_from_its_stored_statements(spark, sample, tmp_path):
    span, src = window_span(spark, date(2024, 1, 12)), from_frames(spark, sample)
    paths = {n: str(tmp_path / n) for n in ("income", "expense", "available", "summary", "losses")}
    stated = job.run_report(span, src, job.Targets(**paths))
    found = losses.uncounted_rows(stated)
    assert rows(found) == rows(daily.uncounted_rows(span, src)) and found.count() == 5 * len(losses.MEANINGS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Exchange" not in plan and "InMemory" not in plan
    written = read_partitioned(spark, paths["losses"])
    assert written.agg(F.sum("rows_read")).first()[0] == found.agg(F.sum("rows_read")).first()[0]


# --- contracts ---------------------------------------------------------------------------


def typed(spark, table, **kinds):
    schema = schema_of(table)
    return spark.createDataFrame([], schema).select(*[F.col(c).cast(kinds.get(c, schema[c].dataType)).alias(c) for c in schema.names])


@pytest.mark.parametrize(
    "table,column,kind",
    [
        ("adapter", "fecha_consulta", "string"),
        ("transactions", "fecha_hora_valor", "date"),
        ("trm", "valor", "string"),
        ("umbrella", "titular", "int"),
        ("balance", "id_cuenta", "double"),
        ("balance", "fecha_saldo", "timestamp"),
    ],
)
def test_a_column_of_another_kind_fails_by_name(spark, table, column, kind):
    with pytest.raises(ValueError, match=f"source {table}: {column} is {kind}"):
        from_frames(spark, {table: typed(spark, table, **{column: kind})})[table]


def test_a_key_of_two_types_fails_by_name(spark):
    frames = {"balance": typed(spark, "balance", id_cuenta="string"), "deposit_account": typed(spark, "deposit_account")}
    for first, second in (frames, list(frames)[::-1]):
        src = from_frames(spark, frames)
        src[first]
        with pytest.raises(ValueError, match="balance.id_cuenta is a string, deposit_account.id_cuenta_deposito a number"):
            src[second]


def test_wider_and_narrower_kinds_are_fine(spark):
    src = from_frames(
        spark,
        {
            "balance": typed(spark, "balance", id_cuenta="int", total_balance="decimal(18,2)"),
            "deposit_account": typed(spark, "deposit_account", id_cuenta_deposito="decimal(20,0)"),
            "transactions": typed(spark, "transactions", fecha_hora_valor="timestamp_ntz", monto="int"),
        },
    )
    assert [src[n].count() for n in ("balance", "deposit_account", "transactions")] == [0, 0, 0]
