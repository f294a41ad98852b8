"""Settings of an institution: defaults, checks, several institutions in one session."""

from dataclasses import fields, replace
from datetime import date, datetime

import pytest

from florin import params
from florin.operators import banks, channels, deposits, movements, refunds
from florin.operators.merge import read_partitioned
from florin.plans import daily, job
from florin.plans.incremental import run_incremental, statements_of
from florin.settings import DEFAULT, Settings, settings_of
from tiny import one, span_of, tiny_sources

DAY = date(2024, 1, 10)
T0 = date(2024, 1, 9)  # bank date of DAY
OTHER = Settings(
    holder="OTHER",
    central_bank_accounts={"central": ["1"]},
    commercial_accounts={"payroll": ("2", "3")},
    usd_accounts={"dollars": ["4"]},
    withdrawal_slots=[("00:00:00", "11:59:59"), ("12:00:00", "23:59:59")],
    deposit_slots=[("00:00:00", "23:59:59")],
    ach_withdrawal="OUT",
    ach_deposit="IN",
    cycles=2,
    late_cycle=2,
    originator_account="99",
)


def balance(account, final, holder):
    return {
        "numero_cuenta": account,
        "nombre_titular_cuenta": holder,
        "saldo_bancario_final": final,
        "saldo_en_canje": 0.0,
        "fecha_movimiento": T0,
    }


BALANCES = [
    balance("1", 7.0, "X"),
    balance("2", 10.0, "OTHER"),
    balance("3", 20.0, "OTHER"),
    balance("3", 500.0, params.HOLDER),
    balance("4", 2.0, "OTHER"),
    balance("62015990", 1000.0, "X"),
    balance("423816990", 4000.0, params.HOLDER),
]
RATES = [{"valor": 100.0, "vigencia_desde": date(2020, 1, 1), "vigencia_hasta": date(9999, 12, 31)}]


def test_defaults_are_the_fixed_values():
    for f in fields(Settings):
        assert getattr(DEFAULT, f.name) == getattr(params, f.name.upper()), f.name
    assert DEFAULT.transfer_channels == params.TRANSFER_CHANNELS


def available(span, src):
    return daily.available_balances(daily.available_metrics(span, src), span.settings)


def test_two_institutions_in_one_session(spark):
    src, span = tiny_sources(spark, bank_balances=BALANCES, trm=RATES), span_of(spark, DAY)
    ours = one(daily.available_funds(available(span, src), "t0"))
    theirs = one(daily.available_funds(available(span.under(OTHER), src), "t0"))
    assert (ours["banco_republica"], ours["bancos_comerciales"], ours["bancos_usd"]) == (1000, 4000, 0)
    assert (theirs["banco_republica"], theirs["bancos_comerciales"], theirs["bancos_usd"]) == (7, 30, 200)
    wide = banks.bank_account_balances(span.under(OTHER), src).where("cut = 't0'")
    assert wide.columns == ["report_date", "cut", "central", "payroll", "dollars"]


def test_a_kind_of_account_that_an_institution_lacks(spark):
    src = tiny_sources(spark, bank_balances=BALANCES, trm=RATES)
    bare = replace(OTHER, commercial_accounts={}, usd_accounts={})
    row = one(daily.available_funds(available(span_of(spark, DAY).under(bare), src), "t0"))
    assert (row["banco_republica"], row["bancos_comerciales"], row["bancos_usd"], row["total"]) == (7, 0, 0, 7)


def test_bank_dates_follow_the_cutover(spark):
    early = span_of(spark, DAY).under(replace(DEFAULT, bank_cutover=date(2024, 1, 1)))
    cuts = {r.cut: r.source_date for r in early.bridge.collect() if r.cut.startswith("bank_")}
    usual = {r.cut: r.source_date for r in span_of(spark, DAY).bridge.collect() if r.cut.startswith("bank_")}
    assert usual == {"bank_t0": T0, "bank_t1": DAY} == cuts
    monday = span_of(spark, date(2024, 1, 15))
    of = {r.cut: r.source_date for r in monday.bridge.collect()}
    late = {r.cut: r.source_date for r in monday.under(early.settings).bridge.collect()}
    assert (of["bank_t0"], late["bank_t0"]) == (date(2024, 1, 14), date(2024, 1, 12))


def channel_rows(spark):
    at = lambda hour: datetime(2024, 1, 10, hour)
    rows = [("OUT", -5.0, at(9)), ("OUT", -6.0, at(13)), ("IN", 3.0, at(20)), (params.ACH_WITHDRAWAL, -100.0, at(9))]
    names = {name: i for i, name in enumerate(dict.fromkeys(r[0] for r in rows))}
    return tiny_sources(
        spark,
        channels=[{"clave_codificada": i, "nombre": name} for name, i in names.items()],
        accounts=[{"clave_codificada": 1, "id": "A", "version": 1}],
        transactions=[
            {"clave_cuenta_padre": 1, "clave_canal": names[c], "monto": v, "fecha_valor": DAY, "fecha_hora_valor": t}
            for c, v, t in rows
        ],
        trm=RATES,
    )


def test_any_number_of_time_slots(spark):
    src, span = channel_rows(spark), span_of(spark, DAY).under(OTHER)
    row = one(channels.ach_time_slots(span, src))
    assert {k: v for k, v in row.items() if k != "report_date"} == {"ret_0": 5, "ret_1": 6, "dep_0": 3, "dev_0": 0}
    flow = one(daily.ach_net_flow(daily.daily_metrics(span, src), OTHER))
    assert (flow["income_ach"], flow["outcome_ach"]) == (3, 11)
    assert one(channels.ach_time_slots(span_of(spark, DAY), src))["ret_1"] == 100


def test_cycles_of_refunds(spark):
    rows = [
        {"name": f"ach.{cycle}.OUT", "status": "unauthorized", "reg6_valor_transaccion": f"{10 ** cycle}00", "fecha_consulta": DAY}
        for cycle in (1, 2, 3)
    ]
    src, span = tiny_sources(spark, adapter=rows), span_of(spark, DAY).under(OTHER)
    row = one(refunds.ach_refunds(span, src))
    assert [k for k in row if k != "report_date"] == ["cud_1", "cud_2", "send_0", "send_1", "send_2"]
    assert (row["cud_1"], row["cud_2"], row["send_1"]) == (10, 100, 10)


def test_own_accounts_of_the_holder(spark):
    umbrella = [
        {"cuenta_bancaria": "0021", "titular": "OTHER", "estado": params.ACTIVE},
        {"cuenta_bancaria": "0022", "titular": params.HOLDER, "estado": params.ACTIVE},
    ]
    moves = [{"cuenta_bancaria": a, "fecha_mvto": DAY, "moneda": "COP", "monto": v} for a, v in (("21", 1.0), ("22", 2.0))]
    src, span = tiny_sources(spark, umbrella=umbrella, multicash=moves), span_of(spark, DAY)
    assert one(deposits.bank_transaction_totals(span, src))["cop_in"] == 2
    assert one(deposits.bank_transaction_totals(span.under(OTHER), src))["cop_in"] == 1


LINES = replace(
    DEFAULT,
    income_statement={"banks": "cop_in + instant_income", "dollars-in": "usd_income"},
    expense_statement={"fees": "ABS(cop_out) + instant_expense"},
    instant_payment_income="0.25",
    instant_payment_expense=2,
)
MOVES = [{"cuenta_bancaria": "21", "fecha_mvto": DAY, "moneda": "COP", "monto": v} for v in (10.5, -4.0)]
OWN = [{"cuenta_bancaria": "0021", "titular": params.HOLDER, "estado": params.ACTIVE}]


def test_lines_of_an_institution(spark):
    src, span = tiny_sources(spark, multicash=MOVES, umbrella=OWN, trm=RATES), span_of(spark, DAY).under(LINES)
    stated = daily.report(span, src)
    income, expense, summary = (one(t(stated)) for t in (daily.income_statement, daily.expense_statement, daily.cash_summary))
    assert income == {"banks": 10.75, "dollars-in": 0, "total": 10.75, "fecha_reporte": DAY}
    assert expense == {"fees": 6, "total": 6, "fecha_reporte": DAY}
    assert summary["total_flujo"] == 4.75
    usual = daily.report(span_of(spark, DAY), src)
    assert list(one(daily.income_statement(usual)))[:-2] == params.INCOME_LINES
    assert one(daily.income_statement(usual))["060_multicash_cop"] == 10.5
    totals = one(movements.unity_totals(span, src))
    assert (totals["breb_in"], totals["breb_out"]) == (0.25, 2)


def test_the_job_writes_the_lines_of_the_settings(spark, tmp_path):
    src = tiny_sources(spark, multicash=MOVES, umbrella=OWN, trm=RATES)
    paths = {name: str(tmp_path / name) for name in ("income", "expense", "available", "summary", "report", "long_report")}
    job.run_for(spark, src, job.Targets(**paths), DAY.isoformat(), settings=LINES)
    # Other lines become new columns of the same table; what the merge does not have stays.
    job.run_for(spark, src, job.Targets(**paths), DAY.isoformat())
    written = {r["fecha_reporte"]: r for r in read_partitioned(spark, paths["income"]).collect()}
    assert written[DAY]["060_multicash_cop"] == 10.5 and written[DAY]["banks"] == 10.75
    job.run_for(spark, src, job.Targets(**paths), DAY.isoformat(), settings=LINES)
    lines = spark.read.option("header", True).csv(paths["report"])
    named = {(r["section"], r["metric"]): r[DAY.isoformat()] for r in lines.collect()}
    assert float(named[params.SECTION_INCOME, "dollars-in"]) == 0 and float(named[params.SECTION_EXPENSE, "fees"]) == 6
    assert len(named) == 3 + 2 + 5 + 5 + 4


def test_stored_statements_have_the_lines_of_the_asked_settings(spark, tmp_path):
    src, span, folder = tiny_sources(spark, multicash=MOVES, umbrella=OWN, trm=RATES), span_of(spark, DAY), str(tmp_path / "run")
    run_incremental(span.under(LINES), src, folder)
    run_incremental(span, src, folder)
    assert run_incremental(span.under(LINES), src, folder) == [DAY]
    stored = statements_of(span.under(LINES), folder)
    assert one(daily.income_statement(stored)) == one(daily.income_statement(daily.report(span.under(LINES), src)))


def test_a_line_that_cannot_be_planned_fails_by_its_name(spark):
    src = tiny_sources(spark)
    for sql in ("no_such_metric + 1", "cop_in +", "SUM(cop_in)"):
        wrong = replace(LINES, expense_statement={"fine": "cop_out", "wrong_one": sql})
        with pytest.raises(ValueError, match="expense_wrong_one"):
            daily.report(span_of(spark, DAY).under(wrong), src)


def test_other_settings_compute_all_dates_again(spark, tmp_path):
    src, span, folder = tiny_sources(spark, bank_balances=BALANCES, trm=RATES), span_of(spark, DAY), str(tmp_path / "run")
    assert run_incremental(span, src, folder) == [DAY]
    assert run_incremental(span, src, folder) == []
    assert run_incremental(span.under(OTHER), src, folder) == [DAY]
    assert run_incremental(span.under(OTHER), src, folder) == []
    assert float(statements_of(span, folder).first()["t0_banco_republica"]) == 7


def test_the_job_takes_settings(spark, tmp_path):
    src = tiny_sources(spark, bank_balances=BALANCES, trm=RATES)
    targets = job.Targets(*(str(tmp_path / name) for name in ("income", "expense", "available", "summary")))
    stated = job.run_for(spark, src, targets, DAY.isoformat(), settings=OTHER)
    by_day = {r.report_date: r for r in stated.collect()}
    assert float(by_day[DAY]["t0_bancos_comerciales"]) == 30


def test_settings_from_json():
    given = settings_of({"holder": "H", "bank_cutover": "2025-02-01", "withdrawal_slots": [["00:00:00", "23:59:59"]]})
    assert (given.holder, given.bank_cutover, given.withdrawal_slots) == ("H", date(2025, 2, 1), [("00:00:00", "23:59:59")])
    assert given.cycles == params.CYCLES
    with pytest.raises(ValueError, match="holdr"):
        settings_of({"holdr": "H"})


@pytest.mark.parametrize(
    "wrong",
    [
        {"usd_accounts": {"trm": ["1"]}},
        {"usd_accounts": {"a b": ["1"]}},
        {"commercial_accounts": {"banrep_rem": ["1"]}},
        {"commercial_accounts": {"USD_BOFA_clearing": ["1"]}},
        {"withdrawal_slots": [("09:00:00", "08:00:00")]},
        {"deposit_slots": [("00:00:00", "09:00:00"), ("09:00:00", "10:00:00")]},
        {"deposit_slots": [("24:00:00", "24:00:01")]},
        {"late_cycle": 6},
        {"income_statement": {}},
        {"income_statement": {"total": "0"}},
        {"income_statement": {"a b": "0"}},
        {"expense_statement": {"a": "0", "A": "1"}},
        {"expense_statement": {"a": " "}},
        {"instant_payment_income": "many"},
        {"instant_payment_expense": "NaN"},
        {"instant_payment_expense": "0.00001"},
    ],
)
def test_wrong_settings_fail(wrong):
    with pytest.raises(ValueError):
        settings_of(wrong)


def test_digest_tells_settings_apart():
    assert DEFAULT.digest() == Settings().digest() != OTHER.digest()
    assert replace(OTHER, holder="X").digest() != OTHER.digest()
    turned = replace(LINES, income_statement=dict(reversed(LINES.income_statement.items())))
    assert turned.digest() != LINES.digest() == replace(LINES, instant_payment_expense="2.0").digest()
