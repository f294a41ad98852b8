"""Hand-sized frames: golden values, NULLs, malformed text, empty sources."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from florin import params
from florin.operators import banks, channels, deposits, market, movements, refunds, securities
from florin.operators.facts import per_report_date
from florin.operators.report_dates import business_day_span
from florin.plans import daily, job
from tiny import one, span_of, tiny_sources

DAY = date(2024, 1, 10)
BEFORE = date(2024, 1, 9)
T0, T1 = date(2024, 1, 9), date(2024, 1, 10)  # bank dates of DAY


# --- banks ---------------------------------------------------------------------------


def balance(account, final, clearing=0.0, day=T0, holder=params.HOLDER):
    return {
        "numero_cuenta": account,
        "nombre_titular_cuenta": holder,
        "saldo_bancario_final": final,
        "saldo_en_canje": clearing,
        "fecha_movimiento": day,
    }


def rate(value, start=date(2020, 1, 1), end=date(9999, 12, 31)):
    return {"valor": value, "vigencia_desde": start, "vigencia_hasta": end}


def test_usd_balance_is_net_of_summed_clearing(spark):
    src = tiny_sources(spark, bank_balances=[balance("86110", 10000.0, 2500.0), balance("86110", 0.0, -500.0)])
    row = banks.bank_account_balances(span_of(spark, DAY), src).where("cut = 't0'").first()
    assert float(row.usd_cayman) == 8000.0  # 10000 - |2500 - 500|


def test_available_usd_of_seven_accounts(spark):
    accounts = [a for group in params.USD_ACCOUNTS.values() for a in group]
    src = tiny_sources(spark, bank_balances=[balance(a, 10.0) for a in accounts], trm=[rate(4000.0)])
    span = span_of(spark, DAY)
    row = one(daily.available_funds(daily.available_balances(daily.available_metrics(span, src)), "t0"))
    assert row["bancos_usd"] == 280000.0 and row["total"] == 280000.0 and row["trm"] == 4000.0


def test_holder_filter_applies_to_commercial_and_usd_only(spark):
    rows = [balance(a, 1.0, holder="OTHER") for a in ("62015990", "423816990", "86110")]
    rows.append(balance(None, 5.0))
    src = tiny_sources(spark, bank_balances=rows)
    row = banks.bank_account_balances(span_of(spark, DAY), src).where("cut = 't0'").first()
    assert (row.banrep_norem90, row.savings_occ, row.usd_cayman) == (1, 0, 0)


def test_rates_overlap_are_summed_and_gaps_are_zero(spark):
    src = tiny_sources(spark, trm=[rate(4000.0, BEFORE, BEFORE), rate(1.0, BEFORE, BEFORE), rate(9.0, DAY, BEFORE)])
    row = one(per_report_date(span_of(spark, DAY), banks.rate_facts(span_of(spark, DAY), src), banks.RATE_METRICS))
    assert (row["rate_t0"], row["rate_t1"]) == (4001.0, 0.0)


# --- money market --------------------------------------------------------------------


def trade(number, value, **values):
    base = {
        "consecutivo": number,
        "fecha_operacion": BEFORE,
        "fecha_cumplimiento": DAY,
        "cod_central_deposito": "DCV",
        "clasificacion": "NORMAL",
        "tipo_sim": "A",
        "codigo_especie": "CT01",
        "nemotecnico": "TFIT",
        "tipo_operacion": "V",
        "genera_detalle": "SI",
        "valor_de_giro": value,
    }
    return {**base, **values}


def control(number, day=DAY):
    return {"consecutivo": number, "fecha_cuadre": day}


def test_settlement_signs(spark):
    trades = [
        trade(1, 10.0, clasificacion="SIM", tipo_sim="A"),
        trade(2, 20.0, clasificacion="SIM", tipo_sim="P", tipo_operacion="C"),
        trade(3, 30.0),
        trade(4, 40.0, tipo_operacion="C"),
        trade(5, 50.0, clasificacion="TTV", cod_central_deposito=None),
        trade(6, 60.0, clasificacion="TTV", tipo_operacion="C"),
    ]
    src = tiny_sources(spark, money_market=trades, unity_operations=[control(i) for i in range(1, 7)])
    row = one(market.money_market_settlement(span_of(spark, DAY), src))
    assert (row["sim_tes_active"], row["sim_tes_passive"]) == (10, -20)
    assert (row["sell_tes"], row["buy_tes"], row["ttv_sell"], row["ttv_buy"]) == (30, -40, 50, -60)


def test_null_species_nemo_and_dates_match_nothing(spark):
    trades = [
        trade(1, 1.0, codigo_especie=None),
        trade(1, 2.0, nemotecnico=None),
        trade(1, 4.0, fecha_operacion=None),
        trade(1, 8.0, cod_central_deposito="XXX"),
        trade(1, 16.0, tipo_operacion="X"),
        trade(1, 32.0, tipo_operacion=None),
    ]
    src = tiny_sources(spark, money_market=trades, unity_operations=[control(1)])
    row = one(market.money_market_settlement(span_of(spark, DAY), src))
    assert all(v == 0 for k, v in row.items() if k != "report_date")


def test_species_pattern_is_unanchored_and_may_count_twice(spark):
    trades = [trade(1, 5.0, clasificacion="SIM", codigo_especie="XCTMM")]
    src = tiny_sources(spark, money_market=trades, unity_operations=[control(1)])
    row = one(market.money_market_settlement(span_of(spark, DAY), src))
    assert (row["sim_tes_active"], row["sim_priv_active"]) == (5, 5)


def test_control_date_must_be_the_settlement_date_and_repeats_count(spark):
    src = tiny_sources(
        spark,
        money_market=[trade(1, 5.0), trade(2, 7.0)],
        unity_operations=[control(1), control(1), control(2, BEFORE)],
    )
    row = one(market.money_market_settlement(span_of(spark, DAY), src))
    assert row["sell_tes"] == 10
    assert market.scan_money_market(span_of(spark, DAY), src).count() == 2


def test_same_day_repos_by_side(spark):
    trades = [
        trade(1, 1.0, clasificacion="REPO", fecha_operacion=DAY),
        trade(1, 2.0, clasificacion="REPO", fecha_operacion=DAY, tipo_sim="P", tipo_operacion="C"),
        trade(1, 4.0, nemotecnico=params.DOLLAR_NEMO, fecha_operacion=DAY, cod_central_deposito=None),
        trade(1, 8.0, nemotecnico=params.DOLLAR_NEMO, fecha_operacion=DAY, genera_detalle="NO"),
    ]
    src = tiny_sources(spark, money_market=trades, unity_operations=[control(1)])
    row = one(market.money_market_same_day(span_of(spark, DAY), src))
    assert (row["repo_active_sell"], row["repo_passive_buy"], row["dollar_sell"]) == (1, 2, 4)


# --- movements -----------------------------------------------------------------------


def move(value, concept=None, operation=None, kind="NC", gain=None, day=DAY):
    return {
        "operacion": operation,
        "concepto": concept,
        "valor": value,
        "cod_tipo_movimiento": kind,
        "fecha": day,
        "rendimiento": gain,
    }


def operation(number, kind, settlement=None, side=None, future=None):
    return {
        "consecutivo": number,
        "clasificacion": kind,
        "liquidacion": settlement,
        "tipo_operacion": side,
        "fecha_futura": future,
    }


def concepts(spark, **tables):
    rows = movements.concept_derivation(span_of(spark, DAY), tiny_sources(spark, **tables)).collect()
    return {r.concepto: (r.n_rows, float(r.total)) for r in rows}


def test_concept_branches(spark):
    operations = [
        operation(1, "NORMAL", "T0SB"),
        operation(2, "NORMAL", "T1OF"),
        operation(3, "NORMAL", "T2XX"),
        operation(4, "NORMAL", None),
        operation(5, "SIM", side="V"),
        operation(6, "SIM", side="V", future=DAY),
        operation(7, "SIM", side="C"),
        operation(8, "SIM", side="C", future=DAY),
        operation(9, "TTV"),
        operation(10, "REPO", side="C"),
        operation(11, "REPO", side="V"),
        operation(12, "SIM", side="X"),
        operation(13, "OTHER"),
    ]
    moves = [move(float(i), operation=i) for i in range(1, 14)] + [move(100.0, operation=99), move(200.0)]
    assert concepts(spark, cc_movements=moves, unity_operations=operations) == {
        "44206": (1, 1.0),
        "43420": (1, 2.0),
        "43422": (1, 3.0),
        "45495": (1, 5.0),
        "45435": (1, 6.0),
        "44495": (1, 7.0),
        "44435": (1, 8.0),
        "44211": (1, 9.0),
        "44481": (1, 10.0),
        "45431": (1, 11.0),
        None: (5, 329.0),
    }


def test_repeated_operations_repeat_the_movement(spark):
    src = tiny_sources(
        spark,
        cc_movements=[move(3.0, "310", 1), move(5.0, None, 1)],
        unity_operations=[operation(1, "TTV"), operation(1, "TTV"), operation(1, "REPO", side="C")],
    )
    span = span_of(spark, DAY)
    rows = movements.concept_derivation(span, src).collect()
    assert {r.concepto: (r.n_rows, float(r.total)) for r in rows} == {
        "310": (3, 9.0),
        "44211": (2, 10.0),
        "44481": (1, 5.0),
    }
    joined = movements.scan_unity_movements(span, src)
    assert joined.count() == 6
    by_row = movements.process_concept(joined).groupBy("concepto").agg(F.count("*").alias("n"), F.sum("valor").alias("v"))
    assert {r.concepto: (r.n, r.v) for r in by_row.collect()} == {"310": (3, 9.0), "44211": (2, 10.0), "44481": (1, 5.0)}


HOMOLOGATION = [
    {"codigo_contable": "7001", "codigo_cud": "k", "concepto_cud": "APR. OP CON DECEVAL RECURSOS PROPIOS"},
    {"codigo_contable": "7002", "codigo_cud": "l", "concepto_cud": params.THIRD_PARTY_CONCEPT},
    {"codigo_contable": "44211", "codigo_cud": "h", "concepto_cud": params.THIRD_PARTY_CONCEPT},
]


def test_concept_names_and_signs(spark):
    moves = [
        move(1.0, "310", kind="ND"),
        move(2.0, "389"),
        move(4.0, "366", kind="ND"),
        move(8.0, "362"),
        move(16.0, "7001", kind=None),
        move(32.0, "1234"),
        move(64.0, "310", gain=0.0, kind="ND"),
        move(128.0),
    ]
    src = tiny_sources(spark, cc_movements=moves, homologation=HOMOLOGATION)
    span = span_of(spark, DAY)
    expected = {
        "DIVISAS SEBRA": -1.0,
        "DERIVADOS OTC": -2.0,
        "INTERESES REMUNERADO": 8.0,
        "APR. OP CON DECEVAL RECURSOS PROPIOS": 16.0,
        "Falta Homologación: 1234": 32.0,
        "PAGO RENDIMIENTOS": -64.0,
        None: 128.0,
    }
    rows = movements.concept_homologation(span, src).collect()
    assert {r.concepto: float(r.total) for r in rows} == expected
    by_row = movements.process_value(
        movements.process_concept(movements.scan_unity_movements(span, src)), src["homologation"]
    )
    totals = by_row.groupBy("concepto").agg(F.sum("valor").alias("v")).collect()
    assert {r.concepto: r.v for r in totals} == expected
    unmapped = movements.unmapped_concepts(span, src).collect()
    assert [(r.concepto, r.n_rows) for r in unmapped] == [("Falta Homologación: 1234", 1)]


def test_weekend_movements_are_caught_up_and_shared_dates_serve_both(spark):
    src = tiny_sources(
        spark, cc_movements=[move(1.0, "310", day=date(2024, 1, d)) for d in (5, 6, 7, 8, 9)]
    )
    wide = movements.unity_totals(span_of(spark, date(2024, 1, 7), date(2024, 1, 9)), src)
    assert {r.report_date.day: float(r.sebra_fx_in) for r in wide.collect()} == {7: 1.0, 9: 4.0}


def credit_rows(amount, channel=params.TRANSFER_DEBIT, account=params.CREDIT_ACCOUNT, day=DAY):
    return {
        "transactions": [
            {
                "clave_cuenta_padre": 1,
                "clave_canal": 7,
                "monto": amount,
                "fecha_hora_valor": datetime(day.year, day.month, day.day, 9),
                "fecha_valor": day,
            }
        ],
        "accounts": [
            {"clave_codificada": 1, "id": account, "fecha_ultima_modificacion": datetime(2023, 1, 1), "version": 1}
        ],
        "channels": [{"clave_codificada": 7, "nombre": channel}],
    }


@pytest.mark.parametrize(
    "credit, expected",
    [
        (credit_rows(100.0), (200.0, -50.0)),
        (credit_rows(100.0, channel=params.CROSS_DEPOSIT), (400.0, -50.0)),
        (credit_rows(100.0, account="7"), (400.0, -50.0)),
        (credit_rows(100.0, day=BEFORE), (400.0, -50.0)),
    ],
)
def test_third_party_movements_net_of_credit_amounts(spark, credit, expected):
    moves = [move(100.0, "7002"), move(100.0, None, 5), move(200.0, "7002"), move(50.0, "7002", kind="ND"), move(0.0, "7002")]
    src = tiny_sources(
        spark, cc_movements=moves, unity_operations=[operation(5, "TTV")], homologation=HOMOLOGATION, **credit
    )
    span = span_of(spark, DAY)
    facts = movements.movement_facts(span, src, channels.credit_amounts(span, src))
    row = one(per_report_date(span, facts, movements.THIRD_METRICS))
    assert (row["third_in"], row["third_out"]) == expected


# --- channels ------------------------------------------------------------------------


def channel_sources(spark, transactions, accounts=((1, "A1"),), channel_names=None):
    names = channel_names or {
        1: params.ACH_WITHDRAWAL,
        2: params.ACH_DEPOSIT,
        3: params.ACH_RETURN,
        4: params.CROSS_DEPOSIT,
        5: params.EXCLUDED_CHANNELS[0],
        6: params.TRANSFER_DEBIT,
        7: params.TRANSFER_CREDIT_RETURN,
        8: "OTRO",
        9: None,
    }
    return tiny_sources(
        spark,
        transactions=[
            {
                "clave_cuenta_padre": account,
                "clave_canal": channel,
                "monto": amount,
                "fecha_hora_valor": at,
                "fecha_valor": DAY,
            }
            for account, channel, amount, at in transactions
        ],
        accounts=[
            {"clave_codificada": k, "id": i, "fecha_ultima_modificacion": datetime(2023, 1, 1), "version": 1}
            for k, i in accounts
        ],
        channels=[{"clave_codificada": k, "nombre": n} for k, n in names.items()],
    )


def at(hour, minute=0, second=0, micro=0):
    return datetime(2024, 1, 10, hour, minute, second, micro)


def test_slot_bounds(spark):
    times = [at(0), at(8, 31), at(8, 31, 0, 500000), at(8, 31, 1), at(11, 1), at(13, 31), at(15, 34)]
    times += [at(15, 34, 1), at(23, 59, 59, 999999)]
    src = channel_sources(spark, [(1, 1, -1.0, t) for t in times])
    row = one(channels.ach_time_slots(span_of(spark, DAY), src))
    assert [row[f"ret_{i}"] for i in range(5)] == [3, 2, 1, 1, 2]


def test_returns_use_the_deposit_slots(spark):
    src = channel_sources(spark, [(1, 2, 1.0, at(10, 30)), (1, 3, 2.0, at(10, 30, 1)), (1, 3, 4.0, at(17, 30, 1))])
    row = one(channels.ach_time_slots(span_of(spark, DAY), src))
    assert (row["dep_0"], row["dev_1"], row["dev_4"]) == (1, 2, 4)


def test_transfers(spark):
    src = channel_sources(spark, [(1, 6, -3.0, at(9)), (1, 6, 2.0, at(9)), (1, 7, -7.0, at(9))])
    row = one(channels.sebra_transfer_totals(span_of(spark, DAY), src))
    assert (row["debit_sebra"], row["credit_returns_sebra"], row["credit_sebra"]) == (5, 7, 0)


def test_credit_and_confirming(spark):
    accounts = ((1, params.CREDIT_ACCOUNT), (2, params.CONFIRMING_ACCOUNT), (3, "X"))
    transactions = [
        (1, 8, -2000.0, at(9)),
        (3, 4, 500.0, at(9)),
        (3, 4, -70.0, at(9)),
        (1, 8, 30.0, at(9)),
        (1, 5, 9999.0, at(9)),
        (1, 9, 9999.0, at(9)),
        (2, 8, -5.0, at(9)),
        (2, 8, 0.0, at(9)),
        (4, 4, 9999.0, at(9)),  # no such account
    ]
    src = channel_sources(spark, transactions, accounts)
    row = one(channels.credit_confirming(span_of(spark, DAY), src))
    assert (row["credit_income"], row["credit_outcome"]) == (30, 2500)
    assert (row["confirming_income"], row["confirming_outcome"]) == (0, 5)
    assert channels.scan_channel_transactions(span_of(spark, DAY), src).count() == 8


def test_latest_account_version(spark):
    def version(key, name, at, number):
        return {"clave_codificada": key, "id": name, "fecha_ultima_modificacion": at, "version": number}

    src = tiny_sources(
        spark,
        accounts=[
            version(1, "old", datetime(2023, 1, 1), 9),
            version(1, "new", datetime(2023, 1, 2), 1),
            version(2, "low", datetime(2023, 1, 1), 1),
            version(2, "high", datetime(2023, 1, 1), 2),
            version(3, "dated", datetime(2023, 1, 1), 1),
            version(3, "undated", None, 5),
        ],
    )
    rows = channels.latest_accounts(src["accounts"]).collect()
    assert {r.clave_codificada: r.id for r in rows} == {1: "new", 2: "high", 3: "dated"}


# --- refunds -------------------------------------------------------------------------


def refund(name="ach.1.OUT", status="unauthorized", value="1000", kind="_ach_out", day=DAY, to="E1", by="E2", **more):
    base = {
        "transaction_type": kind,
        "name": name,
        "status": status,
        "reg6_cuenta_receptora": "C",
        "reg6_entidad_receptora": to,
        "reg5_entidad_originadora": by,
        "reg5_nombre_originador": "O",
        "reg6_nombre_cliente_receptor": "N",
        "reg6_valor_transaccion": value,
        "fecha_consulta": day,
    }
    return {**base, **more}


def sent(value="1000", day=DAY, **more):
    return refund("ach.9.IN", "sent", value, params.SENT_REFUND, day, to="E2", by="E1", **more)


def test_refunds_by_cycle(spark):
    today = [refund(f"ach.{i}.OUT", value=f"{i * 10}00") for i in range(1, 6)]
    yesterday = [refund("x.4.OUT", value="10000", day=BEFORE)]
    matched = [sent("1500", BEFORE), refund("x.5.OUT", value="1500", day=BEFORE)]
    today_match = [refund("x.5.OUT", value="1500"), sent("1500")]
    src = tiny_sources(spark, adapter=today + yesterday + matched + today_match)
    row = one(refunds.ach_refunds(span_of(spark, DAY), src))
    assert [row[f"cud_{i}"] for i in range(1, 6)] == [10, 20, 30, 40, 65]
    # Yesterday 100 + 15 of which 15 matched; cycles 1..3; today's matched 15.
    assert [row[f"send_{i}"] for i in range(5)] == [100, 10, 20, 30, 15]


def test_three_out_two_sent_match_twice(spark):
    rows = [refund("a.4.OUT")] * 3 + [sent()] * 2
    src = tiny_sources(spark, adapter=rows)
    rows = refunds.matched_refunds(span_of(spark, DAY), src).collect()
    assert {r.which_day: float(r.matched) for r in rows} == {"today": 20.0, "yesterday": 0.0}


@pytest.mark.parametrize(
    "changed",
    [
        {"to": "E1", "by": "E2"},
        {"reg6_cuenta_receptora": "D"},
        {"value": "1001"},
        {"reg5_nombre_originador": None},
    ],
)
def test_unequal_or_null_keys_do_not_match(spark, changed):
    rows = [refund("a.4.OUT", **{k: v for k, v in changed.items() if v is None})]
    values = {"to": "E2", "by": "E1", **changed}
    rows.append(refund("ach.9.IN", "sent", values.pop("value", "1000"), params.SENT_REFUND, **values))
    src = tiny_sources(spark, adapter=rows)
    assert one(refunds.ach_refunds(span_of(spark, DAY), src))["send_4"] == 0


def test_early_cycles_do_not_match(spark):
    src = tiny_sources(spark, adapter=[refund("a.3.OUT"), sent()])
    assert one(refunds.ach_refunds(span_of(spark, DAY), src))["send_4"] == 0


def test_malformed_names_and_amounts(spark):
    rows = [
        refund("OUT"),
        refund("a.x.OUT"),
        refund("a.1.OUT", value="5"),
        refund("a.1.OUT", value="55"),
        refund("a.1.OUT", value="abc00"),
        refund("a.1.OUT", value=None),
        refund("a.1.OUT", value="700"),
        refund(None),
        refund("a.1.OUT", status=None),
    ]
    src = tiny_sources(spark, adapter=rows)
    assert one(refunds.ach_refunds(span_of(spark, DAY), src))["cud_1"] == 7
    parsed = {r.cycle: (r.n_rows, r.n_amounts) for r in refunds.refund_parse(span_of(spark, DAY), src).collect()}
    assert parsed == {None: (3, 3), 1: (6, 2)}


def test_originated_credit(spark):
    def originated(account, value, **more):
        return refund("a.IN", "sent", value, **{"reg5_datos_originador": account, **more})

    rows = [
        originated("  0062015991 ", "1234"),
        originated("62015991", " 99 "),
        originated("62015991", "5"),
        originated("162015991", "9999"),
        originated(None, "9999"),
        originated("62015991", "9999", day=BEFORE),
    ]
    src = tiny_sources(spark, adapter=rows)
    assert one(refunds.credit_adaptor_outcome(span_of(spark, DAY), src))["credit_adaptor_outcome"] == -12


# --- deposits and statements ------------------------------------------------------------


def deposit_sources(spark, *balances, product="P1"):
    return tiny_sources(
        spark,
        balance=[{"id_cuenta": 1, "fecha_saldo": d, "total_balance": v} for d, v in balances],
        deposit_account=[{"id_cuenta_deposito": 1, "id_producto": product}],
    )


@pytest.mark.parametrize(
    "balances, product, expected",
    [
        ([(DAY, 5000.0), (BEFORE, 3000.0)], "P1", 2000),
        ([(DAY, 5000.0), (BEFORE, 5000.0)], "P2", 0),
        ([(DAY, 5000.0)], "P1", 0),
        ([(BEFORE, 5000.0)], "P1", 0),
        ([(DAY, 5000.0), (BEFORE, None)], "P1", 5000),
        ([(DAY, 5000.0), (BEFORE, 3000.0)], "P9", 0),
        ([], "P1", 0),
    ],
)
def test_account_variation(spark, balances, product, expected):
    src = deposit_sources(spark, *balances, product=product)
    assert one(deposits.account_variation(span_of(spark, DAY), src))["account_variation"] == expected


def statement(account, currency, amount, day=DAY):
    return {"cuenta_bancaria": account, "moneda": currency, "monto": amount, "fecha_mvto": day}


UMBRELLA = [
    {"cuenta_bancaria": "000777", "titular": params.HOLDER, "estado": "ACTIVA"},
    {"cuenta_bancaria": "62015991", "titular": params.HOLDER, "estado": "ACTIVA"},
    {"cuenta_bancaria": "888", "titular": params.HOLDER, "estado": "INACTIVA"},
    {"cuenta_bancaria": "999", "titular": "OTHER", "estado": "ACTIVA"},
]


def test_statement_totals(spark):
    rows = [
        statement("777", "COP", 100.0),
        statement("777", "COP", -50.0),
        statement("777", "USD", 200.0),
        statement("777", "USD", -75.0),
        statement("777", "EUR", 1e6),
        statement("000777", "COP", 1e6),
        statement("62015991", "COP", 1e6),
        statement("888", "COP", 1e6),
        statement("999", "COP", 1e6),
        statement(None, "COP", 1e6),
    ]
    src = tiny_sources(spark, multicash=rows, umbrella=UMBRELLA)
    row = one(deposits.bank_transaction_totals(span_of(spark, DAY), src))
    assert (row["cop_in"], row["cop_out"], row["usd_in"], row["usd_out"]) == (100, 50, 200, 75)
    assert deposits.scan_bank_transactions(span_of(spark, DAY), src).count() == 6


def test_statements_run_out_over_the_weekend(spark):
    src = tiny_sources(
        spark, multicash=[statement("777", "COP", 1.0, date(2024, 1, d)) for d in (4, 5, 6, 7, 8, 9)], umbrella=UMBRELLA
    )
    assert one(deposits.bank_transaction_totals(span_of(spark, date(2024, 1, 5)), src))["cop_in"] == 4


# --- securities ----------------------------------------------------------------------


def paper(number, isin="COB70CDX", agreed=DAY, start=DAY, price=10.0):
    return {"id": number, "codigo_isin": isin, "fecha_operacion": agreed, "fecha_inicio": start, "precio_contado": price}


def child(number, kind, balance, name=params.INVESTMENT_HOLDER):
    return {"id_padre": number, "saldo": balance, "tipo_participacion": kind, "nombre_inversion": name}


def test_single_rows_are_rounded_and_several_are_summed(spark):
    src = tiny_sources(
        spark,
        operations_a=[paper(1), paper(2, "COB70CBX"), paper(3, "COB70CBX"), paper(4, "XXX")],
        operations_b=[child(1, 2, 75000.125), child(2, 2, 75000.0051), child(3, 2, 75000.0), child(4, 2, 1e6)],
    )
    row = one(securities.issuance_repurchase(span_of(spark, DAY), src))
    assert (row["cdt_issuances"], row["bond_issuances"]) == (75000.12, 150000.0051)


def test_repurchases_are_certificates_only(spark):
    src = tiny_sources(
        spark,
        operations_a=[paper(1), paper(2, "COB70CBX"), paper(3, agreed=date(2024, 1, 2)), paper(4, start=BEFORE)],
        operations_b=[child(i, 1, 0.0) for i in (1, 2, 3, 4)] + [child(1, 1, 0.0, "OTHER"), child(1, 3, 0.0)],
    )
    row = one(securities.issuance_repurchase(span_of(spark, DAY), src))
    assert row["repurchases"] == 10
    assert securities.scan_repurchases(span_of(spark, DAY), src).count() == 2


def test_derivatives_use_the_previous_business_day(spark):
    rows = [
        {"descripcion": params.HOLDER, "tipo_cumplimiento": "F", "utilidad": v, "fecha_inicial": d}
        for v, d in ((1.0, BEFORE), (2.0, DAY))
    ] + [{"descripcion": "OTHER", "tipo_cumplimiento": "F", "utilidad": 4.0, "fecha_inicial": BEFORE}]
    src = tiny_sources(spark, derivatives=rows)
    assert one(securities.derivatives_pnl(span_of(spark, DAY), src))["pnl"] == 1


# --- whole report --------------------------------------------------------------------


def test_empty_sources_give_zero_rows_per_date(spark):
    src = tiny_sources(spark)
    span = span_of(spark, DAY, BEFORE)
    stated = daily.statements(daily.daily_metrics(span, src))
    for row in daily.income_statement(stated).collect() + daily.expense_statement(stated).collect():
        assert all(v == 0.0 for k, v in row.asDict().items() if k != "fecha_reporte")
    for row in daily.cash_summary(stated).collect():
        assert row.porcentaje_diferencia is None and row.variacion_disponible == 0.0


def test_a_span_without_business_days_gives_no_rows(spark):
    weekend = business_day_span(spark, date(2024, 1, 6), date(2024, 1, 8))
    assert daily.cash_summary(daily.statements(daily.daily_metrics(weekend, tiny_sources(spark)))).count() == 0


def test_output_schemas(spark):
    span, src = span_of(spark, DAY), tiny_sources(spark)
    stated = daily.statements(daily.daily_metrics(span, src))
    tables = {
        "income": (daily.income_statement(stated), [*params.INCOME_LINES, "total"]),
        "expense": (daily.expense_statement(stated), [*params.EXPENSE_LINES, "total"]),
        "summary": (daily.cash_summary(stated), params.SUMMARY_COLUMNS),
    }
    for table, columns in tables.values():
        assert table.columns == [*columns, "fecha_reporte"]
        assert table.dtypes == [(c, "double") for c in columns] + [("fecha_reporte", "date")]
    assert (len(params.INCOME_LINES), len(params.EXPENSE_LINES)) == (25, 27)
    assert daily.stamped(tables["summary"][0]).dtypes[-1] == ("fecha_generacion", "date")


def test_today_has_no_day_inputs_yet(spark):
    src = deposit_sources(spark, (DAY, 5000.0), (BEFORE, 3000.0))
    span = span_of(spark, DAY, BEFORE)

    def variation(as_of):
        rows = daily.daily_inputs(daily.daily_metrics(span, src, as_of)).collect()
        return {r.report_date: r.account_variation for r in rows}

    assert variation(None)[DAY] == 2000 and variation(BEFORE)[DAY] == 2000
    assert variation(DAY)[DAY] == 0


def test_negative_net_clearing_turns_into_withdrawals(spark):
    """Income below zero is shown as income and added to the withdrawals."""
    src = channel_sources(spark, [(1, 8, 100.0, at(9))], ((1, params.CREDIT_ACCOUNT),))
    row = one(daily.ach_net_flow(daily.daily_metrics(span_of(spark, DAY), src)))
    assert (row["income_ach"], row["outcome_ach"], row["retiros_ach"]) == (-100, 0, 100)


def test_negative_dollar_compensation_counts_on_both_sides(spark):
    trades = [trade(1, 40.0, nemotecnico=params.DOLLAR_NEMO, tipo_operacion="C")]
    src = tiny_sources(spark, money_market=trades, unity_operations=[control(1)])
    stated = daily.statements(daily.daily_metrics(span_of(spark, DAY), src))
    assert one(daily.income_statement(stated))["060_compensacion_dolar"] == -40
    assert one(daily.expense_statement(stated))["045_compensacion_dolar"] == 40


def test_percentage_rounds_half_to_even(spark):
    # One USD account of 1 at rates that give a variation of 100 and a change of 100.
    src = tiny_sources(
        spark, bank_balances=[balance("62015990", 1000.0), balance("62015990", 200.0, day=T1)], renewals=[]
    )
    row = one(daily.cash_summary(daily.statements(daily.daily_metrics(span_of(spark, DAY), src))))
    assert row["variacion_disponible"] == 800 and row["porcentaje_diferencia"] == 100.0


def test_each_date_is_the_same_alone_and_in_a_backfill(spark):
    from florin.sources.samples import sample_sources

    src = sample_sources(spark, "/root/testdata/sf0.001")
    month = business_day_span(spark, date(2024, 1, 1), date(2024, 1, 31))
    together = daily.statements(daily.daily_metrics(month, src)).collect()
    by_day = {r.report_date: r.asDict() for r in together}
    for day in (date(2024, 1, 9), date(2024, 1, 22)):
        alone = daily.statements(daily.daily_metrics(span_of(spark, day), src)).first().asDict()
        # The samples agree operations up to six days before they start.
        assert alone == by_day[day]




def test_large_refund_amounts_are_summed(spark):
    def refund(amount):
        return {"fecha_consulta": DAY, "name": f"x.1{params.OUT_SUFFIX}", "status": params.UNAUTHORIZED, "reg6_valor_transaccion": amount}

    src = tiny_sources(spark, adapter=[refund("100000"), refund("99999999999999999999"), refund("abc"), refund("NaN00")])
    row = refunds.refund_parse(span_of(spark, DAY), src).collect()
    assert sum(r["n_amounts"] for r in row) == 2 and sum(r["total"] for r in row if r["total"] is not None) == 10**18 - 1 + 1000


def test_amounts_out_of_range_fail_without_ansi_mode(spark):
    from florin.functions.amounts import drop_last_two

    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="out of range"):
            spark.createDataFrame([("9" * 40,)], "t string").select(drop_last_two(F.col("t"))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_agreed_days_belong_to_the_report_date(spark):
    start, before = date(2024, 1, 10), date(2024, 1, 9)
    src = tiny_sources(
        spark,
        operations_a=[paper(1, agreed=before, start=start)],
        operations_b=[{"id_padre": 1, "saldo": 50.0, "tipo_participacion": params.ISSUANCE_PARTICIPATION, "nombre_inversion": params.INVESTMENT_HOLDER}],
    )
    for days in ([start], [before, start]):
        rows = securities.issuance_repurchase(span_of(spark, *days), src).collect()
        assert {r["report_date"]: float(r["cdt_issuances"]) for r in rows}[start] == 50.0


def test_requested_span(spark):
    src = tiny_sources(spark, adapter=[{"fecha_consulta": DAY}])
    assert job.requested_span(spark, src).last == DAY
    assert job.requested_span(spark, src, "DATE 2024-01-12").last == date(2024, 1, 12)
    with pytest.raises(ValueError):
        job.parse_report_date("2024-01-12garbage")
