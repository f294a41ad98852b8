"""Every report query on random dirty sources, against its SQL statement.

The sample tables have unique keys and clean values. Here keys repeat on both
sides of every join, any column may be NULL, text may be malformed, and a third
of the rows share one key.
"""

import os
import random
from datetime import date, datetime, timedelta

import duckdb
import pytest

from florin import params
from florin.plans import registry
from florin.sources.catalog import CONTRACTS, from_frames
from florin.verify.oracles import ORACLES, SOURCES
from oracle import assert_same
from tiny import schema_of

DUCK_TYPES = {"string": "VARCHAR", "measure": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP", "key": "BIGINT"}


class Dirty:
    def __init__(self, seed):
        self.random = random.Random(seed)

    def maybe(self, value, share=0.08):
        return None if self.random.random() < share else value

    def pick(self, *values):
        return self.maybe(self.random.choice(values))

    def key(self):
        return self.maybe(0 if self.random.random() < 0.33 else self.random.randint(1, 15))

    def day(self):
        return self.maybe(date(2023, 12, 28) + timedelta(days=self.random.randint(0, 25)))

    def amount(self):
        size = self.random.choice([0.0, 100.0, 250.5, self.random.random() * 1e6])
        return self.maybe(round(self.random.choice([1.0, -1.0]) * size, 2))

    def moment(self, day):
        seconds = self.random.choice([0, 8 * 3600 + 31 * 60, 30660, 48660, 63001, self.random.randint(0, 86399)])
        base = datetime(day.year, day.month, day.day) if day else datetime(2024, 1, 9)
        return base + timedelta(seconds=seconds, microseconds=self.random.choice([0, 500000]))

    def tables(self, n=400):
        groups = (params.CENTRAL_BANK_ACCOUNTS, params.COMMERCIAL_ACCOUNTS, params.USD_ACCOUNTS)
        accounts = [account for group in groups for numbers in group.values() for account in numbers]
        codes = ["310", "389", "366", "362", "7001", "7002", "7003", "9999"]
        derived = ["44206", "43422", "43420", "45495", "45435", "44495", "44435", "44211", "44481", "45431"]
        concepts = [
            params.THIRD_PARTY_CONCEPT,
            params.REPURCHASE_CONCEPT,
            params.ISSUER_PAYMENT_CONCEPT,
            params.GMF_CONCEPT,
            params.CREDIT_INTEREST_CONCEPT,
            params.FX_CONCEPT,
            *params.OTHER_CONCEPTS[:2],
            *params.CLEARING_EXPENSE_CONCEPTS[:2],
            *params.OTHER_OPERATION_CONCEPTS[:2],
        ]
        channel_names = [
            params.ACH_WITHDRAWAL,
            params.ACH_DEPOSIT,
            params.ACH_RETURN,
            *params.TRANSFER_CHANNELS,
            params.CROSS_DEPOSIT,
            *params.EXCLUDED_CHANNELS,
            "OTRO",
        ]

        def transaction():
            day = self.day()
            return {
                "clave_cuenta_padre": self.key(),
                "clave_canal": self.pick(*range(len(channel_names) + 1)),
                "monto": self.amount(),
                "fecha_hora_valor": self.moment(day),
                "fecha_valor": day,
            }

        makers = {
            "bank_balances": lambda: {
                "numero_cuenta": self.pick(*accounts, "1"),
                "nombre_titular_cuenta": self.pick(params.HOLDER, params.HOLDER, "OTHER"),
                "saldo_bancario_final": self.amount(),
                "saldo_en_canje": self.amount(),
                "fecha_movimiento": self.day(),
            },
            "unity_operations": lambda: {
                "consecutivo": self.key(),
                "fecha_cuadre": self.day(),
                "clasificacion": self.pick("NORMAL", "SIM", "REPO", "TTV", "X"),
                "liquidacion": self.pick("T0SB", "T1OF", "XX", "", "B"),
                "tipo_operacion": self.pick("C", "V", "X"),
                "fecha_futura": self.maybe(self.day(), 0.4),
            },
            "money_market": lambda: {
                "consecutivo": self.key(),
                "fecha_operacion": self.day(),
                "fecha_cumplimiento": self.day(),
                "cod_central_deposito": self.pick("DCV", "DVL", "XXX"),
                "clasificacion": self.pick("NORMAL", "SIM", "REPO", "TTV", "X"),
                "tipo_sim": self.pick("A", "P", "Z"),
                "codigo_especie": self.pick("CT1", "XCTMM", "CA", "MM", "ZZ"),
                "nemotecnico": self.pick(params.DOLLAR_NEMO, "TFIT"),
                "tipo_operacion": self.pick("C", "V", "X"),
                "genera_detalle": self.pick("SI", "NO"),
                "valor_de_giro": self.amount(),
            },
            "cc_movements": lambda: {
                "operacion": self.key(),
                "concepto": self.maybe(self.random.choice(codes), 0.5),
                "valor": self.amount(),
                "cod_tipo_movimiento": self.pick("ND", "NC"),
                "fecha": self.day(),
                "cuenta_bancaria": "1",
                "rendimiento": self.maybe(1.0, 0.8),
            },
            "multicash": lambda: {
                "cuenta_bancaria": self.pick("777", "0777", "62015991", "888", "5"),
                "moneda": self.pick("COP", "USD", "EUR"),
                "monto": self.amount(),
                "fecha_mvto": self.day(),
            },
            "renewals": lambda: {"total_renovacion": self.amount(), "fecha_operacion": self.day()},
            "operations_a": lambda: {
                "id": self.key(),
                "codigo_isin": self.pick("COB70CD1", "COB70CB1", "XCOB70CD"),
                "fecha_operacion": self.day(),
                "fecha_inicio": self.day(),
                "precio_contado": self.amount(),
            },
            "operations_b": lambda: {
                "id_padre": self.key(),
                "saldo": self.amount(),
                "tipo_participacion": self.pick(1, 2, 3),
                "nombre_inversion": self.pick(params.INVESTMENT_HOLDER, "OTHER"),
            },
            "derivatives": lambda: {
                "descripcion": self.pick(params.HOLDER, "OTHER"),
                "tipo_cumplimiento": self.pick("F", "N"),
                "utilidad": self.amount(),
                "fecha_inicial": self.day(),
            },
            "transactions": transaction,
            "balance": lambda: {"id_cuenta": self.key(), "fecha_saldo": self.day(), "total_balance": self.amount()},
            "deposit_account": lambda: {"id_cuenta_deposito": self.key(), "id_producto": self.pick("P1", "P2", "P3", "P9")},
            "adapter": lambda: {
                "transaction_type": self.pick(params.SENT_REFUND, "_ach_out"),
                "name": self.pick("a.1.OUT", "a.2.OUT", "a.4.OUT", "a.5.OUT", "a.5.IN", "OUT", "a.x.OUT", ""),
                "status": self.pick(params.UNAUTHORIZED, params.UNAUTHORIZED, "sent"),
                "reg6_cuenta_receptora": self.pick("C1", "C2"),
                "reg6_entidad_receptora": self.pick("E1", "E2"),
                "reg5_entidad_originadora": self.pick("E1", "E2"),
                "reg5_nombre_originador": "O",
                "reg6_nombre_cliente_receptor": self.pick("N1"),
                "reg6_valor_transaccion": self.pick("100000", "250050", "5", "55", "", "abc00", " 7700 "),
                "reg5_datos_originador": self.pick("0062015991", " 62015991 ", "1", ""),
                "fecha_consulta": self.day(),
            },
        }
        tables = {name: [make() for _ in range(n)] for name, make in makers.items()}
        tables["homologation"] = [
            {"codigo_contable": code, "codigo_cud": "x", "concepto_cud": self.pick(*concepts)}
            for code in codes[:-2] + derived[:-2] + codes[4:6]  # some unmapped, some mapped twice
        ]
        tables["umbrella"] = [
            {
                "cuenta_bancaria": a,
                "titular": self.pick(params.HOLDER, params.HOLDER, "OTHER"),
                "estado": self.pick("ACTIVA", "ACTIVA", "INACTIVA"),
            }
            for a in ["777", "000777", "062015991", "888", "5", "05", None]
        ]
        starts = [date(2023, 12, 20) + timedelta(days=3 * i) for i in range(12)]
        tables["trm"] = [
            {
                "valor": self.maybe(3900.0 + i * 10.25),
                "vigencia_desde": self.maybe(d),
                "vigencia_hasta": self.random.choice([d, d + timedelta(days=2), d - timedelta(days=1), date(9999, 12, 31)]),
            }
            for i, d in enumerate(starts)
        ]
        # No two versions of an account share modification time and version number.
        tables["accounts"] = [
            {
                "clave_codificada": key,
                "id": self.pick(params.CREDIT_ACCOUNT, params.CONFIRMING_ACCOUNT, "1"),
                "fecha_ultima_modificacion": datetime(2023, 1, 1 + number % 3),
                "version": number,
            }
            for key in [None, *range(0, 12)]
            for number in range(self.random.randint(1, 40 if key == 0 else 4))
        ]
        tables["channels"] = [{"clave_codificada": i, "nombre": n} for i, n in enumerate(channel_names)]
        tables["channels"].append({"clave_codificada": 3, "nombre": params.ACH_RETURN})
        return tables


# The calendar queries turn every movement date into a report date; the other ones that
# are left out here either read no report source or only exist to write files.
SKIPPED = {"business_calendar", "business_window", "report_dates", "bank_dates", "parse_report_dates", "upsert_partitioned"}
NAMES = sorted(set(ORACLES) - SKIPPED)


def raw_sql(sql):
    for name, text in SOURCES.items():
        sql = sql.replace(f"{name} AS ({text})", f"{name} AS (SELECT * FROM raw.{name})")
    return sql


SEEDS = [int(seed) for seed in os.environ.get("FLORIN_SEEDS", "1").split(",")]


@pytest.fixture(scope="module", params=SEEDS)
def engines(spark, request):
    tables = Dirty(request.param).tables()
    duck = duckdb.connect()
    duck.execute("CREATE SCHEMA raw")
    frames = {}
    for name, columns in CONTRACTS.items():
        rows = [tuple(row.get(c) for c in columns) for row in tables[name]]
        frames[name] = spark.createDataFrame(rows, schema_of(name)).repartition(3).cache()
        duck.execute(f"CREATE TABLE raw.{name} ({', '.join(f'{c} {DUCK_TYPES[k]}' for c, k in columns.items())})")
        duck.executemany(f"INSERT INTO raw.{name} VALUES ({', '.join('?' * len(columns))})", rows)
    yield duck, from_frames(spark, frames)
    for frame in frames.values():
        frame.unpersist()


@pytest.mark.parametrize("name", NAMES)
def test_dirty_sources(spark, engines, monkeypatch, name):
    duck, sources = engines
    monkeypatch.setattr(registry, "sample_sources", lambda *_: sources)
    assert_same(registry.QUERIES[name](spark, "unused"), duck, raw_sql(ORACLES[name]))
