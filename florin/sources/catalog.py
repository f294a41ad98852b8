"""The eighteen source tables: column contracts and readers.

Operators only see ``Sources``: a lazy mapping from table name to DataFrame.
It can be backed by catalog tables, by parquet folders (partitioned by their
date column on a real cluster), or by any other DataFrames.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column -> kind. "measure" may be any numeric type, "key" a text, a date or a whole number.
CONTRACTS: dict[str, dict[str, str]] = {
    "bank_balances": {
        "numero_cuenta": "string",
        "nombre_titular_cuenta": "string",
        "nombre_banco": "string",
        "tipo_cuenta": "string",
        "saldo_bancario_final": "measure",
        "saldo_en_canje": "measure",
        "fecha_movimiento": "date",
    },
    "unity_operations": {
        "consecutivo": "key",
        "fecha_cuadre": "date",
        "clasificacion": "string",
        "liquidacion": "string",
        "tipo_operacion": "string",
        "fecha_futura": "date",
    },
    "money_market": {
        "consecutivo": "key",
        "fecha_operacion": "date",
        "fecha_cumplimiento": "date",
        "cod_central_deposito": "string",
        "clasificacion": "string",
        "tipo_sim": "string",
        "codigo_especie": "string",
        "nemotecnico": "string",
        "tipo_operacion": "string",
        "genera_detalle": "string",
        "valor_de_giro": "measure",
    },
    "cc_movements": {
        "operacion": "key",
        "concepto": "string",
        "valor": "measure",
        "cod_tipo_movimiento": "string",
        "fecha": "date",
        "cuenta_bancaria": "string",
        "rendimiento": "measure",
    },
    "homologation": {"codigo_contable": "string", "codigo_cud": "string", "concepto_cud": "string"},
    "multicash": {"cuenta_bancaria": "string", "moneda": "string", "monto": "measure", "fecha_mvto": "date"},
    "umbrella": {"cuenta_bancaria": "string", "titular": "string", "estado": "string"},
    "trm": {"valor": "measure", "vigencia_desde": "date", "vigencia_hasta": "date"},
    "renewals": {"total_renovacion": "measure", "fecha_operacion": "date"},
    "operations_a": {
        "id": "key",
        "codigo_isin": "string",
        "fecha_operacion": "date",
        "fecha_inicio": "date",
        "precio_contado": "measure",
    },
    "operations_b": {"id_padre": "key", "saldo": "measure", "tipo_participacion": "key", "nombre_inversion": "string"},
    "derivatives": {
        "descripcion": "string",
        "tipo_cumplimiento": "string",
        "utilidad": "measure",
        "fecha_inicial": "date",
    },
    "accounts": {
        "clave_codificada": "key",
        "id": "string",
        "fecha_ultima_modificacion": "timestamp",
        "version": "key",
    },
    "transactions": {
        "clave_cuenta_padre": "key",
        "clave_canal": "key",
        "monto": "measure",
        "fecha_hora_valor": "timestamp",
        "fecha_valor": "date",
    },
    "channels": {"clave_codificada": "key", "nombre": "string"},
    "balance": {"id_cuenta": "key", "fecha_saldo": "date", "total_balance": "measure"},
    "deposit_account": {"id_cuenta_deposito": "key", "id_producto": "string"},
    "adapter": {
        "transaction_type": "string",
        "name": "string",
        "status": "string",
        "reg6_cuenta_receptora": "string",
        "reg6_entidad_receptora": "string",
        "reg5_entidad_originadora": "string",
        "reg5_nombre_originador": "string",
        "reg6_nombre_cliente_receptor": "string",
        "reg6_valor_transaccion": "string",
        "reg5_datos_originador": "string",
        "fecha_consulta": "date",
    },
}


# Columns that are joined to each other: both texts, or both numbers.
JOINED = [
    (("money_market", "consecutivo"), ("unity_operations", "consecutivo")),
    (("cc_movements", "operacion"), ("unity_operations", "consecutivo")),
    (("operations_a", "id"), ("operations_b", "id_padre")),
    (("transactions", "clave_cuenta_padre"), ("accounts", "clave_codificada")),
    (("transactions", "clave_canal"), ("channels", "clave_codificada")),
    (("balance", "id_cuenta"), ("deposit_account", "id_cuenta_deposito")),
]
_KEYS = (T.StringType, T.IntegralType, T.DecimalType, T.DateType)
KINDS: dict[str, tuple[type, ...]] = {
    "string": (T.StringType, T.CharType, T.VarcharType),
    "measure": (T.NumericType,),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "key": _KEYS,
}


def check_types(table: str, frame: DataFrame) -> None:
    """Fail, before anything is planned, where a column is not of the kind its contract says."""
    wrong = [
        f"{c} is {frame.schema[c].dataType.simpleString()}, not a {kind}"
        for c, kind in CONTRACTS[table].items()
        if not isinstance(frame.schema[c].dataType, KINDS[kind])
    ]
    if wrong:
        raise ValueError(f"source {table}: {'; '.join(wrong)}")


def check_joined(frames: Mapping[str, DataFrame], table: str) -> None:
    """Fail where a key of ``table`` and the one it is joined to are a text and a number."""

    def family(at: tuple[str, str]) -> str:
        kind = frames[at[0]].schema[at[1]].dataType
        return "number" if isinstance(kind, T.NumericType) else kind.typeName()

    for pair in JOINED:
        if any(t == table for t, _ in pair) and all(t in frames for t, _ in pair) and family(pair[0]) != family(pair[1]):
            (a, x), (b, y) = pair
            raise ValueError(f"keys of two types: {a}.{x} is a {family(pair[0])}, {b}.{y} a {family(pair[1])}")


class Sources(Mapping[str, DataFrame]):
    """Lazily read source tables, projected to their contract columns."""

    def __init__(self, spark: SparkSession, read: Callable[[str], DataFrame], tables: Mapping[str, str] | None = None):
        self.spark = spark
        self._read = read
        self._tables = tables or {}
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            columns = CONTRACTS[name]
            frame = self._read(name)
            missing = [c for c in columns if c not in frame.columns]
            if missing:
                raise ValueError(f"source {name} lacks columns {missing}")
            check_types(name, frame)
            self._frames[name] = frame.select(*columns)
            check_joined(self._frames, name)
        return self._frames[name]

    def partition_days(self, name: str, column: str) -> list[date] | None:
        """The dates that a catalog table has partitions of, by that column; None where the catalog holds none."""
        table = self._tables.get(name)
        if table is None or column not in [c.name for c in self.spark.catalog.listColumns(table) if c.isPartition]:
            return None
        try:
            listed = self.spark.sql(f"SHOW PARTITIONS {table}").collect()
        except AnalysisException:  # partitions that only the files tell
            return None
        values = (dict(p.split("=", 1) for p in row["partition"].split("/"))[column] for row in listed)
        return sorted({date.fromisoformat(v) for v in values if re.fullmatch(r"\d{4}-\d{2}-\d{2}", v)})

    def __iter__(self):
        return iter(CONTRACTS)

    def __len__(self) -> int:
        return len(CONTRACTS)


def from_tables(spark: SparkSession, tables: Mapping[str, str]) -> Sources:
    """Sources from catalog tables: logical name -> qualified table name."""
    return Sources(spark, lambda name: spark.read.table(tables[name]), tables)


def from_paths(spark: SparkSession, root: str, fmt: str = "parquet") -> Sources:
    """Sources from ``root/<logical name>`` folders."""
    return Sources(spark, lambda name: spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}"))


def from_frames(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Sources:
    return Sources(spark, lambda name: frames[name])
