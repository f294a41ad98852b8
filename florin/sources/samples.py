"""Sample treasury tables derived from the benchmark tables.

No date is a function of a join key alone, so a date filter does not cross a join by
itself. The SQL text means the same in Spark and in DuckDB, so that a check can run both
engines on identical inputs. ``{name}`` stands for a benchmark table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from florin.sources.catalog import Sources

SAMPLE_SQL = {
    "bank_balances": """
        SELECT a.numero_cuenta,
          CASE WHEN o_custkey % 7 = 0 THEN 'OTHER HOLDER' ELSE 'HOLDER SA' END AS nombre_titular_cuenta,
          a.nombre_banco, a.tipo_cuenta, o_totalprice AS saldo_bancario_final,
          0 - o_totalprice/100 AS saldo_en_canje, (DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT)) AS fecha_movimiento
        FROM {orders} JOIN (VALUES (0,'62015990','BANREP','CUD'),(1,'62015991','BANREP','CUD'),(2,'64011480','BANREP','CUD'),
          (3,'570033570004227','DAV','Ahorros'),(4,'423816990','OCC','Ahorros'),(5,'61100001064','BANC','Adm'),
          (6,'86110','CAYMAN','USD'),(7,'1901751916','BOFA','USD'),(8,'99999','OTRO','Ahorros'),
          (9,'434381323','BOG','Ahorros'),(10,'61100001577','BANC','Ahorros'),(11,'560033569994602','DAV','Adm'),
          (12,'434394037','BOG','Adm'),(13,'14674340','CITI','USD'),(14,'36442812','CITI','USD'),(15,'36506441','CITI','USD'),
          (16,'80110003748','PANAMA','USD'),(17,'30863139','BRADESCO','USD'))
          AS a(idx,numero_cuenta,nombre_banco,tipo_cuenta) ON o_custkey % 18 = a.idx
    """,
    "unity_operations": """
        SELECT o_orderkey AS consecutivo, (DATE '2024-01-01' + CAST((o_orderkey + o_custkey % 5) % 30 AS INT)) AS fecha_cuadre,
          CASE o_orderkey % 4 WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'SIM' WHEN 2 THEN 'REPO' ELSE 'TTV' END AS clasificacion,
          CASE o_custkey % 3 WHEN 0 THEN 'T0SB' WHEN 1 THEN 'T1OF' ELSE 'T2XX' END AS liquidacion,
          CASE WHEN o_orderkey % 8 < 4 THEN 'C' ELSE 'V' END AS tipo_operacion,
          CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE (DATE '2024-01-01' + CAST((o_orderkey + o_custkey % 5) % 30 AS INT)) END AS fecha_futura
        FROM {orders}
    """,
    "money_market": """
        SELECT l_orderkey AS consecutivo,
          (DATE '2024-01-01' + CAST((l_orderkey + l_suppkey % 5) % 30 AS INT)) - CAST(l_linenumber % 2 AS INT) AS fecha_operacion,
          (DATE '2024-01-01' + CAST((l_orderkey + l_suppkey % 5) % 30 AS INT)) AS fecha_cumplimiento,
          CASE l_suppkey % 3 WHEN 0 THEN 'DCV' WHEN 1 THEN 'DVL' ELSE 'XXX' END AS cod_central_deposito,
          CASE l_partkey % 4 WHEN 0 THEN 'SIM' WHEN 1 THEN 'NORMAL' WHEN 2 THEN 'REPO' ELSE 'TTV' END AS clasificacion,
          CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'P' END AS tipo_sim,
          CASE l_partkey % 5 WHEN 0 THEN 'CT01' WHEN 1 THEN 'CA02' WHEN 2 THEN 'CB03' WHEN 3 THEN 'MM04' ELSE NULL END AS codigo_especie,
          CASE WHEN l_partkey % 3 = 0 THEN 'MONEYMARKET' ELSE 'TFIT' END AS nemotecnico,
          CASE l_returnflag WHEN 'R' THEN 'C' WHEN 'A' THEN 'V' ELSE 'X' END AS tipo_operacion,
          CASE WHEN l_linestatus = 'O' THEN 'SI' ELSE 'NO' END AS genera_detalle, l_extendedprice AS valor_de_giro
        FROM {lineitem}
    """,
    "cc_movements": """
        SELECT o_orderkey AS operacion,
          CASE o_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '310' WHEN 2 THEN '389' WHEN 3 THEN '366' WHEN 4 THEN '362'
            WHEN 5 THEN '7001' WHEN 6 THEN '7002' ELSE '9999' END AS concepto,
          CASE WHEN o_custkey % 8 = 6 THEN CAST(1 + o_orderkey % 50 AS DOUBLE) ELSE o_totalprice END AS valor,
          CASE WHEN o_orderstatus = 'F' THEN 'ND' ELSE 'NC' END AS cod_tipo_movimiento, (DATE '2024-01-01' + CAST((o_orderkey + 7 * o_custkey) % 30 AS INT)) AS fecha,
          CAST(o_custkey AS STRING) AS cuenta_bancaria,
          CASE WHEN o_custkey % 11 = 0 THEN CAST(1.5 AS DOUBLE) ELSE NULL END AS rendimiento
        FROM {orders}
    """,
    "homologation": """
        SELECT * FROM (VALUES ('44206','a','OPERACIONES DVP DECEVAL'),('43422','b','APR.PAGOS DE EMISORES S/ TÍTULOS VA'),
          ('43420','c','G.M.F. SOBRE LA TRANSACCIÓN'),('45495','d','A.PAGOS POR CAP. E INTERESES SOBRE CRÉDI'),
          ('45435','e','DB IVA'),('44495','f','APR. OP CON DCV RECURSOS PROPIOS'),('44435','g','AP. LIQUIDACION DIARIA OPERACIONES'),
          ('44211','h','OPERACIONES DVP DECEVAL'),('44481','i','APR.PAGOS DE EMISORES S/ TÍTULOS VA'),('45431','j','DB TARIFAS SEN'),
          ('7001','k','APR. OP CON DECEVAL RECURSOS PROPIOS'),('7002','l','APR ENTR CTA DEPÓS DIFER TITULAR-TERCERO'))
          AS h(codigo_contable,codigo_cud,concepto_cud)
    """,
    "multicash": """
        SELECT CASE user_id % 4 WHEN 0 THEN '423816990' WHEN 1 THEN '434381323' WHEN 2 THEN '62015991' ELSE '777' END AS cuenta_bancaria,
          CASE WHEN event_id % 3 = 0 THEN 'USD' ELSE 'COP' END AS moneda,
          CASE WHEN event_id % 2 = 0 THEN value ELSE 0 - value END AS monto, CAST(ts AS DATE) AS fecha_mvto
        FROM {events}
    """,
    "umbrella": """
        SELECT * FROM (VALUES ('000423816990','HOLDER SA','ACTIVA'),('0434381323','HOLDER SA','ACTIVA'),('62015991','HOLDER SA','ACTIVA'),
          ('777','OTHER HOLDER','ACTIVA'),('888','HOLDER SA','INACTIVA')) AS u(cuenta_bancaria,titular,estado)
    """,
    "trm": """
        SELECT CAST(3900 + n_nationkey*10 AS DOUBLE) AS valor, DATE '2023-12-25' + CAST(2*n_nationkey AS INT) AS vigencia_desde,
          DATE '2023-12-26' + CAST(2*n_nationkey AS INT) AS vigencia_hasta
        FROM {nation}
    """,
    "renewals": """
        SELECT c_acctbal AS total_renovacion, (DATE '2024-01-01' + CAST(c_custkey % 30 AS INT)) AS fecha_operacion FROM {customer}
    """,
    "operations_a": """
        SELECT p_partkey AS id,
          CASE p_partkey % 3 WHEN 0 THEN 'COB70CD' WHEN 1 THEN 'COB70CB' ELSE 'XXX' END || CAST(p_partkey AS STRING) AS codigo_isin,
          (DATE '2024-01-01' + CAST((p_partkey + p_size) % 30 AS INT)) - CAST(p_size % 7 AS INT) AS fecha_operacion,
          (DATE '2024-01-01' + CAST((p_partkey + p_size) % 30 AS INT)) AS fecha_inicio, p_retailprice AS precio_contado
        FROM {part}
    """,
    "operations_b": """
        SELECT p_partkey AS id_padre, p_retailprice*2 AS saldo, 1 + CAST(p_size % 2 AS INT) AS tipo_participacion,
          CASE WHEN p_size % 10 = 0 THEN 'OTHER' ELSE 'HOLDER S.A' END AS nombre_inversion
        FROM {part}
    """,
    "derivatives": """
        SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'OTHER' ELSE 'HOLDER SA' END AS descripcion,
          CASE WHEN s_suppkey % 3 = 0 THEN 'N' ELSE 'F' END AS tipo_cumplimiento, s_acctbal - 4500 AS utilidad,
          (DATE '2024-01-01' + CAST(s_suppkey % 30 AS INT)) AS fecha_inicial
        FROM {supplier}
    """,
    "accounts": """
        SELECT o_custkey AS clave_codificada,
          CASE o_custkey % 10 WHEN 0 THEN '12528874205' WHEN 1 THEN '12561730308' ELSE CAST(o_custkey AS STRING) END AS id,
          o_orderdate AS fecha_ultima_modificacion, o_orderkey AS version
        FROM {orders}
    """,
    "transactions": """
        SELECT user_id AS clave_cuenta_padre, event_id % 10 AS clave_canal,
          CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END
            * CASE WHEN event_id % 10 BETWEEN 4 AND 7 THEN CAST(1 + event_id % 50 AS DOUBLE) ELSE value END AS monto,
          ts AS fecha_hora_valor, CAST(ts AS DATE) AS fecha_valor
        FROM {events}
    """,
    "channels": """
        SELECT * FROM (VALUES (0,'RETIRO ACH'),(1,'DEPOSITO ACH'),(2,'DEVOLUCION RETIRO ACH'),(3,'DEPOSITO CROS'),
          (4,'TRASLADO FONDOS SEBRA DEBITO'),(5,'TRASLADO FONDOS SEBRA CREDITO'),(6,'DEVOLUCION TRASLADO FONDOS SEBRA DEBITO'),
          (7,'DEVOLUCION TRASLADO FONDOS SEBRA CREDITO'),(8,'RECARGA SALDO PARA OPERACIONES DE CRED/CONF'),(9,'OTRO CANAL'))
          AS c(clave_codificada,nombre)
    """,
    "balance": """
        SELECT o_custkey AS id_cuenta, (DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT)) AS fecha_saldo,
          CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS total_balance
        FROM {orders}
    """,
    "deposit_account": """
        SELECT c_custkey AS id_cuenta_deposito, CASE c_custkey % 4 WHEN 0 THEN 'P1' WHEN 1 THEN 'P2' WHEN 2 THEN 'P3' ELSE 'P9' END AS id_producto
        FROM {customer}
    """,
    "adapter": """
        SELECT CASE WHEN event_id % 4 = 0 THEN '_ach_dev_enviada' ELSE '_ach_out' END AS transaction_type,
          CASE WHEN event_id % 17 = 0 THEN 'bad' ELSE 'ach.' || CAST(1 + event_id % 5 AS STRING) || '.OUT' END AS name,
          CASE WHEN event_id % 4 = 0 THEN 'sent' WHEN event_id % 3 = 0 THEN 'authorized' ELSE 'unauthorized' END AS status,
          'C' || CAST(user_id % 5 AS STRING) AS reg6_cuenta_receptora,
          CASE WHEN event_id % 4 = 0 THEN 'E2' ELSE 'E1' END AS reg6_entidad_receptora,
          CASE WHEN event_id % 4 = 0 THEN 'E1' ELSE 'E2' END AS reg5_entidad_originadora,
          'ORIG' AS reg5_nombre_originador, 'CLI' || CAST(user_id % 3 AS STRING) AS reg6_nombre_cliente_receptor,
          CASE WHEN event_id % 97 = 0 THEN '5' ELSE CAST((1 + user_id % 7) * 100000 AS STRING) END AS reg6_valor_transaccion,
          CASE WHEN event_id % 6 = 0 THEN '0062015991' ELSE '123' END AS reg5_datos_originador, CAST(ts AS DATE) AS fecha_consulta
        FROM {events}
    """,
}

BASE_TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def sample_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Sources over ``sf_dir/<table>.parquet``."""
    base: dict[str, DataFrame] = {}

    def base_frame(table: str) -> DataFrame:
        if table not in base:
            base[table] = base_table(spark, sf_dir, table)
        return base[table]

    def read(name: str) -> DataFrame:
        text = SAMPLE_SQL[name]
        return spark.sql(text, **{t: base_frame(t) for t in BASE_TABLES if "{" + t + "}" in text})

    return Sources(spark, read)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sample_ctes() -> dict[str, str]:
    """The same statements for an engine that sees the benchmark tables by name."""
    return {name: text.format(**{t: t for t in BASE_TABLES}) for name, text in SAMPLE_SQL.items()}
