"""The queries again, as plain SQL for an independent engine (DuckDB).

Only the sample source statements are shared with the Spark side. Dates are
literal, every metric is a filtered sum over row-level joins, the calendar is
window functions over a day list.
"""

from __future__ import annotations

from florin.sources.samples import sample_ctes

SOURCES = sample_ctes()

# The five report dates of 2024-01-12, written out.
RD_WINDOW = """
    SELECT * FROM (VALUES
      (DATE '2024-01-05', DATE '2024-01-04', DATE '2024-01-09', DATE '2024-01-04', DATE '2024-01-08',
       DATE '2024-01-05', DATE '2024-01-05', DATE '2024-01-05', DATE '2024-01-08'),
      (DATE '2024-01-09', DATE '2024-01-05', DATE '2024-01-10', DATE '2024-01-08', DATE '2024-01-09',
       DATE '2024-01-06', DATE '2024-01-09', DATE '2024-01-09', DATE '2024-01-09'),
      (DATE '2024-01-10', DATE '2024-01-09', DATE '2024-01-11', DATE '2024-01-09', DATE '2024-01-10',
       DATE '2024-01-10', DATE '2024-01-10', DATE '2024-01-10', DATE '2024-01-10'),
      (DATE '2024-01-11', DATE '2024-01-10', DATE '2024-01-12', DATE '2024-01-10', DATE '2024-01-11',
       DATE '2024-01-11', DATE '2024-01-11', DATE '2024-01-11', DATE '2024-01-11'),
      (DATE '2024-01-12', DATE '2024-01-11', DATE '2024-01-15', DATE '2024-01-11', DATE '2024-01-14',
       DATE '2024-01-12', DATE '2024-01-12', DATE '2024-01-12', DATE '2024-01-14'))
      AS r(report_date, prev_bd, next_bd, bank_t0, bank_t1, unity_from, unity_to, tx_from, tx_to)
"""
WINDOW_DATES = ["2024-01-05", "2024-01-09", "2024-01-10", "2024-01-11", "2024-01-12"]

# Business days of January 2024 with their offsets, by self-joins on a day list.
RD_MONTH = """
    WITH days AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '2023-12-15', DATE '2024-02-15', INTERVAL 1 DAY) AS g(d)),
    open AS (SELECT d FROM days WHERE isodow(d) <= 5
             AND d NOT IN (DATE '2023-12-25', DATE '2024-01-01', DATE '2024-01-08')),
    near AS (SELECT o.d, (SELECT MAX(p.d) FROM open p WHERE p.d < o.d) AS prev_bd,
                    (SELECT MIN(n.d) FROM open n WHERE n.d > o.d) AS next_bd
             FROM open o WHERE o.d BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')
    SELECT d AS report_date, prev_bd, next_bd, CAST(d - 1 AS DATE) AS bank_t0, CAST(next_bd - 1 AS DATE) AS bank_t1,
           CAST(prev_bd + 1 AS DATE) AS unity_from, d AS unity_to, d AS tx_from, CAST(next_bd - 1 AS DATE) AS tx_to
    FROM near
"""

# Calendar for arbitrary years: holidays from the law, neighbours by window functions.
CALENDAR = """
    years AS (SELECT y FROM generate_series({first}, {last}) AS g(y)),
    e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
    e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
    e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
    e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM e3),
    easter AS (SELECT y, make_date(y, n // 31, n % 31 + 1) AS e FROM e4),
    holidays AS (
      SELECT make_date(y, m, d) AS h FROM years, (VALUES (1,1),(5,1),(7,20),(8,7),(12,8),(12,25)) AS f(m, d)
      UNION
      SELECT CAST(make_date(y, m, d) + CAST((8 - isodow(make_date(y, m, d))) % 7 AS INT) AS DATE)
      FROM years, (VALUES (1,6),(3,19),(6,29),(8,15),(10,12),(11,1),(11,11)) AS f(m, d)
      UNION
      SELECT CAST(e + o AS DATE) FROM easter, (VALUES (-3),(-2),(43),(64),(71)) AS f(o)),
    days AS (
      SELECT CAST(x AS DATE) AS d,
             isodow(x) <= 5 AND CAST(x AS DATE) NOT IN (SELECT h FROM holidays) AS bd
      FROM generate_series(DATE '{first}-01-01', DATE '{last}-12-31', INTERVAL 1 DAY) AS g(x)),
    marked AS (SELECT d, bd, bd AND NOT (month(d) = 12 AND day(d) = 31) AS settle FROM days),
    cal AS (
      SELECT d, bd, settle,
        MAX(CASE WHEN bd THEN d END) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_bd,
        MIN(CASE WHEN bd THEN d END) OVER (ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_bd,
        MAX(CASE WHEN settle THEN d END) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_s,
        MIN(CASE WHEN settle THEN d END) OVER (ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_s
      FROM marked)
"""


def _calendar(first: int, last: int) -> str:
    return CALENDAR.format(first=first, last=last)


def _bank_date(start: str, fallback: str) -> str:
    base = f"(CASE WHEN {start} < DATE '2026-03-13' THEN CAST({start} - 1 AS DATE) ELSE {fallback} END)"
    year_end = f"strftime({start}, '%m-%d') = '12-31'"
    moved = f"(CASE WHEN {year_end} THEN CAST({base} + 2 AS DATE) ELSE {base} END)"
    return f"(CASE WHEN strftime({moved}, '%m-%d') = '12-31' THEN CAST({moved} + 1 AS DATE) ELSE {moved} END)"


def _query(body: str, *tables: str, rd: str | None = RD_WINDOW) -> str:
    """A statement over the named source tables and ``rd``, the report dates."""
    parts = [f"{t} AS ({SOURCES[t]})" for t in tables]
    if rd:
        parts.append(f"rd AS ({rd})")
    text = body.strip()
    if text.upper().startswith("WITH "):
        text = text[5:]
        return "WITH " + ",\n".join([*parts, text])
    return "WITH " + ",\n".join(parts) + "\n" + text


def d(sql: str) -> str:
    return f"CAST({sql} AS DECIMAL(18,4))"


def zsum(sql: str) -> str:
    return f"CAST(COALESCE(SUM({sql}), 0) AS DECIMAL(26,4))"


def out(sql: str) -> str:
    return f"CAST(ROUND({sql}, 2) AS DOUBLE)"


def outs(*names: str) -> str:
    return ", ".join(f"{out(n)} AS {n}" for n in names)


# --- banks ------------------------------------------------------------------------------

CENTRAL = {
    "banrep_norem90": "'62015990'",
    "banrep_norem91": "'62015991'",
    "banrep_rem": "'64011480'",
}
COMMERCIAL = {
    "savings_dav": "'570033570004227'",
    "savings_occ": "'423816990'",
    "savings_bog": "'434381323'",
    "savings_banc": "'61100001577'",
    "adm_dav": "'560033569994602','560033569994594'",
    "adm_bog": "'434394037','434394045'",
    "adm_banc": "'61100001064','61100001065','61100001369','61100001576'",
}
USD = {
    "usd_cayman": "'86110'",
    "usd_bofa": "'1901751916'",
    "usd_citi": "'14674340'",
    "usd_citi_usd": "'36442812'",
    "usd_citi2": "'36506441'",
    "usd_panama": "'80110003748'",
    "usd_bradesco": "'30863139'",
}
_OWN = "nombre_titular_cuenta = 'HOLDER SA'"

# A second institution over the same sources: central bank, commercial and dollar accounts, holder.
OTHER = (
    {"central": "'62015990','62015991'"},
    {"payroll": "'423816990','434381323'", "operating": "'61100001577'"},
    {"dollars": "'86110','1901751916'"},
)
_OTHER_OWN = "nombre_titular_cuenta = 'OTHER HOLDER'"


def _bank_sums(central: dict[str, str], commercial: dict[str, str], usd: dict[str, str], own: str) -> str:
    columns = []
    for name, accounts in central.items():
        columns.append(f"{zsum(f'CASE WHEN numero_cuenta IN ({accounts}) THEN ' + d('saldo_bancario_final') + ' END')} AS {name}")
    for name, accounts in commercial.items():
        columns.append(
            f"{zsum(f'CASE WHEN numero_cuenta IN ({accounts}) AND {own} THEN ' + d('saldo_bancario_final') + ' END')} AS {name}"
        )
    for name, accounts in usd.items():
        final = zsum(f"CASE WHEN numero_cuenta IN ({accounts}) AND {own} THEN {d('saldo_bancario_final')} END")
        clearing = zsum(f"CASE WHEN numero_cuenta IN ({accounts}) AND {own} THEN {d('saldo_en_canje')} END")
        columns.append(f"{final} - ABS({clearing}) AS {name}")
    return ", ".join(columns)


def _balances(name: str, sums: str) -> str:
    return f"""
    {name} AS (
      SELECT r.report_date, c.cut, {sums}
      FROM rd r CROSS JOIN (VALUES ('t0'), ('t1')) AS c(cut)
      LEFT JOIN bank_balances b ON b.fecha_movimiento = CASE c.cut WHEN 't0' THEN r.bank_t0 ELSE r.bank_t1 END
      GROUP BY r.report_date, c.cut)
"""


BALANCES = _balances("balances", _bank_sums(CENTRAL, COMMERCIAL, USD, _OWN))
RATES = f"""
    rates AS (
      SELECT r.report_date,
        (SELECT {zsum(d('valor'))} FROM trm WHERE r.prev_bd BETWEEN vigencia_desde AND vigencia_hasta) AS rate_t0,
        (SELECT {zsum(d('valor'))} FROM trm WHERE r.report_date BETWEEN vigencia_desde AND vigencia_hasta) AS rate_t1
      FROM rd r)
"""


def _available_of(name: str, balances: str, central: dict[str, str], commercial: dict[str, str], usd: dict[str, str]) -> str:
    return f"""
    {name} AS (
      SELECT b.report_date, b.cut, {' + '.join(central)} AS banco_republica, {' + '.join(commercial)} AS bancos_comerciales,
        CAST({' + '.join(usd)} AS DECIMAL(20,4)) * CAST(CASE b.cut WHEN 't0' THEN rate_t0 ELSE rate_t1 END AS DECIMAL(14,4)) AS bancos_usd,
        CASE b.cut WHEN 't0' THEN rate_t0 ELSE rate_t1 END AS trm
      FROM {balances} b JOIN rates r ON b.report_date = r.report_date)
"""


AVAILABLE = _available_of("available", "balances", CENTRAL, COMMERCIAL, USD)
_AVAILABLE_COLUMNS = (
    outs("banco_republica", "bancos_comerciales", "bancos_usd", "trm")
    + f", {out('banco_republica + bancos_comerciales + bancos_usd')} AS total"
)


def _available(cut: str) -> str:
    return _query(
        f"WITH {BALANCES}, {RATES}, {AVAILABLE} SELECT {_AVAILABLE_COLUMNS}, report_date AS fecha_reporte "
        f"FROM available WHERE cut = '{cut}'",
        "bank_balances",
        "trm",
    )


_UNION = (
    f"SELECT {_AVAILABLE_COLUMNS}, CASE cut WHEN 't0' THEN 'disponible_t-0' ELSE 'disponible_t-1' END AS tipo_disponible, "
    "report_date AS fecha_reporte FROM available"
)
_BY_INSTITUTION = _query(
    f"""WITH {BALANCES}, {_balances("other_balances", _bank_sums(*OTHER, _OTHER_OWN))}, {RATES}, {AVAILABLE},
      {_available_of("other", "other_balances", *OTHER)}
      SELECT 'first' AS institution, * FROM ({_UNION})
      UNION ALL SELECT 'second' AS institution, * FROM ({_UNION.replace("FROM available", "FROM other")})""",
    "bank_balances",
    "trm",
)

# --- money market -------------------------------------------------------------------------

TRADES = """
    trades AS (
      SELECT m.*, o.fecha_cuadre FROM money_market m JOIN unity_operations o ON m.consecutivo = o.consecutivo
      WHERE o.fecha_cuadre IN (SELECT report_date FROM rd) AND m.tipo_operacion IN ('C', 'V'))
"""
_DEP = "cod_central_deposito IN ('DCV', 'DVL')"
_TES = "regexp_matches(codigo_especie, 'CT')"
_PRIV = "regexp_matches(codigo_especie, 'CA|CB|CD|CH|CI|CP|CS|MM')"
_OUTRIGHT = f"clasificacion = 'NORMAL' AND nemotecnico <> 'MONEYMARKET' AND {_DEP}"
_DOLLAR = "clasificacion = 'NORMAL' AND nemotecnico = 'MONEYMARKET' AND genera_detalle = 'SI'"
_COMMON = {
    "sim_tes_active": f"clasificacion = 'SIM' AND {_DEP} AND tipo_sim = 'A' AND {_TES}",
    "sim_tes_passive": f"clasificacion = 'SIM' AND {_DEP} AND tipo_sim = 'P' AND {_TES}",
    "sim_priv_active": f"clasificacion = 'SIM' AND {_DEP} AND tipo_sim = 'A' AND {_PRIV}",
    "sim_priv_passive": f"clasificacion = 'SIM' AND {_DEP} AND tipo_sim = 'P' AND {_PRIV}",
    "buy_tes": f"{_OUTRIGHT} AND tipo_operacion = 'C' AND {_TES}",
    "sell_tes": f"{_OUTRIGHT} AND tipo_operacion = 'V' AND {_TES}",
    "buy_priv": f"{_OUTRIGHT} AND tipo_operacion = 'C' AND NOT {_TES}",
    "sell_priv": f"{_OUTRIGHT} AND tipo_operacion = 'V' AND NOT {_TES}",
    "dollar_buy": f"{_DOLLAR} AND tipo_operacion = 'C'",
    "dollar_sell": f"{_DOLLAR} AND tipo_operacion = 'V'",
    "ttv_sell": "clasificacion = 'TTV' AND tipo_operacion = 'V'",
    "ttv_buy": "clasificacion = 'TTV' AND tipo_operacion = 'C'",
}
_SETTLING = {
    **_COMMON,
    "repo_active": f"clasificacion = 'REPO' AND {_DEP} AND tipo_sim = 'A'",
    "repo_passive": f"clasificacion = 'REPO' AND {_DEP} AND tipo_sim = 'P'",
}
_SAME_DAY = {
    **_COMMON,
    **{
        f"repo_{stance}_{side}": f"clasificacion = 'REPO' AND {_DEP} AND tipo_sim = '{s}' AND tipo_operacion = '{o}'"
        for stance, s in (("active", "A"), ("passive", "P"))
        for side, o in (("buy", "C"), ("sell", "V"))
    },
}
_NEGATIVE = ["sim_tes_passive", "sim_priv_passive", "buy_tes", "buy_priv", "repo_passive", "dollar_buy", "ttv_buy"]


def _trade_sums(cases: dict[str, str], prefix: str) -> str:
    return ", ".join(
        f"{zsum(f'CASE WHEN {cond} THEN ' + d('valor_de_giro') + ' END')} AS {prefix}{name}" for name, cond in cases.items()
    )


MM = f"""
    mm AS (
      SELECT r.report_date, {_trade_sums(_SETTLING, 'mm_')}
      FROM rd r LEFT JOIN trades t ON t.fecha_cuadre = r.report_date
        AND t.fecha_operacion <> r.report_date AND t.fecha_cumplimiento = r.report_date
      GROUP BY r.report_date)
"""
SD = f"""
    sd AS (
      SELECT r.report_date, {_trade_sums(_SAME_DAY, 'sd_')}
      FROM rd r LEFT JOIN trades t ON t.fecha_cuadre = r.report_date
        AND t.fecha_operacion = r.report_date AND t.fecha_cumplimiento = r.report_date
      GROUP BY r.report_date)
"""

# --- movements ----------------------------------------------------------------------------

_CODE = """CASE WHEN m.concepto IS NOT NULL THEN m.concepto
             WHEN o.clasificacion = 'NORMAL' THEN
               CASE WHEN right(o.liquidacion, 2) = 'SB' THEN '44206'
                    WHEN right(o.liquidacion, 2) <> 'SB' AND right(o.liquidacion, 2) <> 'OF' THEN '43422'
                    WHEN right(o.liquidacion, 2) = 'OF' THEN '43420' END
             WHEN o.clasificacion = 'SIM' THEN
               CASE WHEN o.tipo_operacion = 'V' AND o.fecha_futura IS NULL THEN '45495'
                    WHEN o.tipo_operacion = 'V' AND o.fecha_futura IS NOT NULL THEN '45435'
                    WHEN o.tipo_operacion = 'C' AND o.fecha_futura IS NULL THEN '44495'
                    WHEN o.tipo_operacion = 'C' AND o.fecha_futura IS NOT NULL THEN '44435' END
             WHEN o.clasificacion = 'TTV' THEN '44211'
             WHEN o.clasificacion = 'REPO' THEN
               CASE o.tipo_operacion WHEN 'C' THEN '44481' WHEN 'V' THEN '45431' END
        END"""
MOVES = f"""
    moves AS (
      SELECT r.report_date, m.valor, m.cod_tipo_movimiento, m.rendimiento,
        {_CODE} AS code
      FROM rd r JOIN cc_movements m ON m.fecha BETWEEN r.unity_from AND r.unity_to
      LEFT JOIN unity_operations o ON m.operacion = o.consecutivo),
    named AS (
      SELECT m.report_date,
        CASE WHEN m.rendimiento IS NOT NULL THEN 'PAGO RENDIMIENTOS'
             WHEN code = '310' THEN 'DIVISAS SEBRA'
             WHEN code IN ('389', '366') THEN 'DERIVADOS OTC'
             WHEN code = '362' THEN 'INTERESES REMUNERADO'
             ELSE COALESCE(h.concepto_cud, 'Falta Homologación: ' || code) END AS concepto,
        CASE WHEN cod_tipo_movimiento = 'ND' THEN -{d('valor')} ELSE {d('valor')} END AS valor
      FROM moves m LEFT JOIN homologation h ON m.code = h.codigo_contable)
"""
_OTHER = """'APR. OP CON DECEVAL RECURSOS PROPIOS', 'APR. OP CON DCV RECURSOS PROPIOS', 'AP.ENTRE CUENTAS DE DEP. DE LA MISMA ENT',
    'TRANSFERENCIA DE FONDOS PARA OPERAC', 'APR. ENTRE CTAS DEPÓS. DIFERENTE TI', 'APR OP ESPEC MERC SECUN RENTA VARIA',
    'APR.CONSTITUCION INTERBANCARIOS INT', 'APR. OP CON TÍTULOS DEPOSITADOS EN DCV',
    'TRANSFERENCIA DE FONDOS PARA OPERACIONES FICS - BANCO COMERCIAL Y CUSTODIO',
    'APR.CONSTITUCION INTERBANCARIOS INTRADIA', 'A.DESEMBOLSOS DE CREDITO - ESTABLECIMIEN',
    'APR OP ESPEC MERC SECUN RENTA VARIAB BVC'"""
_OPS = """'AP. CONSTITUCION GARANTIA POR POSIC', 'AP. DEVOLUCION GARANTIA EXTRAORDINA', 'AP. CONSTITUCION GARANTIA EXTRAORDI',
    'AP. DEVOLUCION GARANTIA POR POSICIO', 'AP. LIQUIDACION DIARIA OPERACIONES', 'INTERESES REMUNERADO'"""
_FEES = """'DB TARIFA TRANSACCIONAL CUD', 'AP. SERVICIOS CRCC - PD', 'DB IVA', 'DB PAGO DE TARIFAS DCV',
    'DB TARIFA ADMINISTRACION DE CUENTAS', 'DB TARIFA PUNTOS S.E.B.R.A', 'DB TARIFAS SEN'"""
_UNITY = {
    "repurchases": ("-", "concepto = 'OPERACIONES DVP DECEVAL'"),
    "due_cdt": ("-", "concepto = 'APR.PAGOS DE EMISORES S/ TÍTULOS VA'"),
    "yields": ("", "concepto = 'PAGO RENDIMIENTOS'"),
    "gmf": ("-", "concepto = 'G.M.F. SOBRE LA TRANSACCIÓN'"),
    "pay_findeter": ("-", "concepto = 'A.PAGOS POR CAP. E INTERESES SOBRE CRÉDI'"),
    "expense_sebra": ("-", f"concepto IN ({_FEES})"),
    "sebra_fx_in": ("", "concepto = 'DIVISAS SEBRA' AND valor > 0"),
    "sebra_fx_out": ("-", "concepto = 'DIVISAS SEBRA' AND valor < 0"),
    "otc_in": ("", "concepto = 'DERIVADOS OTC' AND valor > 0"),
    "otc_out": ("-", "concepto = 'DERIVADOS OTC' AND valor < 0"),
    "other_in": ("", f"concepto IN ({_OTHER}) AND valor > 0"),
    "other_out": ("-", f"concepto IN ({_OTHER}) AND valor < 0"),
    "other_ops_in": ("", f"concepto IN ({_OPS}) AND valor > 0"),
    "other_ops_out": ("-", f"concepto IN ({_OPS}) AND valor < 0"),
}
UNITY = f"""
    unity AS (
      SELECT r.report_date,
        {', '.join(f"{sign}{zsum(f'CASE WHEN {cond} THEN n.valor END')} AS {name}" for name, (sign, cond) in _UNITY.items())},
        0 AS breb_in, 0 AS breb_out
      FROM rd r LEFT JOIN named n ON n.report_date = r.report_date GROUP BY r.report_date)
"""

# The movements themselves, with every column.
MOVE_ROWS = f"""
    move_rows AS (
      SELECT r.report_date, 'movements' AS cut, m.*, o.clasificacion, o.liquidacion, o.tipo_operacion, o.fecha_futura
      FROM rd r JOIN cc_movements m ON m.fecha BETWEEN r.unity_from AND r.unity_to
      LEFT JOIN unity_operations o ON m.operacion = o.consecutivo)
"""
CONCEPT_ROWS = f"""
    {MOVE_ROWS},
    concept_rows AS (
      SELECT m.* EXCLUDE (concepto), {_CODE.replace('o.', 'm.')} AS concepto FROM move_rows m)
"""
VALUE_ROWS = f"""
    {CONCEPT_ROWS}
    SELECT c.* EXCLUDE (concepto, valor), h.*,
      CASE WHEN c.rendimiento IS NOT NULL THEN 'PAGO RENDIMIENTOS'
           WHEN c.concepto = '310' THEN 'DIVISAS SEBRA'
           WHEN c.concepto IN ('389', '366') THEN 'DERIVADOS OTC'
           WHEN c.concepto = '362' THEN 'INTERESES REMUNERADO'
           ELSE COALESCE(h.concepto_cud, 'Falta Homologación: ' || c.concepto) END AS concepto,
      CASE WHEN c.cod_tipo_movimiento = 'ND' THEN -c.valor ELSE c.valor END AS valor
    FROM concept_rows c LEFT JOIN homologation h ON c.concepto = h.codigo_contable
"""

# --- channels -----------------------------------------------------------------------------

LATEST = """
    latest AS (
      SELECT clave_codificada, id, version FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY clave_codificada
          ORDER BY fecha_ultima_modificacion DESC, version DESC) AS rn FROM accounts) WHERE rn = 1)
"""
TX = f"""
    {LATEST},
    tx AS (
      SELECT r.report_date, c.nombre AS canal, {d('t.monto')} AS monto, a.id, strftime(t.fecha_hora_valor, '%H:%M:%S') AS hhmmss
      FROM rd r JOIN transactions t ON t.fecha_valor = r.report_date
      JOIN latest a ON t.clave_cuenta_padre = a.clave_codificada
      JOIN channels c ON t.clave_canal = c.clave_codificada)
"""
_W = [("00:00:00", "08:31:00"), ("08:31:01", "11:01:00"), ("11:01:01", "13:31:00"), ("13:31:01", "15:34:00"), ("15:34:01", "23:59:59")]
_D = [("00:00:00", "10:30:00"), ("10:30:01", "13:00:00"), ("13:00:01", "15:30:00"), ("15:30:01", "17:30:00"), ("17:30:01", "23:59:59")]
_SLOTS = {
    f"{prefix}_{i}": f"CASE WHEN canal = '{channel}' AND hhmmss >= '{a}' AND hhmmss <= '{b}' THEN {value} END"
    for prefix, channel, slots, value in (
        ("ret", "RETIRO ACH", _W, "-monto"),
        ("dep", "DEPOSITO ACH", _D, "monto"),
        ("dev", "DEVOLUCION RETIRO ACH", _D, "monto"),
    )
    for i, (a, b) in enumerate(slots)
}
_TRANSFERS = {
    "debit_sebra": "CASE WHEN canal = 'TRASLADO FONDOS SEBRA DEBITO' THEN ABS(monto) END",
    "credit_sebra": "CASE WHEN canal = 'TRASLADO FONDOS SEBRA CREDITO' THEN monto END",
    "debit_returns_sebra": "CASE WHEN canal = 'DEVOLUCION TRASLADO FONDOS SEBRA DEBITO' THEN monto END",
    "credit_returns_sebra": "CASE WHEN canal = 'DEVOLUCION TRASLADO FONDOS SEBRA CREDITO' THEN ABS(monto) END",
}
_KEPT = "canal NOT IN ('RECARGA SALDO PARA OPERACIONES DE CRED/CONF', 'DESCARGA SALDOS RECAUDOS CREDITOS')"
_CREDIT = {
    "credit_income": f"CASE WHEN {_KEPT} AND id = '12528874205' AND monto >= 0 THEN monto END",
    "credit_negative": f"CASE WHEN {_KEPT} AND id = '12528874205' AND monto < 0 THEN monto END",
    "deposit_cros": f"CASE WHEN {_KEPT} AND canal = 'DEPOSITO CROS' AND monto > 0 THEN monto END",
    "confirming_income": f"CASE WHEN {_KEPT} AND id = '12561730308' AND monto >= 0 THEN monto END",
    "confirming_negative": f"CASE WHEN {_KEPT} AND id = '12561730308' AND monto < 0 THEN monto END",
}
CHANNELS = f"""
    chan AS (
      SELECT r.report_date, {', '.join(f'{zsum(sql)} AS {n}' for n, sql in {**_SLOTS, **_TRANSFERS, **_CREDIT}.items())}
      FROM rd r LEFT JOIN tx ON tx.report_date = r.report_date GROUP BY r.report_date)
"""
_CREDIT_OUT = "(-credit_negative + deposit_cros)"
NET = f"""
    credit_list AS (
      SELECT DISTINCT report_date, monto FROM tx
      WHERE canal IN ('TRASLADO FONDOS SEBRA DEBITO', 'TRASLADO FONDOS SEBRA CREDITO',
                      'DEVOLUCION TRASLADO FONDOS SEBRA DEBITO', 'DEVOLUCION TRASLADO FONDOS SEBRA CREDITO')
        AND id IN ('12528874205', '12561730308')),
    third AS (
      SELECT n.report_date, n.valor FROM named n
      WHERE n.concepto = 'APR ENTR CTA DEPÓS DIFER TITULAR-TERCERO'
        AND NOT EXISTS (SELECT 1 FROM credit_list c WHERE c.report_date = n.report_date AND c.monto = n.valor)),
    net AS (
      SELECT r.report_date, {zsum('CASE WHEN t.valor > 0 THEN t.valor END')} AS sebra_in,
             {zsum('CASE WHEN t.valor < 0 THEN t.valor END')} AS sebra_out
      FROM rd r LEFT JOIN third t ON t.report_date = r.report_date GROUP BY r.report_date)
"""

# --- refunds ------------------------------------------------------------------------------

_AMOUNT = (
    "TRY_CAST(CASE WHEN length(reg6_valor_transaccion) > 2 "
    "THEN left(reg6_valor_transaccion, length(reg6_valor_transaccion) - 2) END AS DECIMAL(28,4))"
)
_ADAPTER_ROWS = f"a.*, TRY_CAST(string_split(a.name, '.')[2] AS INTEGER) AS cycle, {_AMOUNT} AS amount"
REFUND_ROWS = f"""
    refund_rows AS (
      SELECT r.report_date, CASE WHEN a.fecha_consulta = r.report_date THEN 'today' ELSE 'yesterday' END AS which_day, {_ADAPTER_ROWS}
      FROM rd r JOIN adapter a ON a.fecha_consulta = r.report_date OR a.fecha_consulta = r.prev_bd)
"""
_OUT = "name LIKE '%OUT' AND status = 'unauthorized'"
MATCHED = f"""
    out_groups AS (
      SELECT report_date, which_day, reg6_cuenta_receptora AS k1, reg6_entidad_receptora AS k2, reg5_nombre_originador AS k3,
        reg5_entidad_originadora AS k4, reg6_nombre_cliente_receptor AS k5, reg6_valor_transaccion AS k6, amount, COUNT(*) AS n
      FROM refund_rows WHERE {_OUT} AND cycle >= 4 GROUP BY ALL),
    sent_groups AS (
      SELECT report_date, which_day, reg6_cuenta_receptora AS k1, reg5_entidad_originadora AS k2, reg5_nombre_originador AS k3,
        reg6_entidad_receptora AS k4, reg6_nombre_cliente_receptor AS k5, reg6_valor_transaccion AS k6, amount, COUNT(*) AS n
      FROM refund_rows WHERE transaction_type = '_ach_dev_enviada' GROUP BY ALL),
    matched AS (
      SELECT x.report_date, x.which_day, {zsum('CASE WHEN s.n IS NOT NULL THEN LEAST(o.n, s.n) * o.amount END')} AS matched
      FROM (SELECT report_date, unnest(['today', 'yesterday']) AS which_day FROM rd) x
      LEFT JOIN out_groups o ON o.report_date = x.report_date AND o.which_day = x.which_day
      LEFT JOIN sent_groups s ON s.report_date = o.report_date AND s.which_day = o.which_day AND s.k1 = o.k1 AND s.k2 = o.k2
        AND s.k3 = o.k3 AND s.k4 = o.k4 AND s.k5 = o.k5 AND s.k6 = o.k6 AND s.amount = o.amount
      GROUP BY x.report_date, x.which_day)
"""
_ORIGINATED = (
    "CASE WHEN which_day = 'today' AND ltrim(trim(reg5_datos_originador), '0') = '62015991' THEN -(CASE WHEN length(trim(reg6_valor_transaccion)) > 2 "
    "THEN TRY_CAST(left(trim(reg6_valor_transaccion), length(trim(reg6_valor_transaccion)) - 2) AS DECIMAL(28,4)) ELSE 0 END) END"
)
REFUNDS = f"""
    refund AS (
      SELECT r.report_date,
        {', '.join(f"{zsum(f'CASE WHEN which_day = {chr(39)}today{chr(39)} AND {_OUT} AND cycle = {i} THEN amount END')} AS cud_{i}" for i in range(1, 6))},
        {zsum(f"CASE WHEN which_day = 'yesterday' AND {_OUT} AND cycle >= 4 THEN amount END")} AS late,
        {zsum(_ORIGINATED)} AS adaptor
      FROM rd r LEFT JOIN refund_rows x ON x.report_date = r.report_date GROUP BY r.report_date),
    refunds AS (
      SELECT f.*, late - COALESCE(y.matched, 0) AS send_0, cud_1 AS send_1, cud_2 AS send_2, cud_3 AS send_3,
        COALESCE(t.matched, 0) AS send_4
      FROM refund f LEFT JOIN matched y ON y.report_date = f.report_date AND y.which_day = 'yesterday'
      LEFT JOIN matched t ON t.report_date = f.report_date AND t.which_day = 'today')
"""

# --- statements, deposits, securities -------------------------------------------------------

STATEMENT = f"""
    bank_rows AS (
      SELECT r.report_date, m.cuenta_bancaria, m.moneda, {d('m.monto')} AS monto
      FROM rd r JOIN multicash m ON m.fecha_mvto BETWEEN r.tx_from AND r.tx_to
      JOIN umbrella c ON m.cuenta_bancaria = regexp_replace(c.cuenta_bancaria, '^0+', '')
      WHERE c.titular = 'HOLDER SA' AND c.estado = 'ACTIVA'),
    bt AS (
      SELECT r.report_date, {zsum("CASE WHEN moneda = 'COP' AND monto >= 0 THEN monto END")} AS cop_in,
        -{zsum("CASE WHEN moneda = 'COP' AND monto < 0 THEN monto END")} AS cop_out,
        {zsum("CASE WHEN moneda = 'USD' AND monto >= 0 THEN monto END")} AS usd_in,
        -{zsum("CASE WHEN moneda = 'USD' AND monto < 0 THEN monto END")} AS usd_out
      FROM rd r LEFT JOIN bank_rows b ON b.report_date = r.report_date
        AND b.cuenta_bancaria NOT IN ('62015991', '62015990', '64011480')
      GROUP BY r.report_date)
"""
DEPOSITS = f"""
    deposit AS (
      SELECT b.fecha_saldo, {zsum(f"COALESCE({d('b.total_balance')}, 0)")} AS total_balance
      FROM balance b JOIN deposit_account c ON b.id_cuenta = c.id_cuenta_deposito
      WHERE c.id_producto IN ('P1', 'P2', 'P3')
        AND (b.fecha_saldo IN (SELECT report_date FROM rd) OR b.fecha_saldo IN (SELECT prev_bd FROM rd))
      GROUP BY b.fecha_saldo),
    variation AS (
      SELECT r.report_date, COALESCE(t.total_balance - p.total_balance, 0) AS account_variation
      FROM rd r LEFT JOIN deposit t ON t.fecha_saldo = r.report_date LEFT JOIN deposit p ON p.fecha_saldo = r.prev_bd)
"""
SECURITIES = f"""
    renewed AS (
      SELECT r.report_date, {zsum(d('total_renovacion'))} AS renewals
      FROM rd r LEFT JOIN renewals c ON c.fecha_operacion = r.report_date GROUP BY r.report_date),
    profit AS (
      SELECT r.report_date, {zsum(d('utilidad'))} AS pnl
      FROM rd r LEFT JOIN derivatives x ON x.fecha_inicial = r.prev_bd AND x.descripcion = 'HOLDER SA'
        AND x.tipo_cumplimiento = 'F' GROUP BY r.report_date)
"""
# Days on which an operation of a report date may have been agreed: the four business days
# before it and itself, by counting the business days in between.
AGREED = """
    work AS (SELECT CAST(x AS DATE) AS d FROM generate_series(DATE '2023-12-01', DATE '2024-02-15', INTERVAL 1 DAY) AS g(x)
             WHERE isodow(x) <= 5
             AND CAST(x AS DATE) NOT IN (DATE '2023-12-08', DATE '2023-12-25', DATE '2024-01-01', DATE '2024-01-08')),
    agreed AS (SELECT report_date, report_date AS source_date FROM rd
               UNION ALL SELECT r.report_date, w.d FROM rd r JOIN work w ON w.d < r.report_date
               WHERE (SELECT COUNT(*) FROM work n WHERE n.d >= w.d AND n.d < r.report_date) <= 4)
"""
PAPERS = f"""
    {AGREED.strip()},
    papers AS (
      SELECT a.fecha_inicio AS report_date, CASE WHEN a.codigo_isin LIKE 'COB70CD%' THEN 'cdt' ELSE 'bonds' END AS kind,
        b.tipo_participacion, {d('a.precio_contado')} AS price, {d('b.saldo')} AS saldo
      FROM operations_a a JOIN operations_b b ON a.id = b.id_padre
      WHERE (a.codigo_isin LIKE 'COB70CD%' OR a.codigo_isin LIKE 'COB70CB%') AND b.tipo_participacion IN (1, 2)
        AND b.nombre_inversion = 'HOLDER S.A'
        AND EXISTS (SELECT 1 FROM agreed g WHERE g.report_date = a.fecha_inicio AND g.source_date = a.fecha_operacion)),
    issued AS (
      SELECT r.report_date, {', '.join(
        f"CASE WHEN COUNT(CASE WHEN {cond} THEN 1 END) = 1 THEN round_even(MAX(CASE WHEN {cond} THEN {value} END), 2) "
        f"ELSE {zsum(f'CASE WHEN {cond} THEN {value} END')} END AS {name}"
        for name, cond, value in (
            ("repurchases_paid", "kind = 'cdt' AND tipo_participacion = 1", "price"),
            ("cdt_issuances", "kind = 'cdt' AND tipo_participacion = 2", "saldo"),
            ("bond_issuances", "kind = 'bonds' AND tipo_participacion = 2", "saldo"),
        ))}
      FROM rd r LEFT JOIN papers p ON p.report_date = r.report_date GROUP BY r.report_date)
"""

# --- statements -----------------------------------------------------------------------------

ALL_TABLES = list(SOURCES)
_P = "CAST({} AS DECIMAL(20,4)) * CAST(rate_t0 AS DECIMAL(14,4))"
FLOWS = f"""
    m AS (
      SELECT * EXCLUDE (cdt_issuances, bond_issuances), CAST(cdt_issuances AS DECIMAL(26,4)) AS cdt_issuances,
        CAST(bond_issuances AS DECIMAL(26,4)) AS bond_issuances,
        (mm_dollar_sell - ABS(-mm_dollar_buy)) + sd_dollar_sell - sd_dollar_buy AS dollar_comp,
        {' + '.join(f'(dep_{i} + cud_{i + 1} + dev_{i})' for i in range(5))}
          - (credit_income + confirming_income) - account_variation AS income_ach,
        ({' + '.join(f'(ret_{i} + send_{i})' for i in range(5))} + ABS(adaptor))
          - (ABS({_CREDIT_OUT}) + ABS(-confirming_negative) + ABS(adaptor)) AS outcome_ach,
        {_P.format('usd_in')} AS usd_income, {_P.format('ABS(usd_out)')} AS usd_outcome,
        ({_P.format('usd_in')} - {_P.format('ABS(usd_out)')}) - (z.bancos_usd - o.bancos_usd) AS change_variation,
        z.banco_republica AS z_rep, z.bancos_comerciales AS z_com, z.bancos_usd AS z_usd,
        o.banco_republica AS o_rep, o.bancos_comerciales AS o_com, o.bancos_usd AS o_usd
      FROM rd
      JOIN mm USING (report_date) JOIN sd USING (report_date) JOIN unity USING (report_date) JOIN chan USING (report_date)
      JOIN net USING (report_date) JOIN refunds USING (report_date) JOIN bt USING (report_date)
      JOIN variation USING (report_date) JOIN renewed USING (report_date) JOIN profit USING (report_date)
      JOIN issued USING (report_date) JOIN rates USING (report_date)
      JOIN (SELECT * FROM available WHERE cut = 't0') z USING (report_date)
      JOIN (SELECT * FROM available WHERE cut = 't1') o USING (report_date))
"""
INCOME = {
    "005_credito": "credit_income",
    "005_confirming": "confirming_income",
    "010_definitivas_tes": "mm_sell_tes + sd_sell_tes",
    "010_definitivas_privada": "mm_sell_priv + sd_sell_priv",
    "010_intereses_titulos": "yields",
    "015_simultaneas_activas_tes_regreso": "mm_sim_tes_active",
    "015_simultaneas_activas_privada_regreso": "mm_sim_priv_active",
    "015_repos_activos_regreso": "mm_repo_active + sd_repo_active_sell",
    "020_simultaneas_pasivas_tes_salida": "sd_sim_tes_passive",
    "020_simultaneas_pasivas_privada_salida": "sd_sim_priv_passive",
    "020_repos_pasivos_salida": "sd_repo_passive_sell",
    "020_ttv_ingreso": "mm_ttv_sell + sd_ttv_sell",
    "025_variacion_cuenta_corriente": "account_variation",
    "035_renovacion_cdt": "renewals",
    "040_captacion_cdt": "cdt_issuances",
    "045_derivados_estandarizados": "CASE WHEN pnl >= 0 THEN pnl ELSE 0 END",
    "045_derivados_otc": "otc_in",
    "050_colocacion_bonos": "bond_issuances",
    "055_creditos_bancos": "0",
    "060_ingresos_ach": "income_ach",
    "060_multicash_cop": "cop_in + breb_in",
    "060_multicash_usd": "usd_income",
    "060_compensacion_dolar": "dollar_comp",
    "060_divisas_sebra": "sebra_fx_in",
    "060_otros_ingresos": "other_in + other_ops_in + sebra_in + CASE WHEN change_variation < 0 THEN change_variation ELSE 0 END",
}
EXPENSE = {
    "005_simultaneas_pasivas_tes_regreso": "ABS(-mm_sim_tes_passive)",
    "005_simultaneas_pasivas_privada_regreso": "ABS(-mm_sim_priv_passive)",
    "005_repos_pasivos_regreso": "ABS(-mm_repo_passive) + sd_repo_passive_buy",
    "005_ttv_egreso": "ABS(-mm_ttv_buy) + sd_ttv_buy",
    "010_simultaneas_activas_tes_salida": "sd_sim_tes_active",
    "010_simultaneas_activas_privada_salida": "sd_sim_priv_active",
    "010_repos_activos_salida": "sd_repo_active_buy",
    "015_vencimiento_capital_cdt": "ABS(due_cdt + renewals)",
    "015_vencimiento_rendimientos_cdt": "0",
    "015_recompras": "ABS(repurchases)",
    "020_vencimiento_derivados_estandarizados": "CASE WHEN pnl < 0 THEN ABS(pnl) ELSE 0 END",
    "020_vencimiento_derivados_otc": "otc_out",
    "025_vencimiento_capital_bonos": "0",
    "025_vencimiento_rendimientos_bonos": "0",
    "030_desembolso_credito": f"ABS({_CREDIT_OUT}) + ABS(adaptor)",
    "030_confirming": "ABS(-confirming_negative)",
    "035_compra_inversiones_tes": "ABS(-mm_buy_tes) + sd_buy_tes",
    "035_compra_inversiones_privada": "ABS(-mm_buy_priv) + sd_buy_priv",
    "040_creditos_bancos": "ABS(pay_findeter)",
    "045_retiros_ach": "CASE WHEN income_ach >= 0 THEN ABS(outcome_ach) ELSE outcome_ach + ABS(income_ach) END",
    "045_gmf": "ABS(gmf)",
    "045_multicash_cop": "ABS(cop_out) + breb_out",
    "045_multicash_usd": "usd_outcome",
    "045_compensacion_dolar": "CASE WHEN dollar_comp < 0 THEN ABS(dollar_comp) ELSE 0 END",
    "045_gastos_sebra": "ABS(expense_sebra)",
    "045_divisas_sebra": "ABS(sebra_fx_out)",
    "045_otros_egresos": "ABS(other_out + other_ops_out + sebra_out) + CASE WHEN change_variation >= 0 THEN change_variation ELSE 0 END",
}
STATED = f"""
    lines AS (
      SELECT report_date, {', '.join(f'CAST({sql} AS DECIMAL(30,8)) AS "i_{n}"' for n, sql in INCOME.items())},
        {', '.join(f'CAST({sql} AS DECIMAL(30,8)) AS "e_{n}"' for n, sql in EXPENSE.items())},
        CAST(z_rep + z_com + z_usd AS DECIMAL(30,8)) AS z_total, CAST(o_rep + o_com + o_usd AS DECIMAL(30,8)) AS o_total
      FROM m),
    summed AS (
      SELECT *, CAST({' + '.join(f'"i_{n}"' for n in INCOME)} AS DECIMAL(30,8)) AS income_total,
        CAST({' + '.join(f'"e_{n}"' for n in EXPENSE)} AS DECIMAL(30,8)) AS expense_total
      FROM lines),
    stated AS (
      SELECT *, z_total - o_total AS v, income_total - expense_total AS f,
        (z_total - o_total) - (income_total - expense_total) AS diff FROM summed)
"""
EVERYTHING = ", ".join(
    [BALANCES, RATES, AVAILABLE, TRADES, MM, SD, MOVES, UNITY, TX, CHANNELS, NET, REFUND_ROWS, MATCHED, REFUNDS]
    + [STATEMENT, DEPOSITS, SECURITIES, PAPERS, FLOWS]
)
_PERCENT = (
    "CASE WHEN v <> 0 THEN round_even(CAST(CAST(diff AS DECIMAL(28,4)) AS DOUBLE) / "
    "CAST(CAST(v AS DECIMAL(28,4)) AS DOUBLE) * 100, 3) + 0 END"
)
_SUMMARY = (
    f"SELECT {out('v')} AS variacion_disponible, {out('f')} AS total_flujo, {out('diff')} AS diferencia, "
    f"{_PERCENT} AS porcentaje_diferencia, report_date AS fecha_reporte FROM stated"
)


def _whole(body: str, rd: str = RD_WINDOW) -> str:
    return _query(f"WITH {EVERYTHING}, {STATED} {body}", *ALL_TABLES, rd=rd)


def _inputs(as_of: str | None = None) -> str:
    columns = {
        "incomeComercialesCop": "0",
        "incomeRepos": "sd_repo_passive_sell",
        "incomeSimultaneaTES": "sd_sim_tes_passive",
        "incomeSimultaneaPrivada": "sd_sim_priv_passive",
        "incomeVentaDivisas": "sd_dollar_sell",
        "incomeSwapCaja": "sd_repo_active_sell",
        "incomeCDT": "cdt_issuances",
        "incomeBonos": "bond_issuances",
        "incomeCreditoCapital": "0",
        "incomeCreditoINT8ereses": "0",
        "incomeTIDIS": "sd_sell_tes",
        "incomeTCO": "sd_sell_priv",
        "incomeTDA": "sd_ttv_sell",
        "outcomeEncaje": "0",
        "outcomeComercialesCop": "0",
        "outcomeDepositoRemunerado": "0",
        "outcomeRepos": "sd_repo_active_buy",
        "outcomeSimultaneaTES": "sd_sim_tes_active",
        "outcomeSimultaneaPrivada": "sd_sim_priv_active",
        "outcomeCompraDivisas": "sd_dollar_buy",
        "outcomeSwapCaja": "sd_repo_passive_buy",
        "outcomeRecompras": "repurchases_paid",
        "outcomeDesembolsos": "0",
        "outcomeTIDIS": "sd_buy_tes",
        "outcomeTCO": "sd_buy_priv",
        "outcomeTDA": "sd_ttv_buy",
        "outcomeSEBRA": "0",
        "BancosCopIncome": "cop_in",
        "BancosCopOutcome": "cop_out",
        "BancosUsdIncome": "usd_in",
        "BancosUsdOutcome": "usd_out",
        "account_variation": "account_variation",
        "sebra_in": "sebra_in",
        "sebra_out": "sebra_out",
    }
    if as_of:
        columns = {n: f"CASE WHEN report_date = DATE '{as_of}' THEN 0 ELSE {sql} END" for n, sql in columns.items()}
    return "SELECT report_date, " + ", ".join(f'{out(sql)} AS "{n}"' for n, sql in columns.items()) + " FROM m"


def _transposed() -> str:
    def rows(section_no: int, section: str, columns: dict[str, str], table: str) -> list[str]:
        return [
            f"SELECT {section_no} AS section_no, {i} AS line_no, '{section}' AS section, '{name}' AS metric, "
            f"'{'percentage' if name == 'porcentaje_diferencia' else 'currency'}' AS format, "
            + ", ".join(f"MAX(CASE WHEN report_date = DATE '{day}' THEN {sql} END) AS \"{day}\"" for day in WINDOW_DATES)
            + f" FROM {table}"
            for i, (name, sql) in enumerate(columns.items(), 1)
        ]

    funds = {n: out(n) for n in ("banco_republica", "bancos_comerciales", "bancos_usd", "trm")}
    funds["total"] = out("banco_republica + bancos_comerciales + bancos_usd")
    parts = rows(1, "INGRESOS", {**{n: out(f'"i_{n}"') for n in INCOME}, "total": out("income_total")}, "stated")
    parts += rows(2, "EGRESOS", {**{n: out(f'"e_{n}"') for n in EXPENSE}, "total": out("expense_total")}, "stated")
    parts += rows(3, "DISPONIBLE T-0", funds, "available WHERE cut = 't0'")
    parts += rows(4, "DISPONIBLE T-1", funds, "available WHERE cut = 't1'")
    summary = {
        "variacion_disponible": out("v"),
        "total_flujo": out("f"),
        "diferencia": out("diff"),
        "porcentaje_diferencia": _PERCENT,
    }
    parts += rows(5, "RESUMEN DISPONIBLE", summary, "stated")
    return " UNION ALL ".join(parts)


# Statements of a few lines, and instant payments.
_FEW_INCOME = {
    "treasury": "mm_sell_tes + sd_sell_tes + mm_sell_priv + sd_sell_priv + yields",
    "deposits": "account_variation + renewals + cdt_issuances + bond_issuances",
    "payments": "income_ach + cop_in + usd_income + 1250.75",
}
_FEW_EXPENSE = {
    "treasury": "ABS(-mm_buy_tes) + sd_buy_tes + ABS(-mm_buy_priv) + sd_buy_priv",
    "certificates": "ABS(repurchases) + ABS(due_cdt + renewals)",
    "payments": "ABS(outcome_ach) + ABS(cop_out) + usd_outcome + 300",
}


def _condensed() -> str:
    def rows(section_no: int, section: str, columns: dict[str, str], table: str) -> list[str]:
        return [
            f"SELECT report_date, {section_no} AS section_no, {i} AS line_no, '{section}' AS section, '{name}' AS metric, "
            f"'{'percentage' if name == 'porcentaje_diferencia' else 'currency'}' AS format, {sql} AS value FROM {table}"
            for i, (name, sql) in enumerate(columns.items(), 1)
        ]

    def lines(prefix: str, columns: dict[str, str]) -> str:
        return ", ".join(f"CAST({sql} AS DECIMAL(30,8)) AS {prefix}_{n}" for n, sql in columns.items())

    def summed(prefix: str, columns: dict[str, str]) -> str:
        return " + ".join(f"{prefix}_{n}" for n in columns)

    steps = (
        f"few AS (SELECT report_date, {lines('i', _FEW_INCOME)}, {lines('e', _FEW_EXPENSE)}, "
        "CAST((z_rep + z_com + z_usd) - (o_rep + o_com + o_usd) AS DECIMAL(30,8)) AS v FROM m), "
        f"few_sums AS (SELECT *, {summed('i', _FEW_INCOME)} AS i_total, {summed('e', _FEW_EXPENSE)} AS e_total FROM few), "
        "few_stated AS (SELECT *, i_total - e_total AS f, v - (i_total - e_total) AS diff FROM few_sums)"
    )
    funds = {n: out(n) for n in ("banco_republica", "bancos_comerciales", "bancos_usd", "trm")}
    funds["total"] = out("banco_republica + bancos_comerciales + bancos_usd")
    summary = {"variacion_disponible": out("v"), "total_flujo": out("f"), "diferencia": out("diff"), "porcentaje_diferencia": _PERCENT}
    parts = rows(1, "INGRESOS", {n: out(f"i_{n}") for n in [*_FEW_INCOME, "total"]}, "few_stated")
    parts += rows(2, "EGRESOS", {n: out(f"e_{n}") for n in [*_FEW_EXPENSE, "total"]}, "few_stated")
    parts += rows(3, "DISPONIBLE T-0", funds, "available WHERE cut = 't0'")
    parts += rows(4, "DISPONIBLE T-1", funds, "available WHERE cut = 't1'")
    parts += rows(5, "RESUMEN DISPONIBLE", summary, "few_stated")
    return _query(f"WITH {EVERYTHING}, {steps} {' UNION ALL '.join(parts)}", *ALL_TABLES)


_MOVE_DAYS = "anchors AS (SELECT fecha AS report_date, COUNT(*) AS n_rows FROM cc_movements GROUP BY fecha)"
_MERGED = """
    SELECT banco_republica, bancos_comerciales, bancos_usd, trm,
      CASE WHEN tipo_disponible = 'disponible_t-1' THEN total ELSE 0.0 END AS total, tipo_disponible, fecha_reporte
    FROM unioned WHERE tipo_disponible = 'disponible_t-1' OR fecha_reporte < DATE '2024-01-12'
"""
_MERGE_SQL = _query(f"WITH {BALANCES}, {RATES}, {AVAILABLE}, unioned AS ({_UNION}) {_MERGED}", "bank_balances", "trm")

# --- rows that were not counted -------------------------------------------------------------

_GROUPED = " OR ".join(
    [f"numero_cuenta IN ({a})" for a in CENTRAL.values()]
    + [f"(numero_cuenta IN ({a}) AND {_OWN})" for a in (*COMMERCIAL.values(), *USD.values())]
)
_SAME_KEYS = " AND ".join(f"s.{k} = o.{k}" for k in ("report_date", "which_day", "k1", "k2", "k3", "k4", "k5", "k6", "amount"))
_ALL_KEYS = " AND ".join(f"o.{k} IS NOT NULL" for k in ("k1", "k2", "k3", "k4", "k5", "k6", "amount"))


def _lost(source: str, rows: str, unmatched: str, malformed: str) -> str:
    return (
        f"SELECT report_date, '{source}' AS source, COUNT(*) AS rows_read, COUNT(*) FILTER ({unmatched}) AS unmatched, "
        f"COUNT(*) FILTER ({malformed}) AS malformed FROM ({rows}) GROUP BY report_date"
    )


UNCOUNTED = f"""
    {MOVES}, {REFUND_ROWS}, {MATCHED},
    lost AS (
      {_lost("bank_balances", "SELECT * FROM rd r CROSS JOIN (VALUES ('t0'), ('t1')) AS c(cut) JOIN bank_balances b "
             "ON b.fecha_movimiento = CASE c.cut WHEN 't0' THEN r.bank_t0 ELSE r.bank_t1 END",
             f"NOT COALESCE({_GROUPED}, FALSE)", "saldo_bancario_final IS NULL")}
      UNION ALL {_lost("money_market", "SELECT r.report_date, m.*, EXISTS (SELECT 1 FROM unity_operations o WHERE o.consecutivo = m.consecutivo "
             "AND o.fecha_cuadre = r.report_date) AS is_known FROM rd r JOIN money_market m ON m.fecha_cumplimiento = r.report_date "
             "WHERE m.tipo_operacion IN ('C', 'V')", "NOT is_known", "valor_de_giro IS NULL")}
      UNION ALL {_lost("cc_movements", "SELECT * FROM named",
             "concepto IS NULL OR starts_with(concepto, 'Falta Homologación: ')", "valor IS NULL")}
      UNION ALL {_lost("multicash", "SELECT r.report_date, m.*, EXISTS (SELECT 1 FROM umbrella u WHERE u.titular = 'HOLDER SA' "
             "AND u.estado = 'ACTIVA' AND regexp_replace(u.cuenta_bancaria, '^0+', '') = m.cuenta_bancaria) AS is_own "
             "FROM rd r JOIN multicash m ON m.fecha_mvto BETWEEN r.tx_from AND r.tx_to "
             "WHERE NOT m.cuenta_bancaria IN ('62015991', '62015990', '64011480')", "NOT is_own", "monto IS NULL OR moneda IS NULL")}
      UNION ALL {_lost("transactions", "SELECT r.report_date, t.*, c.clave_codificada AS channel, EXISTS (SELECT 1 FROM accounts a "
             "WHERE a.clave_codificada = t.clave_cuenta_padre) AS is_known FROM rd r JOIN transactions t ON t.fecha_valor = r.report_date "
             "LEFT JOIN channels c ON c.clave_codificada = t.clave_canal", "channel IS NULL OR NOT is_known",
             "monto IS NULL OR fecha_hora_valor IS NULL")}
      UNION ALL {_lost("balance", "SELECT r.report_date, b.*, EXISTS (SELECT 1 FROM deposit_account d WHERE d.id_producto IN ('P1', 'P2', 'P3') "
             "AND d.id_cuenta_deposito = b.id_cuenta) AS is_known FROM rd r JOIN balance b ON b.fecha_saldo IN (r.report_date, r.prev_bd)",
             "NOT is_known", "total_balance IS NULL")}
      UNION ALL {_lost("renewals", "SELECT * FROM rd r JOIN renewals n ON n.fecha_operacion = r.report_date", "FALSE", "total_renovacion IS NULL")}
      UNION ALL {_lost("derivatives", "SELECT * FROM rd r JOIN derivatives v ON v.fecha_inicial = r.prev_bd "
             "WHERE v.descripcion = 'HOLDER SA' AND v.tipo_cumplimiento = 'F'", "FALSE", "utilidad IS NULL")}
      UNION ALL
      SELECT x.report_date, 'adapter', x.n, COALESCE(y.n, 0), x.bad FROM (
        SELECT report_date, COUNT(*) AS n, COUNT(*) FILTER (COALESCE(({_OUT}) OR transaction_type = '_ach_dev_enviada', FALSE)
          AND (amount IS NULL OR (({_OUT}) AND cycle IS NULL))) AS bad FROM refund_rows GROUP BY report_date) x
      LEFT JOIN (
        SELECT o.report_date, SUM(o.n - LEAST(o.n, COALESCE(s.n, 0))) AS n
        FROM out_groups o LEFT JOIN sent_groups s ON {_SAME_KEYS} WHERE {_ALL_KEYS} GROUP BY o.report_date) y
      ON y.report_date = x.report_date),
    every AS (
      SELECT report_date, unnest(['bank_balances', 'money_market', 'cc_movements', 'multicash', 'transactions', 'balance', 'adapter',
        'renewals', 'derivatives']) AS source FROM rd)
    SELECT e.report_date, e.source, COALESCE(CAST(rows_read AS BIGINT), 0) AS rows_read,
      COALESCE(CAST(unmatched AS BIGINT), 0) AS unmatched, COALESCE(CAST(malformed AS BIGINT), 0) AS malformed
    FROM every e LEFT JOIN lost l ON l.report_date = e.report_date AND l.source = e.source
"""

ORACLES: dict[str, str] = {
    "business_calendar": _query(
        f"""WITH {_calendar(1993, 2003)}
        SELECT cal.d AS day, a.n_rows, bd AS is_bd, settle AS is_bd_settle, prev_bd, next_bd,
          isodow(cal.d) = 5 OR month(CAST(cal.d + 1 AS DATE)) <> month(cal.d) AS is_fri_or_eom
        FROM (SELECT CAST(fecha_ultima_modificacion AS DATE) AS d, COUNT(*) AS n_rows FROM accounts GROUP BY 1) a
        JOIN cal ON cal.d = a.d""",
        "accounts",
        rd=None,
    ),
    "business_window": _query(
        f"""WITH {_calendar(2023, 2024)}, {_MOVE_DAYS},
        earlier AS (
          SELECT a.report_date AS anchor, c.d, ROW_NUMBER() OVER (PARTITION BY a.report_date ORDER BY c.d DESC) AS back
          FROM anchors a JOIN cal c ON c.bd AND c.d < a.report_date)
        SELECT e.anchor, a.n_rows, CAST(4 - back AS INTEGER) AS seq, e.d AS report_date
        FROM earlier e JOIN anchors a ON a.report_date = e.anchor WHERE back <= 4
        UNION ALL SELECT report_date, n_rows, 4, report_date FROM anchors""",
        "cc_movements",
        rd=None,
    ),
    "report_dates": _query(
        f"""WITH {_calendar(2023, 2024)}, {_MOVE_DAYS}
        SELECT a.report_date, a.n_rows, prev_bd, next_bd, {_bank_date('a.report_date', 'prev_bd')} AS bank_t0,
          {_bank_date('next_bd', 'a.report_date')} AS bank_t1,
          CASE WHEN settle THEN CAST(prev_s + 1 AS DATE) ELSE a.report_date END AS unity_from, a.report_date AS unity_to,
          a.report_date AS tx_from, CASE WHEN settle THEN CAST(next_s - 1 AS DATE) ELSE a.report_date END AS tx_to
        FROM anchors a JOIN cal ON cal.d = a.report_date""",
        "cc_movements",
        rd=None,
    ),
    "bank_dates": _query(
        f"""WITH {_calendar(2019, 2027)}, anchors AS (
          SELECT CAST(CAST(fecha_ultima_modificacion AS DATE) + INTERVAL 25 YEAR AS DATE) AS report_date, COUNT(*) AS n_rows
          FROM accounts GROUP BY 1)
        SELECT a.report_date, n_rows, {_bank_date('a.report_date', 'prev_bd')} AS bank_t0,
          {_bank_date('next_bd', 'a.report_date')} AS bank_t1
        FROM anchors a JOIN cal ON cal.d = a.report_date""",
        "accounts",
        rd=None,
    ),
    "parse_report_dates": _query(
        "SELECT CAST(fecha_hora_valor AS DATE) AS report_date, COUNT(*) AS n_rows FROM transactions GROUP BY 1",
        "transactions",
        rd=None,
    ),
    "date_bridge": _query(
        f"""WITH {AGREED.strip()}, bridge AS (
          SELECT report_date, 'report' AS cut, report_date AS source_date FROM rd
          UNION ALL SELECT report_date, 'previous', prev_bd FROM rd
          UNION ALL SELECT report_date, 'bank_t0', bank_t0 FROM rd
          UNION ALL SELECT report_date, 'bank_t1', bank_t1 FROM rd
          UNION ALL SELECT report_date, 'movements', CAST(unnest(generate_series(unity_from, unity_to, INTERVAL 1 DAY)) AS DATE) FROM rd
          UNION ALL SELECT report_date, 'statements', CAST(unnest(generate_series(tx_from, tx_to, INTERVAL 1 DAY)) AS DATE) FROM rd
          UNION ALL SELECT report_date, 'agreed', source_date FROM agreed)
        SELECT report_date, cut, source_date, (SELECT COUNT(*) FROM cc_movements WHERE fecha = source_date) AS n_rows
        FROM bridge""",
        "cc_movements",
    ),
    "scan_bank_balances": _query(
        f"""SELECT r.report_date, c.cut, COUNT(*) AS n_rows, {out(f"SUM({d('saldo_bancario_final')})")} AS total
        FROM rd r CROSS JOIN (VALUES ('t0'), ('t1')) AS c(cut)
        JOIN bank_balances b ON b.fecha_movimiento = CASE c.cut WHEN 't0' THEN r.bank_t0 ELSE r.bank_t1 END GROUP BY 1, 2""",
        "bank_balances",
    ),
    "scan_money_market": _query(
        f"WITH {TRADES} SELECT fecha_cuadre, COUNT(*) AS n_rows, {out(f'SUM({d("valor_de_giro")})')} AS total "
        "FROM trades GROUP BY 1",
        "money_market",
        "unity_operations",
    ),
    "scan_unity_movements": _query(
        f"WITH {MOVES} SELECT report_date, COUNT(*) AS n_rows, {out(f'SUM({d("valor")})')} AS total FROM moves GROUP BY 1",
        "cc_movements",
        "unity_operations",
        "homologation",
    ),
    "scan_bank_transactions": _query(
        f"WITH {STATEMENT} SELECT report_date, COUNT(*) AS n_rows, {out('SUM(monto)')} AS total FROM bank_rows GROUP BY 1",
        "multicash",
        "umbrella",
    ),
    "trm_validity_join": _query(f"WITH {RATES} SELECT report_date, {outs('rate_t0', 'rate_t1')} FROM rates", "trm"),
    "scan_repurchases": _query(
        f"WITH {PAPERS} SELECT report_date, kind, tipo_participacion, COUNT(*) AS n_rows, {out('SUM(price)')} AS total_price, "
        f"{out('SUM(saldo)')} AS total_balance FROM papers GROUP BY 1, 2, 3",
        "operations_a",
        "operations_b",
    ),
    "scan_money_market_rows": _query(f"WITH {TRADES} SELECT * FROM trades", "money_market", "unity_operations"),
    "scan_unity_movements_rows": _query(f"WITH {MOVE_ROWS} SELECT * FROM move_rows", "cc_movements", "unity_operations"),
    "process_concept": _query(f"WITH {CONCEPT_ROWS} SELECT * FROM concept_rows", "cc_movements", "unity_operations"),
    "process_value": _query(f"WITH {VALUE_ROWS}", "cc_movements", "unity_operations", "homologation"),
    "scan_bank_transactions_rows": _query(
        """SELECT r.report_date, m.cuenta_bancaria, m.moneda, m.monto, m.fecha_mvto
        FROM rd r JOIN multicash m ON m.fecha_mvto BETWEEN r.tx_from AND r.tx_to
        JOIN umbrella c ON m.cuenta_bancaria = regexp_replace(c.cuenta_bancaria, '^0+', '')
        WHERE c.titular = 'HOLDER SA' AND c.estado = 'ACTIVA'""",
        "multicash",
        "umbrella",
    ),
    "scan_channel_transactions_rows": _query(
        f"""WITH {LATEST}
        SELECT r.report_date, t.clave_cuenta_padre, t.monto, t.fecha_valor, c.nombre AS canal, a.id,
          strftime(t.fecha_hora_valor, '%H:%M:%S') AS hora
        FROM rd r JOIN transactions t ON t.fecha_valor = r.report_date
        JOIN latest a ON t.clave_cuenta_padre = a.clave_codificada JOIN channels c ON t.clave_canal = c.clave_codificada""",
        "transactions",
        "accounts",
        "channels",
    ),
    "scan_repurchases_rows": _query(
        f"""WITH {AGREED.strip()}
        SELECT r.report_date, a.*, CASE WHEN a.codigo_isin LIKE 'COB70CD%' THEN 'cdt' ELSE 'bonds' END AS kind,
          b.saldo, b.tipo_participacion, b.nombre_inversion
        FROM rd r JOIN operations_a a ON a.fecha_inicio = r.report_date JOIN operations_b b ON a.id = b.id_padre
        WHERE (a.codigo_isin LIKE 'COB70CD%' OR a.codigo_isin LIKE 'COB70CB%') AND b.tipo_participacion IN (1, 2)
          AND b.nombre_inversion = 'HOLDER S.A'
          AND EXISTS (SELECT 1 FROM agreed g WHERE g.report_date = r.report_date AND g.source_date = a.fecha_operacion)""",
        "operations_a",
        "operations_b",
    ),
    "latest_account_version": _query(f"WITH {LATEST} SELECT clave_codificada, id, version FROM latest", "accounts", rd=None),
    "latest_account_maintained": _query(f"WITH {LATEST} SELECT clave_codificada, id, version FROM latest", "accounts", rd=None),
    "scan_channel_transactions": _query(
        f"WITH {TX} SELECT report_date, canal, COUNT(*) AS n_rows, {out('SUM(monto)')} AS total FROM tx GROUP BY 1, 2",
        "transactions",
        "accounts",
        "channels",
    ),
    "deposit_balance_by_date": _query(
        f"WITH {DEPOSITS} SELECT fecha_saldo, {outs('total_balance')} FROM deposit", "balance", "deposit_account"
    ),
    "scan_adapter": _query(
        f"WITH {REFUND_ROWS} SELECT report_date, which_day, COUNT(*) AS n_rows FROM refund_rows GROUP BY 1, 2", "adapter"
    ),
    "adapter_latest_date": _query("SELECT MAX(fecha_consulta) AS latest FROM adapter", "adapter", rd=None),
    "adapter_latest_partition": _query("SELECT MAX(fecha_consulta) AS latest FROM adapter", "adapter", rd=None),
    "bank_account_balances": _query(
        f"WITH {BALANCES} SELECT report_date, cut, {outs(*CENTRAL, *COMMERCIAL, *USD)} FROM balances", "bank_balances"
    ),
    "available_funds_t0": _available("t0"),
    "available_funds_t1": _available("t1"),
    "available_union": _query(f"WITH {BALANCES}, {RATES}, {AVAILABLE} {_UNION}", "bank_balances", "trm"),
    "available_by_institution": _BY_INSTITUTION,
    "money_market_settlement": _query(
        f"WITH {TRADES}, {MM} SELECT report_date, "
        + ", ".join(f"{out(('-' if n in _NEGATIVE else '') + 'mm_' + n)} AS {n}" for n in _SETTLING)
        + " FROM mm",
        "money_market",
        "unity_operations",
    ),
    "money_market_same_day": _query(
        f"WITH {TRADES}, {SD} SELECT report_date, "
        + ", ".join(f"{out('sd_' + n)} AS {n}" for n in _SAME_DAY)
        + " FROM sd",
        "money_market",
        "unity_operations",
    ),
    "concept_codes": _query(
        f"WITH {MOVES}, names AS (SELECT codigo_contable, COUNT(DISTINCT concepto_cud) AS n FROM homologation GROUP BY 1) "
        "SELECT DISTINCT report_date, code, COALESCE(n, 0) AS n_names FROM moves LEFT JOIN names ON code = codigo_contable "
        "WHERE code IS NOT NULL",
        "cc_movements",
        "unity_operations",
        "homologation",
    ),
    "concept_derivation": _query(
        f"WITH {MOVES} SELECT report_date, code AS concepto, COUNT(*) AS n_rows, {out(f'SUM({d("valor")})')} AS total "
        "FROM moves GROUP BY 1, 2",
        "cc_movements",
        "unity_operations",
        "homologation",
    ),
    "concept_homologation": _query(
        f"WITH {MOVES} SELECT report_date, concepto, COUNT(*) AS n_rows, {out('SUM(valor)')} AS total FROM named GROUP BY 1, 2",
        "cc_movements",
        "unity_operations",
        "homologation",
    ),
    "unmapped_concepts": _query(
        f"WITH {MOVES} SELECT concepto, COUNT(*) AS n_rows FROM named WHERE concepto LIKE 'Falta Homologación: %' GROUP BY 1",
        "cc_movements",
        "unity_operations",
        "homologation",
    ),
    "unity_totals": _query(
        f"WITH {MOVES}, {UNITY} SELECT report_date, {outs(*_UNITY, 'breb_in', 'breb_out')} FROM unity",
        "cc_movements",
        "unity_operations",
        "homologation",
    ),
    "cdt_renewals": _query(
        f"WITH {SECURITIES} SELECT report_date, {outs('renewals')} FROM renewed", "renewals", "derivatives"
    ),
    "issuance_repurchase": _query(
        f"WITH {PAPERS} SELECT report_date, {out('repurchases_paid')} AS repurchases, {outs('cdt_issuances', 'bond_issuances')} "
        "FROM issued",
        "operations_a",
        "operations_b",
    ),
    "derivatives_pnl": _query(f"WITH {SECURITIES} SELECT report_date, {outs('pnl')} FROM profit", "renewals", "derivatives"),
    "ach_time_slots": _query(
        f"WITH {TX}, {CHANNELS} SELECT report_date, {outs(*_SLOTS)} FROM chan", "transactions", "accounts", "channels"
    ),
    "sebra_transfer_totals": _query(
        f"WITH {TX}, {CHANNELS} SELECT report_date, {outs(*_TRANSFERS)} FROM chan", "transactions", "accounts", "channels"
    ),
    "account_variation": _query(
        f"WITH {DEPOSITS} SELECT report_date, {outs('account_variation')} FROM variation", "balance", "deposit_account"
    ),
    "ach_refund_parse": _query(
        f"""SELECT fecha_consulta, cycle, COUNT(*) AS n_rows, COUNT(amount) AS n_amounts, {out('SUM(amount)')} AS total
        FROM (SELECT {_ADAPTER_ROWS} FROM adapter a WHERE fecha_consulta IN (SELECT report_date FROM rd)
              OR fecha_consulta IN (SELECT prev_bd FROM rd)) GROUP BY 1, 2""",
        "adapter",
    ),
    "ach_matched_refunds": _query(
        f"WITH {REFUND_ROWS}, {MATCHED} SELECT report_date, which_day, {outs('matched')} FROM matched", "adapter"
    ),
    "ach_refunds": _query(
        f"WITH {REFUND_ROWS}, {MATCHED}, {REFUNDS} SELECT report_date, "
        + outs(*[f"cud_{i}" for i in range(1, 6)], *[f"send_{i}" for i in range(5)])
        + " FROM refunds",
        "adapter",
    ),
    "credit_confirming": _query(
        f"WITH {TX}, {CHANNELS} SELECT report_date, {outs('credit_income')}, {out(_CREDIT_OUT)} AS credit_outcome, "
        f"{outs('confirming_income')}, {out('-confirming_negative')} AS confirming_outcome FROM chan",
        "transactions",
        "accounts",
        "channels",
    ),
    "credit_adaptor_outcome": _query(
        f"WITH {REFUND_ROWS}, {MATCHED}, {REFUNDS} SELECT report_date, {out('adaptor')} AS credit_adaptor_outcome FROM refunds",
        "adapter",
    ),
    "uncounted_rows": _query(
        f"WITH {UNCOUNTED}",
        "bank_balances", "money_market", "unity_operations", "cc_movements", "homologation", "multicash", "umbrella",
        "transactions", "channels", "accounts", "balance", "deposit_account", "adapter", "renewals", "derivatives",
    ),
    "sebra_net_movements": _query(
        f"WITH {MOVES}, {TX}, {NET} SELECT report_date, {outs('sebra_in', 'sebra_out')} FROM net",
        "cc_movements",
        "unity_operations",
        "homologation",
        "transactions",
        "accounts",
        "channels",
    ),
    "bank_transaction_totals": _query(
        f"WITH {STATEMENT} SELECT report_date, {outs('cop_in', 'cop_out', 'usd_in', 'usd_out')} FROM bt",
        "multicash",
        "umbrella",
    ),
    "daily_inputs": _whole(_inputs()),
    "daily_inputs_as_of": _whole(_inputs("2024-01-12")),
    "ach_net_flow": _whole(
        f"SELECT report_date, {outs('dollar_comp', 'income_ach', 'outcome_ach')}, {out(EXPENSE['045_retiros_ach'])} AS retiros_ach FROM m"
    ),
    "fx_variation": _whole(
        f"SELECT report_date, {outs('usd_income', 'usd_outcome')}, {out('z_usd - o_usd')} AS dollar_variation, "
        f"{outs('change_variation')} FROM m"
    ),
    "income_statement": _whole(
        "SELECT " + ", ".join(f"{out(f'{chr(34)}i_{n}{chr(34)}')} AS \"{n}\"" for n in INCOME)
        + f", {out('income_total')} AS total, report_date AS fecha_reporte FROM stated"
    ),
    "expense_statement": _whole(
        "SELECT " + ", ".join(f"{out(f'{chr(34)}e_{n}{chr(34)}')} AS \"{n}\"" for n in EXPENSE)
        + f", {out('expense_total')} AS total, report_date AS fecha_reporte FROM stated"
    ),
    "cash_summary": _whole(_SUMMARY),
    "cash_summary_backfill": _whole(_SUMMARY, rd=RD_MONTH),
    "cash_summary_incremental": _whole(_SUMMARY, rd=RD_MONTH),
    "condensed_report": _condensed(),
    "report_transpose": _whole(_transposed()),
    "schema_sync_union": _query(
        f"WITH {BALANCES}, {RATES}, {AVAILABLE}, unioned AS ({_UNION}) SELECT * REPLACE "
        "(CASE WHEN tipo_disponible = 'disponible_t-1' THEN tipo_disponible END AS tipo_disponible) FROM unioned",
        "bank_balances",
        "trm",
    ),
    "upsert_merge_result": _MERGE_SQL,
    "upsert_partitioned": _MERGE_SQL,
}
