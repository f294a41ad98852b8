"""Business parameters of the report.

Everything an institution would configure lives here: account groups, concept
lists, channel names, time slots, statement line names. All of them are fixed
values: texts and numbers that the sources contain or the report's readers expect.
"""

from __future__ import annotations

from datetime import date

# Holder, accounts, products
HOLDER = "HOLDER SA"
INVESTMENT_HOLDER = "HOLDER S.A"
ACTIVE = "ACTIVA"
DEPOSIT_PRODUCTS = ["P1", "P2", "P3"]
DERIVATIVE_SETTLEMENT = "F"

# Before this date the bank balance of the calendar day before is used.
BANK_CUTOVER = date(2026, 3, 13)

CENTRAL_BANK_ACCOUNTS = {
    "banrep_norem90": ["62015990"],
    "banrep_norem91": ["62015991"],
    "banrep_rem": ["64011480"],
}
COMMERCIAL_ACCOUNTS = {
    "savings_dav": ["570033570004227"],
    "savings_occ": ["423816990"],
    "savings_bog": ["434381323"],
    "savings_banc": ["61100001577"],
    "adm_dav": ["560033569994602", "560033569994594"],
    "adm_bog": ["434394037", "434394045"],
    "adm_banc": ["61100001064", "61100001065", "61100001369", "61100001576"],
}
USD_ACCOUNTS = {
    "usd_cayman": ["86110"],
    "usd_bofa": ["1901751916"],
    "usd_citi": ["14674340"],
    "usd_citi_usd": ["36442812"],
    "usd_citi2": ["36506441"],
    "usd_panama": ["80110003748"],
    "usd_bradesco": ["30863139"],
}
STATEMENT_EXCLUDED_ACCOUNTS = ["62015991", "62015990", "64011480"]

# Money market
DEPOSITORIES = ["DCV", "DVL"]
GOVERNMENT_SPECIES = "CT"
PRIVATE_SPECIES = "CA|CB|CD|CH|CI|CP|CS|MM"
DOLLAR_NEMO = "MONEYMARKET"
TRADED_SIDES = ["C", "V"]

# Securities
CERTIFICATE_ISIN = "COB70CD"
BOND_ISIN = "COB70CB"
REPURCHASE_PARTICIPATION = 1
ISSUANCE_PARTICIPATION = 2

# Accounting codes given to movements that arrive without a concept.
CODE_NORMAL_SB = "44206"
CODE_NORMAL_OTHER = "43422"
CODE_NORMAL_OF = "43420"
CODE_SIM_SELL_SPOT = "45495"
CODE_SIM_SELL_FUTURE = "45435"
CODE_SIM_BUY_SPOT = "44495"
CODE_SIM_BUY_FUTURE = "44435"
CODE_TTV = "44211"
CODE_REPO_BUY = "44481"
CODE_REPO_SELL = "45431"

# Concept names
YIELD_CONCEPT = "PAGO RENDIMIENTOS"
FX_CONCEPT = "DIVISAS SEBRA"
OTC_CONCEPT = "DERIVADOS OTC"
PAID_INTEREST_CONCEPT = "INTERESES REMUNERADO"
NAMED_CODES = {
    "310": FX_CONCEPT,
    "389": OTC_CONCEPT,
    "366": OTC_CONCEPT,
    "362": PAID_INTEREST_CONCEPT,
}
UNMAPPED_PREFIX = "Falta Homologación: "
DEBIT_NOTE = "ND"
REPURCHASE_CONCEPT = "OPERACIONES DVP DECEVAL"
ISSUER_PAYMENT_CONCEPT = "APR.PAGOS DE EMISORES S/ TÍTULOS VA"
GMF_CONCEPT = "G.M.F. SOBRE LA TRANSACCIÓN"
CREDIT_INTEREST_CONCEPT = "A.PAGOS POR CAP. E INTERESES SOBRE CRÉDI"
THIRD_PARTY_CONCEPT = "APR ENTR CTA DEPÓS DIFER TITULAR-TERCERO"
OTHER_CONCEPTS = [
    "APR. OP CON DECEVAL RECURSOS PROPIOS",
    "APR. OP CON DCV RECURSOS PROPIOS",
    "AP.ENTRE CUENTAS DE DEP. DE LA MISMA ENT",
    "TRANSFERENCIA DE FONDOS PARA OPERAC",
    "APR. ENTRE CTAS DEPÓS. DIFERENTE TI",
    "APR OP ESPEC MERC SECUN RENTA VARIA",
    "APR.CONSTITUCION INTERBANCARIOS INT",
    "APR. OP CON TÍTULOS DEPOSITADOS EN DCV",
    "TRANSFERENCIA DE FONDOS PARA OPERACIONES FICS - BANCO COMERCIAL Y CUSTODIO",
    "APR.CONSTITUCION INTERBANCARIOS INTRADIA",
    "A.DESEMBOLSOS DE CREDITO - ESTABLECIMIEN",
    "APR OP ESPEC MERC SECUN RENTA VARIAB BVC",
]
CLEARING_EXPENSE_CONCEPTS = [
    "DB TARIFA TRANSACCIONAL CUD",
    "AP. SERVICIOS CRCC - PD",
    "DB IVA",
    "DB PAGO DE TARIFAS DCV",
    "DB TARIFA ADMINISTRACION DE CUENTAS",
    "DB TARIFA PUNTOS S.E.B.R.A",
    "DB TARIFAS SEN",
]
OTHER_OPERATION_CONCEPTS = [
    "AP. CONSTITUCION GARANTIA POR POSIC",
    "AP. DEVOLUCION GARANTIA EXTRAORDINA",
    "AP. CONSTITUCION GARANTIA EXTRAORDI",
    "AP. DEVOLUCION GARANTIA POR POSICIO",
    "AP. LIQUIDACION DIARIA OPERACIONES",
    "INTERESES REMUNERADO",
]

# Payment channels
ACH_WITHDRAWAL = "RETIRO ACH"
ACH_DEPOSIT = "DEPOSITO ACH"
ACH_RETURN = "DEVOLUCION RETIRO ACH"
TRANSFER_DEBIT = "TRASLADO FONDOS SEBRA DEBITO"
TRANSFER_CREDIT = "TRASLADO FONDOS SEBRA CREDITO"
TRANSFER_DEBIT_RETURN = "DEVOLUCION TRASLADO FONDOS SEBRA DEBITO"
TRANSFER_CREDIT_RETURN = "DEVOLUCION TRASLADO FONDOS SEBRA CREDITO"
TRANSFER_CHANNELS = [TRANSFER_DEBIT, TRANSFER_CREDIT, TRANSFER_DEBIT_RETURN, TRANSFER_CREDIT_RETURN]
CROSS_DEPOSIT = "DEPOSITO CROS"
EXCLUDED_CHANNELS = [
    "RECARGA SALDO PARA OPERACIONES DE CRED/CONF",
    "DESCARGA SALDOS RECAUDOS CREDITOS",
]
CREDIT_ACCOUNT = "12528874205"
CONFIRMING_ACCOUNT = "12561730308"
# Inclusive time-of-day bounds.
WITHDRAWAL_SLOTS = [
    ("00:00:00", "08:31:00"),
    ("08:31:01", "11:01:00"),
    ("11:01:01", "13:31:00"),
    ("13:31:01", "15:34:00"),
    ("15:34:01", "23:59:59"),
]
DEPOSIT_SLOTS = [
    ("00:00:00", "10:30:00"),
    ("10:30:01", "13:00:00"),
    ("13:00:01", "15:30:00"),
    ("15:30:01", "17:30:00"),
    ("17:30:01", "23:59:59"),
]

# Refund adapter
UNAUTHORIZED = "unauthorized"
OUT_SUFFIX = "OUT"
SENT_REFUND = "_ach_dev_enviada"
LATE_CYCLE = 4
CYCLES = 5
ORIGINATOR_ACCOUNT = "62015991"

# Report
AVAILABLE_T0 = "disponible_t-0"
AVAILABLE_T1 = "disponible_t-1"
SECTION_INCOME = "INGRESOS"
SECTION_EXPENSE = "EGRESOS"
SECTION_T0 = "DISPONIBLE T-0"
SECTION_T1 = "DISPONIBLE T-1"
SECTION_SUMMARY = "RESUMEN DISPONIBLE"
PERCENTAGE_COLUMN = "porcentaje_diferencia"
PARTITION_KEYS = ["fecha_reporte"]
MERGE_KEYS = ["fecha_reporte"]
MERGE_KEYS_AVAILABLE = ["fecha_reporte", "tipo_disponible"]

AVAILABLE_COLUMNS = ["banco_republica", "bancos_comerciales", "bancos_usd", "trm", "total"]
SUMMARY_COLUMNS = ["variacion_disponible", "total_flujo", "diferencia", "porcentaje_diferencia"]
INCOME_LINES = [
    "005_credito",
    "005_confirming",
    "010_definitivas_tes",
    "010_definitivas_privada",
    "010_intereses_titulos",
    "015_simultaneas_activas_tes_regreso",
    "015_simultaneas_activas_privada_regreso",
    "015_repos_activos_regreso",
    "020_simultaneas_pasivas_tes_salida",
    "020_simultaneas_pasivas_privada_salida",
    "020_repos_pasivos_salida",
    "020_ttv_ingreso",
    "025_variacion_cuenta_corriente",
    "035_renovacion_cdt",
    "040_captacion_cdt",
    "045_derivados_estandarizados",
    "045_derivados_otc",
    "050_colocacion_bonos",
    "055_creditos_bancos",
    "060_ingresos_ach",
    "060_multicash_cop",
    "060_multicash_usd",
    "060_compensacion_dolar",
    "060_divisas_sebra",
    "060_otros_ingresos",
]
EXPENSE_LINES = [
    "005_simultaneas_pasivas_tes_regreso",
    "005_simultaneas_pasivas_privada_regreso",
    "005_repos_pasivos_regreso",
    "005_ttv_egreso",
    "010_simultaneas_activas_tes_salida",
    "010_simultaneas_activas_privada_salida",
    "010_repos_activos_salida",
    "015_vencimiento_capital_cdt",
    "015_vencimiento_rendimientos_cdt",
    "015_recompras",
    "020_vencimiento_derivados_estandarizados",
    "020_vencimiento_derivados_otc",
    "025_vencimiento_capital_bonos",
    "025_vencimiento_rendimientos_bonos",
    "030_desembolso_credito",
    "030_confirming",
    "035_compra_inversiones_tes",
    "035_compra_inversiones_privada",
    "040_creditos_bancos",
    "045_retiros_ach",
    "045_gmf",
    "045_multicash_cop",
    "045_multicash_usd",
    "045_compensacion_dolar",
    "045_gastos_sebra",
    "045_divisas_sebra",
    "045_otros_egresos",
]

# Lines of the statements in order: SQL over the metrics and the values derived from them.
INCOME_STATEMENT = dict(
    zip(
        INCOME_LINES,
        [
            "credit_income",
            "confirming_income",
            "mm_sell_tes + sd_sell_tes",
            "mm_sell_priv + sd_sell_priv",
            "yields",
            "mm_sim_tes_active",
            "mm_sim_priv_active",
            "mm_repo_active + sd_repo_active_sell",
            "sd_sim_tes_passive",
            "sd_sim_priv_passive",
            "sd_repo_passive_sell",
            "mm_ttv_sell + sd_ttv_sell",
            "account_variation",
            "renewals",
            "cdt_issued",
            "GREATEST(pnl, 0)",
            "otc_in",
            "bonds_issued",
            "0",
            "income_ach",
            "cop_in + instant_income",
            "usd_income",
            "dollar_comp",
            "sebra_fx_in",
            "other_in + other_ops_in + third_in + LEAST(change_variation, 0)",
        ],
        strict=True,
    )
)
# Movement expenses are negative metrics, market metrics are unsigned.
EXPENSE_STATEMENT = dict(
    zip(
        EXPENSE_LINES,
        [
            "ABS(mm_sim_tes_passive)",
            "ABS(mm_sim_priv_passive)",
            "ABS(mm_repo_passive) + sd_repo_passive_buy",
            "ABS(mm_ttv_buy) + sd_ttv_buy",
            "sd_sim_tes_active",
            "sd_sim_priv_active",
            "sd_repo_active_buy",
            "ABS(renewals - due_cdt)",
            "0",
            "ABS(repurchases)",
            "ABS(LEAST(pnl, 0))",
            "-otc_out",
            "0",
            "0",
            "ABS(credit_outcome) + ABS(adaptor)",
            "ABS(confirming_negative)",
            "ABS(mm_buy_tes) + sd_buy_tes",
            "ABS(mm_buy_priv) + sd_buy_priv",
            "ABS(pay_findeter)",
            "CASE WHEN income_ach >= 0 THEN ABS(outcome_ach) ELSE outcome_ach + ABS(income_ach) END",
            "ABS(gmf)",
            "ABS(cop_out) + instant_expense",
            "usd_outcome",
            "ABS(LEAST(dollar_comp, 0))",
            "ABS(expense_sebra)",
            "ABS(sebra_fx_out)",
            "ABS(third_out - other_out - other_ops_out) + GREATEST(change_variation, 0)",
        ],
        strict=True,
    )
)

# Instant-payment totals are not sourced yet; the statements carry them as zero.
INSTANT_PAYMENT_INCOME = 0
INSTANT_PAYMENT_EXPENSE = 0
