"""Column lists of the five raw tables and the types the cleaning layer gives them.

Everything in this module is a fixed value: a source system delivers exactly these
columns, as text. Nothing is inferred from the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"
PERCENT = "decimal(5,2)"
WHOLE = "int"
DAY = "date"
TEXT = "string"
FLAG = "boolean"

# --- fixed values: loans, one row per (id_credito, fecha_corte) -------------------------
LOAN_TYPES: dict[str, str] = {
    "id_credito": TEXT, "id_cliente": TEXT, "tipo_persona": TEXT, "segmento": TEXT,
    "zona_geografica": TEXT, "oficial_credito": TEXT,
    "producto_crediticio": TEXT, "moneda": TEXT,
    "fecha_desembolso": DAY, "fecha_vencimiento": DAY, "fecha_corte": DAY,
    "plazo_meses": WHOLE,
    "monto_aprobado": MONEY, "monto_desembolsado": MONEY, "saldo_capital": MONEY,
    "saldo_interes_devengado": MONEY, "saldo_mora": MONEY, "saldo_total_exposicion": MONEY,
    "tasa_nominal_anual_pct": RATE, "tasa_efectiva_anual_pct": RATE,
    "spread_pct": RATE, "costo_fondos_pct": RATE,
    "numero_cuotas_vencidas": MONEY, "calificacion_sbs": TEXT,
    "tasa_provision_pct": MONEY, "provision_requerida": MONEY, "provision_constituida": MONEY,
    "tipo_garantia": TEXT, "valor_garantia": MONEY, "cobertura_garantia_ratio": MONEY,
    "ltv_loan_to_value": RATE, "ratio_cobertura_total": MONEY,
    "score_crediticio": MONEY, "pd_probabilidad_default": RATE,
    "lgd_loss_given_default": RATE, "el_expected_loss": MONEY,
    "dscr_cobertura_servicio_deuda": MONEY, "ratio_endeudamiento": RATE,
    "ratio_liquidez_corriente": RATE, "ingresos_anuales": MONEY, "cuota_mensual": MONEY,
    "numero_refinanciaciones": MONEY, "es_refinanciado": MONEY,
    "veces_pago_anticipado": MONEY, "numero_creditos_banco": MONEY,
    "numero_creditos_sistema": WHOLE, "antiguedad_cliente_meses": WHOLE,
    "edad_empresa_anos": MONEY, "en_castigo": MONEY, "monto_castigado": MONEY,
    "dias_atraso": WHOLE, "sector_economico": TEXT,
}

# --- fixed values: monthly income statement ---------------------------------------------
INCOME_AMOUNTS: list[str] = [
    "ing_intereses_cartera", "ing_intereses_inversiones", "ing_intereses_interbancarios",
    "ing_comisiones_ganadas", "ing_utilidades_financieras", "ing_servicios",
    "otros_ingresos", "total_ingresos",
    "gasto_intereses_depositos", "gasto_intereses_obligaciones",
    "gasto_comisiones_pagadas", "total_gastos_financieros",
    "margen_financiero_bruto", "gasto_provisiones_periodo", "margen_financiero_neto",
    "gasto_personal", "gasto_honorarios", "gasto_instalaciones", "gasto_publicidad",
    "gasto_sistemas_tecnologia", "gasto_depreciacion", "gasto_amortizacion",
    "otros_gastos_operativos", "total_gastos_operativos",
    "castigos_periodo", "recuperaciones_periodo", "otras_perdidas_operacionales",
    "otros_gastos", "resultado_antes_impuestos", "participacion_trabajadores_15pct",
    "impuesto_renta_25pct", "utilidad_neta",
]

# --- fixed values: monthly balance sheet ------------------------------------------------
BALANCE_AMOUNTS: list[str] = [
    "fondos_disponibles", "operaciones_interbancarias_activo", "inversiones",
    "cartera_bruta", "provisiones_acumuladas", "cartera_neta", "cuentas_por_cobrar",
    "bienes_realizables_adjudicados", "propiedades_y_equipos", "otros_activos",
    "total_activos",
    "depositos_vista", "depositos_ahorro", "depositos_plazo", "depositos_restringidos",
    "total_obligaciones_publico", "operaciones_interbancarias_pasivo",
    "obligaciones_financieras_bde_cfn", "cuentas_por_pagar", "otros_pasivos",
    "total_pasivos",
    "capital_social", "reserva_legal", "reserva_especial", "superavit_valuaciones",
    "utilidad_acumulada_ejercicio", "total_patrimonio",
    "activos_ponderados_riesgo", "indice_solvencia_pct", "indice_liquidez_pct",
    "aporte_cosede",
    "cartera_mora_t1", "tasa_mora_pct_t1", "provision_requerida_t1",
    "provision_constituida_t1", "cobertura_provision_pct_t1", "el_total_t1",
]

# --- fixed values: instalment payments, one row per id_pago -----------------------------
PAYMENT_TYPES: dict[str, str] = {
    "id_pago": TEXT, "id_credito": TEXT, "id_cliente": TEXT, "segmento": TEXT,
    "oficial_credito": TEXT, "zona_geografica": TEXT,
    "monto_interes_cuota": MONEY, "numero_cuota": WHOLE,
    "fecha_pago_real": DAY, "fecha_vencimiento_cuota": DAY,
    "cuota_pactada": MONEY, "monto_capital_cuota": MONEY, "monto_pagado": MONEY,
    "saldo_pendiente_cuota": MONEY, "dias_retraso_pago": WHOLE,
    "estado_pago": TEXT, "canal_pago": TEXT, "calificacion_al_pago": TEXT,
}

# --- fixed values: customers, one row per id_cliente ------------------------------------
CUSTOMER_TYPES: dict[str, str] = {
    "fecha_primer_credito": DAY, "fecha_ultimo_corte": DAY,
    "id_cliente": TEXT, "tipo_persona": TEXT, "segmento": TEXT, "sector_economico": TEXT,
    "zona_geografica": TEXT, "oficial_credito": TEXT,
    "edad_empresa_anos": MONEY, "antiguedad_cliente_meses": WHOLE,
    "num_creditos_activos": WHOLE, "num_creditos_sistema": WHOLE,
    "num_refinanciaciones": WHOLE, "calificacion_consolidada": TEXT,
    "score_crediticio": WHOLE, "max_dias_atraso": WHOLE, "tiene_credito_en_mora": FLAG,
    "saldo_total_deuda": MONEY, "saldo_mora_total": MONEY, "tasa_mora_cliente_pct": MONEY,
    "provision_total_cliente": MONEY, "el_total_cliente": MONEY,
    "tasa_nominal_promedio": RATE, "ingresos_anuales": MONEY,
}

RAW_COLUMNS: dict[str, list[str]] = {
    "loans": [*LOAN_TYPES, "flag_error"],
    "income": ["fecha_mes", "mes", "ano", *INCOME_AMOUNTS],
    "balance": ["fecha_mes", "mes", "ano", *BALANCE_AMOUNTS],
    "payments": [*PAYMENT_TYPES, "es_pago_anticipado"],
    "customers": [
        *CUSTOMER_TYPES, "tasa_endeudamiento_sistema_pct", "es_cliente_preferente",
        "flag_error",
    ],
}

# Declared types of the cells of each raw table, and the columns that name a row.
RAW_TYPES: dict[str, dict[str, str]] = {
    "loans": LOAN_TYPES,
    "income": {"fecha_mes": DAY, "mes": WHOLE, "ano": WHOLE, **{c: RATE for c in INCOME_AMOUNTS}},
    "balance": {"fecha_mes": DAY, "mes": WHOLE, "ano": WHOLE, **{c: MONEY for c in BALANCE_AMOUNTS}},
    "payments": {**PAYMENT_TYPES, "es_pago_anticipado": FLAG},
    "customers": CUSTOMER_TYPES,
}
RAW_KEYS = {
    "loans": ["id_credito", "fecha_corte"], "income": ["fecha_mes"], "balance": ["fecha_mes"],
    "payments": ["id_pago"], "customers": ["id_cliente"],
}

# --- fixed values: columns each audit profiles ------------------------------------------
LOAN_NUMERIC = [
    "plazo_meses", "monto_aprobado", "saldo_capital", "tasa_nominal_anual_pct",
    "score_crediticio", "pd_probabilidad_default", "lgd_loss_given_default",
    "el_expected_loss", "ingresos_anuales", "ratio_endeudamiento", "ltv_loan_to_value",
    "antiguedad_cliente_meses", "numero_creditos_sistema", "dias_atraso",
]
LOAN_REQUIRED = [
    "id_credito", "id_cliente", "monto_aprobado", "score_crediticio", "sector_economico",
]
INCOME_NUMERIC = [c for c in INCOME_AMOUNTS if c != "margen_financiero_neto"]
INCOME_SIGNED = [
    c for c in INCOME_NUMERIC
    if c not in {
        "gasto_depreciacion", "gasto_amortizacion", "otros_gastos_operativos",
        "otras_perdidas_operacionales", "otros_gastos",
        "participacion_trabajadores_15pct", "impuesto_renta_25pct",
    }
]
INCOME_REQUIRED = [
    "total_ingresos", "total_gastos_financieros", "total_gastos_operativos",
    "ing_intereses_cartera", "ing_comisiones_ganadas", "ing_servicios",
    "gasto_intereses_depositos", "gasto_provisiones_periodo", "gasto_personal",
    "margen_financiero_bruto", "resultado_antes_impuestos", "utilidad_neta",
]
BALANCE_NUMERIC = [c for c in BALANCE_AMOUNTS if c != "cartera_neta"]
BALANCE_SIGNED = [
    c for c in BALANCE_NUMERIC
    if c not in {
        "depositos_restringidos", "cuentas_por_pagar", "otros_pasivos",
        "reserva_especial", "superavit_valuaciones", "activos_ponderados_riesgo",
        "aporte_cosede", "tasa_mora_pct_t1", "provision_requerida_t1",
        "provision_constituida_t1", "cobertura_provision_pct_t1",
    }
]
BALANCE_REQUIRED = [
    "total_activos", "total_pasivos", "total_patrimonio", "cartera_bruta",
    "fondos_disponibles", "inversiones", "provisiones_acumuladas",
    "total_obligaciones_publico", "depositos_plazo", "capital_social",
    "utilidad_acumulada_ejercicio", "indice_solvencia_pct", "indice_liquidez_pct",
]
PAYMENT_NUMERIC = [
    "numero_cuota", "cuota_pactada", "monto_capital_cuota", "monto_interes_cuota",
    "monto_pagado", "saldo_pendiente_cuota", "dias_retraso_pago", "es_pago_anticipado",
]
PAYMENT_WHOLE = ["numero_cuota", "dias_retraso_pago", "es_pago_anticipado"]
PAYMENT_REQUIRED = [
    "id_pago", "id_credito", "segmento", "zona_geografica", "fecha_vencimiento_cuota",
    "fecha_pago_real", "cuota_pactada", "monto_capital_cuota", "monto_interes_cuota",
    "monto_pagado", "saldo_pendiente_cuota", "estado_pago", "canal_pago",
    "calificacion_al_pago",
]
CUSTOMER_NUMERIC = [
    "edad_empresa_anos", "antiguedad_cliente_meses", "num_creditos_activos",
    "num_creditos_sistema", "num_refinanciaciones", "score_crediticio",
    "max_dias_atraso", "tiene_credito_en_mora", "saldo_total_deuda", "saldo_mora_total",
    "tasa_mora_cliente_pct", "provision_total_cliente", "el_total_cliente",
    "tasa_nominal_promedio", "ingresos_anuales", "tasa_endeudamiento_sistema_pct",
    "es_cliente_preferente",
]
CUSTOMER_REQUIRED = [
    *CUSTOMER_TYPES, "tasa_endeudamiento_sistema_pct", "es_cliente_preferente",
]

# --- fixed values: catalogues -----------------------------------------------------------
SECTORS = [
    "Comercio", "Industria", "Servicios", "Construcción", "Agricultura", "Transporte",
    "Turismo", "Salud", "Exportación", "Pesca",
]
ZONES = [
    "Guayaquil", "Quito", "Cuenca", "Ambato", "Manta", "Portoviejo", "Machala", "Loja",
]
SECTOR_RULES: list[tuple[str, str]] = [
    ("agr", "Agricultura"), ("comercio", "Comercio"), ("const", "Construcción"),
    ("exp", "Exportación"), ("ind", "Industria"), ("pes", "Pesca"),
    ("serv", "Servicios"), ("trans", "Transporte"), ("turis", "Turismo"),
]
SECTOR_DEFAULT = "No Definido"
# (label, first day, last day); None means no upper bound
RATING_BANDS: list[tuple[str, int, int | None]] = [
    ("Normal", 0, 0), ("Potencial", 1, 15), ("Deficiente", 16, 45),
    ("Dudoso", 46, 90), ("Pérdida", 91, None),
]
# --- fixed values: components of the reported totals -------------------------------------
INCOME_PARTS = ["ing_intereses_cartera", "ing_intereses_inversiones", "ing_intereses_interbancarios",
                "ing_comisiones_ganadas", "ing_utilidades_financieras", "ing_servicios", "otros_ingresos"]
COST_PARTS = ["gasto_intereses_depositos", "gasto_intereses_obligaciones", "gasto_comisiones_pagadas"]
OPEX_PARTS = ["gasto_personal", "gasto_honorarios", "gasto_instalaciones", "gasto_publicidad",
              "gasto_sistemas_tecnologia", "gasto_depreciacion", "gasto_amortizacion",
              "otros_gastos_operativos"]
EQUITY_PARTS = ["capital_social", "reserva_legal", "reserva_especial", "superavit_valuaciones",
                "utilidad_acumulada_ejercicio"]
ASSET_PARTS = ["fondos_disponibles", "operaciones_interbancarias_activo", "inversiones", "cartera_bruta",
               "cuentas_por_cobrar", "bienes_realizables_adjudicados", "propiedades_y_equipos", "otros_activos"]
LIABILITY_PARTS = ["total_obligaciones_publico", "operaciones_interbancarias_pasivo",
                   "obligaciones_financieras_bde_cfn", "cuentas_por_pagar", "otros_pasivos"]
DEPOSIT_PARTS = ["depositos_vista", "depositos_ahorro", "depositos_plazo", "depositos_restringidos"]

PERFORMING = ["Normal", "Vigente"]
IN_ARREARS = ["Pérdida", "Deficiente", "Dudoso"]
POLICY_FLAGS = ["EXCLUIR_PROCESO_JUDICIAL", "EXCLUIR_CREDITO_EMPLEADO"]
EXCLUDED_DEBTS = ["251958.69", "3099540.33"]
CUSTOMER_KEYS = [
    "id_cliente", "tipo_persona", "sector_economico", "segmento", "zona_geografica",
    "oficial_credito",
]


def text_schema(table: str) -> T.StructType:
    """All-text schema of one raw table."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
