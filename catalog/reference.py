"""Reference SQL tables that queries build on: cleaned tables, dimensions, monthly series."""

from __future__ import annotations

from bankmart import schemas as S
from catalog.fixtures import FIXTURES
from catalog.shapes import d2, d4, day, whole

TABLES: dict[str, str] = dict(FIXTURES)

SECTOR = (
    "CASE WHEN lower(sector_economico) LIKE '%agr%' THEN 'Agricultura' WHEN lower(sector_economico) LIKE '%comercio%' THEN 'Comercio' "
    "WHEN lower(sector_economico) LIKE '%const%' THEN 'Construcción' WHEN lower(sector_economico) LIKE '%exp%' THEN 'Exportación' "
    "WHEN lower(sector_economico) LIKE '%ind%' THEN 'Industria' WHEN lower(sector_economico) LIKE '%pes%' THEN 'Pesca' "
    "WHEN lower(sector_economico) LIKE '%serv%' THEN 'Servicios' WHEN lower(sector_economico) LIKE '%trans%' THEN 'Transporte' "
    "WHEN lower(sector_economico) LIKE '%turis%' THEN 'Turismo' ELSE 'No Definido' END"
)


def typed(types: dict[str, str], skip=()) -> str:
    """Typed select list of a raw table."""
    kinds = {"int": "INT", "date": "DATE", "boolean": "BOOLEAN"}
    out = []
    for c, kind in types.items():
        if c in skip:
            continue
        if kind == "string":
            out.append(c)
        elif kind == "boolean":
            out.append(f"TRY_CAST({c} AS INT) <> 0 AS {c}")
        else:
            out.append(f"TRY_CAST({c} AS {kinds.get(kind, kind.upper())}) AS {c}")
    return ", ".join(out)


TABLES["first_income"] = (
    f"SELECT id_cliente, v FROM (SELECT id_cliente, {d2('ingresos_anuales')} AS v, row_number() OVER (PARTITION BY id_cliente "
    f"ORDER BY {day('fecha_corte')} ASC NULLS FIRST, id_credito) AS rn FROM {{loans}}) x WHERE rn = 1"
)
TABLES["roll"] = (
    f"SELECT id_cliente, {day('fecha_corte')} AS fecha_corte, sum({d2('provision_constituida')}) AS provisions, "
    f"sum({d2('el_expected_loss')}) AS expected_loss, sum({d2('saldo_total_exposicion')}) AS exposure, "
    f"sum({d2('ingresos_anuales')}) AS income, sum({d2('saldo_capital')} * {d4('tasa_nominal_anual_pct')}) / "
    f"nullif(sum({d2('saldo_capital')}), 0) AS weighted_rate, count(*) AS n_loans, max(calificacion_sbs) AS rating "
    "FROM {loans} GROUP BY 1, 2"
)
TABLES["ranked_roll"] = (
    "SELECT *, row_number() OVER (PARTITION BY id_cliente ORDER BY fecha_corte DESC) AS ranking, "
    "(year(fecha_corte) * 12 + month(fecha_corte)) - (year(low) * 12 + month(low)) AS tenure_months FROM "
    "(SELECT *, min(fecha_corte) OVER (PARTITION BY id_cliente) AS low FROM {roll}) r"
)
TABLES["last_roll"] = "SELECT * FROM {ranked_roll} WHERE ranking = 1"
TABLES["loan_instalment"] = (
    f"SELECT id_credito, c AS cuota_mensual FROM (SELECT id_credito, {d2('cuota_mensual')} AS c, row_number() OVER (PARTITION BY id_credito "
    f"ORDER BY {day('fecha_corte')} DESC, {d2('cuota_mensual')} DESC) AS rn FROM {{loans}}) x WHERE rn = 1"
)

TABLES["mart_credits"] = (
    f"SELECT {typed(S.LOAN_TYPES, ('dias_atraso', 'sector_economico'))}, "
    f"CASE WHEN {whole('dias_atraso')} < 0 THEN 0 ELSE {whole('dias_atraso')} END AS dias_atraso, {SECTOR} AS sector_economico "
    f"FROM {{loans}} WHERE {day('fecha_vencimiento')} > {day('fecha_desembolso')} AND (flag_error NOT IN "
    f"('EXCLUIR_PROCESO_JUDICIAL', 'EXCLUIR_CREDITO_EMPLEADO') OR flag_error IS NULL) AND {d4('tasa_nominal_anual_pct')} > 0 "
    f"AND {d4('tasa_nominal_anual_pct')} <= 30 AND {d2('score_crediticio')} BETWEEN 200 AND 850 AND {d2('saldo_capital')} >= 0"
)
_KEPT_INCOME = [
    "ing_intereses_cartera", "ing_intereses_inversiones", "ing_intereses_interbancarios", "ing_comisiones_ganadas",
    "ing_utilidades_financieras", "ing_servicios", "otros_ingresos", "total_ingresos", "gasto_intereses_depositos",
    "gasto_intereses_obligaciones", "gasto_comisiones_pagadas", "total_gastos_financieros", "gasto_personal",
    "gasto_honorarios", "gasto_instalaciones", "gasto_publicidad", "gasto_sistemas_tecnologia",
    "total_gastos_operativos", "impuesto_renta_25pct", "recuperaciones_periodo", "castigos_periodo",
]
def income_mart(result: str) -> str:
    """Cleaned income statement with a given form of the pre-tax result."""
    return (
        "SELECT *, total_ingresos - total_gastos_financieros AS margen_financiero_bruto, "
        "total_ingresos - total_gastos_financieros - gasto_provisiones_periodo AS margen_financiero_neto, "
        "resultado_antes_impuestos - participacion_trabajadores_15pct - impuesto_renta_25pct AS utilidad_neta FROM (SELECT "
        f"{day('fecha_mes')} AS fecha_mes, {', '.join(f'{d4(c)} AS {c}' for c in _KEPT_INCOME)}, "
        f"abs({d4('gasto_provisiones_periodo')}) AS gasto_provisiones_periodo, {result} AS resultado_antes_impuestos, "
        f"CASE WHEN {d2('resultado_antes_impuestos')} > 0 THEN {d2('resultado_antes_impuestos')} * 0.15 ELSE 0 END "
        "AS participacion_trabajadores_15pct FROM {income}) c"
    )


TABLES["mart_income"] = income_mart(f"abs({d4('resultado_antes_impuestos')})")
_BALANCE_KEPT = [
    c for c in S.BALANCE_AMOUNTS
    if c not in ("cartera_bruta", "total_activos", "total_patrimonio", "aporte_cosede")
]
TABLES["portfolio"] = (
    f"SELECT {day('fecha_corte')} AS fecha_mes, sum({d2('saldo_capital')}) AS cartera_bruta, sum({d2('saldo_capital')}) "
    "FILTER (WHERE calificacion_sbs IN ('Normal', 'Vigente')) AS cartera_vigente FROM {loans} GROUP BY 1"
)
TABLES["mart_balance"] = (
    "SELECT b.*, p.cartera_bruta, p.cartera_vigente, capital_social + reserva_legal + reserva_especial + superavit_valuaciones + "
    "utilidad_acumulada_ejercicio AS total_patrimonio, fondos_disponibles + operaciones_interbancarias_activo + inversiones + "
    "(p.cartera_bruta - provisiones_acumuladas) + cuentas_por_cobrar + bienes_realizables_adjudicados + propiedades_y_equipos + otros_activos "
    "AS total_activos, CAST(CAST(total_obligaciones_publico AS DECIMAL(28,2)) * 0.00065 / 6 AS DECIMAL(18,4)) AS aporte_cosede FROM (SELECT "
    f"{day('fecha_mes')} AS fecha_mes, {', '.join(f'{d2(c)} AS {c}' for c in _BALANCE_KEPT)} FROM {{balance}}) b "
    "LEFT JOIN {portfolio} p ON b.fecha_mes = p.fecha_mes"
)
TABLES["typed_payments"] = (
    f"SELECT {typed(S.PAYMENT_TYPES, ('monto_pagado', 'canal_pago'))}, abs({d2('monto_pagado')}) AS monto_pagado, canal_pago FROM {{payments}}"
)
TABLES["mart_payments"] = (
    "SELECT p.* EXCLUDE (canal_pago, dias_retraso_pago, cuota_pactada), CASE WHEN canal_pago IS NULL AND monto_pagado > 0 THEN 'No Identificado' "
    "WHEN canal_pago IS NULL AND monto_pagado <= 0 THEN 'No Aplica (Sin Pago)' ELSE canal_pago END AS canal_pago, "
    "CASE WHEN dias_retraso_pago < 0 THEN CASE WHEN monto_pagado = 0 THEN 180 ELSE 0 END ELSE dias_retraso_pago END AS dias_retraso_pago, "
    "coalesce(dias_retraso_pago < 0 AND monto_pagado > 0, FALSE) AS es_pago_anticipado, "
    "CASE WHEN cuota_pactada <> cuota_mensual THEN cuota_mensual ELSE cuota_pactada END AS cuota_pactada "
    "FROM {typed_payments} p LEFT JOIN {loan_instalment} l ON p.id_credito = l.id_credito"
)
TABLES["fixed_customers"] = (
    "SELECT * EXCLUDE (bad) REPLACE (CASE WHEN bad THEN '0' ELSE tiene_credito_en_mora END AS tiene_credito_en_mora, "
    "CASE WHEN bad THEN '0' ELSE max_dias_atraso END AS max_dias_atraso, CASE WHEN bad THEN 'MORA_SIN_SALDO' ELSE flag_error END AS flag_error) "
    f"FROM (SELECT *, coalesce({d2('saldo_mora_total')} = 0 AND {whole('max_dias_atraso')} > 0, FALSE) AS bad FROM {{customers}}) c"
)
TABLES["mart_customers"] = (
    "SELECT fecha_primer_credito, fecha_ultimo_corte, t.id_cliente, tipo_persona, segmento, "
    f"{SECTOR} AS sector_economico, zona_geografica, coalesce(t.oficial_credito, o.oficial) AS oficial_credito, "
    "CASE WHEN tipo_persona = 'Natural' THEN 0 ELSE edad_empresa_anos END AS edad_empresa_anos, antiguedad_cliente_meses, num_creditos_activos, "
    "num_creditos_sistema, num_refinanciaciones, coalesce(calificacion_consolidada, CASE WHEN max_dias_atraso = 0 THEN 'Normal' "
    "WHEN max_dias_atraso <= 15 THEN 'Potencial' WHEN max_dias_atraso <= 45 THEN 'Deficiente' WHEN max_dias_atraso <= 90 THEN 'Dudoso' "
    "WHEN max_dias_atraso > 90 THEN 'Pérdida' END) AS calificacion_consolidada, score_crediticio, max_dias_atraso, tiene_credito_en_mora, "
    "abs(saldo_total_deuda) AS saldo_total_deuda, abs(saldo_mora_total) AS saldo_mora_total, tasa_mora_cliente_pct, "
    "CASE WHEN abs(provision_total_cliente - provisions) > 0.01 THEN provisions ELSE provision_total_cliente END AS provision_total_cliente, "
    "CASE WHEN abs(el_total_cliente - expected_loss) > 0.01 THEN expected_loss ELSE el_total_cliente END AS el_total_cliente, "
    "CASE WHEN abs(tasa_nominal_promedio - weighted_rate) > 0.01 THEN CAST(CAST(weighted_rate AS DECIMAL(28,6)) AS DECIMAL(18,4)) ELSE tasa_nominal_promedio END AS tasa_nominal_promedio, "
    "CASE WHEN abs(ingresos_anuales - f.v) > 0.01 THEN f.v ELSE ingresos_anuales END AS ingresos_anuales, "
    "exposure / nullif(income, 0) * 100 AS tasa_endeudamiento_sistema_pct, "
    "CASE WHEN rating = 'Normal' AND tenure_months > 24 AND n_loans > 1 THEN 1 ELSE 0 END AS es_cliente_preferente "
    f"FROM (SELECT {typed(S.CUSTOMER_TYPES)} FROM {{fixed_customers}}) t "
    "LEFT JOIN (SELECT id_cliente, max(oficial_credito) AS oficial FROM {loans} GROUP BY id_cliente) o ON t.id_cliente = o.id_cliente "
    "LEFT JOIN {last_roll} m ON t.id_cliente = m.id_cliente LEFT JOIN {first_income} f ON t.id_cliente = f.id_cliente "
    "WHERE abs(saldo_total_deuda) NOT IN (251958.69, 3099540.33) AND tasa_mora_cliente_pct <= 100 AND score_crediticio BETWEEN 200 AND 850"
)


def dim(key: str, columns: list[str], source: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    names = ", ".join(columns)
    return f"SELECT row_number() OVER (ORDER BY {order}) AS {key}, {names} FROM (SELECT DISTINCT {names} FROM {source}) d"


TABLES["dim_customer"] = dim("id_cliente_PK", S.CUSTOMER_KEYS, "{mart_credits}")
TABLES["dim_status"] = dim("id_status_t5", ["es_cliente_preferente", "tiene_credito_en_mora"], "{mart_customers}")
TABLES["dim_product"] = dim("id_producto_PK", ["producto_crediticio", "tipo_garantia"], "{mart_credits}")
TABLES["dim_state"] = dim("id_estado_PK", ["estado_pago", "canal_pago"], "{mart_payments}")
TABLES["ratings"] = (
    "SELECT calificacion_sbs AS calificacion FROM {mart_credits} UNION SELECT calificacion_consolidada FROM {mart_customers} "
    "UNION SELECT calificacion_al_pago FROM {mart_payments}"
)
TABLES["dim_rating"] = dim("id_calificacion_sk", ["calificacion"], "{ratings}")
_SIX = " AND ".join(f"t.{c} = c.{c}" for c in S.CUSTOMER_KEYS)
TABLES["fact_credits"] = (
    f"SELECT t.*, c.id_cliente_PK, r.id_calificacion_sk, p.id_producto_PK FROM {{mart_credits}} t LEFT JOIN {{dim_customer}} c ON {_SIX} "
    "LEFT JOIN {dim_rating} r ON t.calificacion_sbs = r.calificacion LEFT JOIN {dim_product} p ON t.producto_crediticio = p.producto_crediticio "
    "AND t.tipo_garantia = p.tipo_garantia"
)
TABLES["best_customer"] = (
    "SELECT id_cliente, segmento, zona_geografica, oficial_credito, id_cliente_PK FROM (SELECT *, row_number() OVER (PARTITION BY id_cliente, segmento, "
    "zona_geografica, oficial_credito ORDER BY CASE WHEN sector_economico IS NOT NULL THEN 0 ELSE 1 END, CASE WHEN tipo_persona IS NOT NULL THEN 0 "
    "ELSE 1 END, id_cliente_PK DESC) AS rn FROM {dim_customer}) x WHERE rn = 1"
)
TABLES["fact_payments"] = (
    "SELECT t.*, c.id_cliente_PK, r.id_calificacion_sk, e.id_estado_PK FROM {mart_payments} t LEFT JOIN {best_customer} c ON "
    "t.id_cliente = c.id_cliente AND t.segmento = c.segmento AND t.zona_geografica = c.zona_geografica AND t.oficial_credito = c.oficial_credito "
    "LEFT JOIN {dim_rating} r ON t.calificacion_al_pago = r.calificacion LEFT JOIN {dim_state} e ON t.estado_pago = e.estado_pago "
    "AND t.canal_pago = e.canal_pago"
)
TABLES["fact_customers"] = (
    f"SELECT t.*, c.id_cliente_PK, s.id_status_t5, r.id_calificacion_sk FROM {{mart_customers}} t LEFT JOIN {{dim_customer}} c ON {_SIX} "
    "LEFT JOIN {dim_status} s ON t.es_cliente_preferente = s.es_cliente_preferente AND t.tiene_credito_en_mora = s.tiene_credito_en_mora "
    "LEFT JOIN {dim_rating} r ON t.calificacion_consolidada = r.calificacion"
)

# --- monthly series ----------------------------------------------------------------------

TABLES["months"] = (
    "SELECT i.fecha_mes, utilidad_neta, margen_financiero_bruto, gasto_provisiones_periodo, castigos_periodo, total_patrimonio, total_activos, "
    "cartera_bruta, cartera_vigente, inversiones, operaciones_interbancarias_activo, tasa_mora_pct_t1, cobertura_provision_pct_t1, "
    "indice_liquidez_pct, indice_solvencia_pct FROM {mart_income} i LEFT JOIN {mart_balance} b ON i.fecha_mes = b.fecha_mes"
)


def loan_sums(keys: str, source: str = "{mart_credits}") -> str:
    group = f" GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return (
        f"SELECT {lead}sum(saldo_capital) AS portfolio, sum(saldo_capital) FILTER (WHERE calificacion_sbs IN ('Pérdida', 'Deficiente', 'Dudoso')) "
        "AS in_arrears, sum(saldo_capital) FILTER (WHERE calificacion_sbs IN ('Normal', 'Vigente')) AS performing, "
        "sum(provision_constituida) AS provisions, sum(CAST(pd_probabilidad_default AS DECIMAL(8,4)) * CAST(lgd_loss_given_default AS DECIMAL(8,4)) * "
        f"saldo_capital) AS expected_loss FROM {source}{group}"
    )


TABLES["loan_months"] = f"SELECT fecha_corte AS fecha_mes, * EXCLUDE (fecha_corte) FROM ({loan_sums('fecha_corte')}) s"
