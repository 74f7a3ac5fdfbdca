"""Raw banking tables derived from the given star-schema tables.

The SQL text is the input of both engines: Spark reads it as a view, the reference SQL as
a common table expression. Defects are seeded by modulo rules, so they are the same at any
scale: non-numeric and empty texts, negative amounts, impossible dates, wrong ratings,
mixed-case categories, missing channels and officers, totals that do not add up.
Names in braces are tables.
"""

from __future__ import annotations

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Typed loan panel, one row per (order, month of shipment).
LOAN_PANEL = """
SELECT l_orderkey AS k, o_custkey AS ck,
  last_day(CAST(l_shipdate AS DATE)) AS corte,
  CAST(o_orderdate AS DATE) AS desembolso, CAST(max(l_shipdate) AS DATE) AS vencimiento,
  c_mktsegment AS seg, n_name AS zona, o_orderpriority AS producto,
  max(l_returnflag) AS garantia, CAST(max(l_linenumber) AS INT) AS linea,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS saldo,
  CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS cuota,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS provision,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS perdida,
  CAST(CAST(max(l_discount) AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS descuento,
  CAST(CAST(max(l_tax) AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS impuesto,
  CAST(max(l_quantity) AS INT) * 3 - 10 AS dias
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
GROUP BY l_orderkey, o_custkey, last_day(CAST(l_shipdate AS DATE)), CAST(o_orderdate AS DATE),
  o_totalprice, o_orderpriority, c_mktsegment, n_name
"""

DEAL = "REPARTITION(k)"
DEAL_ORDERS = "REPARTITION(o_orderkey)"
# The same rows for Spark: lines are summed per order and month before any join, by tasks that hold
# whole orders, so that neither a scan nor a join keeps wide groups. ``copies`` counts what a join
# with repeated orders or customers would repeat, in the tasks that hold the lines of those orders:
# the tasks that read or join the orders keep no table of them.
SPARK_LOAN_PANEL = f"""
SELECT k, ck, corte, desembolso, vencimiento, seg, zona, producto, garantia, linea, CAST(totalprice AS DECIMAL(18,2)) AS total,
  CAST(saldo * copies AS DECIMAL(18,2)) AS saldo, cuota, CAST(provision * copies AS DECIMAL(18,2)) AS provision,
  CAST(perdida * copies AS DECIMAL(18,2)) AS perdida, descuento, impuesto, dias
FROM (
  SELECT k, corte, CAST(max(l_shipdate) AS DATE) AS vencimiento, max(l_returnflag) AS garantia,
    CAST(max(l_linenumber) AS INT) AS linea, sum(x) AS saldo, CAST(max(x) AS DECIMAL(18,2)) AS cuota,
    sum(x * CAST(l_tax AS DECIMAL(4,2))) AS provision, sum(x * CAST(l_discount AS DECIMAL(4,2))) AS perdida,
    CAST(CAST(max(l_discount) AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS descuento,
    CAST(CAST(max(l_tax) AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS impuesto, CAST(max(l_quantity) AS INT) * 3 - 10 AS dias
  FROM (SELECT /*+ {DEAL} */ l_orderkey AS k, last_day(CAST(l_shipdate AS DATE)) AS corte, l_shipdate, l_returnflag, l_linenumber,
          CAST(l_extendedprice AS DECIMAL(18,2)) AS x, l_tax, l_discount, l_quantity FROM {{lineitem}}) l
  GROUP BY k, corte
) JOIN (
  SELECT o_orderkey, ck, desembolso, totalprice, producto, seg, zona, count(*) AS copies
  FROM (SELECT /*+ {DEAL_ORDERS} */ o_orderkey, o_custkey AS ck, CAST(o_orderdate AS DATE) AS desembolso,
          o_totalprice AS totalprice, o_orderpriority AS producto, c_mktsegment AS seg, n_name AS zona
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey) o
  GROUP BY o_orderkey, ck, desembolso, totalprice, producto, seg, zona
) ON k = o_orderkey
"""

RAW_LOANS = """
SELECT CAST(k AS STRING) AS id_credito, CAST(ck AS STRING) AS id_cliente,
  CASE WHEN ck % 3 = 0 THEN 'Natural' ELSE 'Jurídica' END AS tipo_persona,
  seg AS segmento, zona AS zona_geografica,
  concat('OF-', CAST(ck % 8 AS STRING)) AS oficial_credito,
  producto AS producto_crediticio, 'USD' AS moneda,
  CASE WHEN k % 37 = 0 THEN '31/31/2024' ELSE CAST(desembolso AS STRING) END AS fecha_desembolso,
  CAST(vencimiento AS STRING) AS fecha_vencimiento, CAST(corte AS STRING) AS fecha_corte,
  CASE WHEN k % 31 = 0 THEN 'abc' ELSE CAST(k % 60 AS STRING) END AS plazo_meses,
  CASE WHEN k % 17 = 0 THEN 'N/A' WHEN k % 19 = 0 THEN '' WHEN k % 23 = 0 THEN NULL
       WHEN k % 29 = 0 THEN concat('-', CAST(total AS STRING)) ELSE CAST(total AS STRING) END AS monto_aprobado,
  CAST(CAST(total * 0.95 AS DECIMAL(18,2)) AS STRING) AS monto_desembolsado,
  CASE WHEN k % 101 = 0 THEN concat('-', CAST(saldo AS STRING)) ELSE CAST(saldo AS STRING) END AS saldo_capital,
  CAST(CAST(saldo * 0.01 AS DECIMAL(18,2)) AS STRING) AS saldo_interes_devengado,
  CAST(CAST(CASE WHEN dias > 0 THEN saldo * 0.10 ELSE 0 END AS DECIMAL(18,2)) AS STRING) AS saldo_mora,
  CAST(saldo AS STRING) AS saldo_total_exposicion,
  CAST(CAST(descuento * 400 AS DECIMAL(18,4)) AS STRING) AS tasa_nominal_anual_pct,
  CAST(CAST(descuento * 420 AS DECIMAL(18,4)) AS STRING) AS tasa_efectiva_anual_pct,
  CAST(CAST(impuesto * 100 AS DECIMAL(18,4)) AS STRING) AS spread_pct,
  CAST(CAST(impuesto * 50 AS DECIMAL(18,4)) AS STRING) AS costo_fondos_pct,
  CAST(linea AS STRING) AS numero_cuotas_vencidas,
  CASE WHEN k % 73 = 0 THEN 'Pérdida' WHEN k % 13 = 0 THEN 'Normal' WHEN k % 59 = 0 THEN 'Potencial' WHEN k % 61 = 0 THEN 'Deficiente'
       WHEN k % 67 = 0 THEN 'Dudoso' WHEN k % 71 = 0 THEN 'Pérdida' WHEN dias <= 0 THEN 'Normal' WHEN dias <= 15 THEN 'Potencial'
       WHEN dias <= 45 THEN 'Deficiente' WHEN dias <= 90 THEN 'Dudoso' ELSE 'Pérdida' END AS calificacion_sbs,
  CAST(k % 5 AS STRING) AS tasa_provision_pct,
  CAST(CAST(provision * 1.10 AS DECIMAL(18,2)) AS STRING) AS provision_requerida,
  CAST(provision AS STRING) AS provision_constituida,
  garantia AS tipo_garantia,
  CAST(CAST(total * 1.20 AS DECIMAL(18,2)) AS STRING) AS valor_garantia,
  CAST(CAST(k % 3 AS DECIMAL(18,2)) AS STRING) AS cobertura_garantia_ratio,
  CAST(CAST(k % 90 AS DECIMAL(18,4)) AS STRING) AS ltv_loan_to_value,
  CAST(CAST(k % 4 AS DECIMAL(18,2)) AS STRING) AS ratio_cobertura_total,
  CASE WHEN k % 47 = 0 THEN '9999' WHEN k % 53 = 0 THEN '-1' ELSE CAST(200 + (k * 37) % 700 AS STRING) END AS score_crediticio,
  CAST(descuento AS STRING) AS pd_probabilidad_default,
  CAST(impuesto AS STRING) AS lgd_loss_given_default,
  CAST(perdida AS STRING) AS el_expected_loss,
  CAST(CAST(k % 6 AS DECIMAL(18,2)) AS STRING) AS dscr_cobertura_servicio_deuda,
  CAST(CAST(k % 7 AS DECIMAL(18,4)) AS STRING) AS ratio_endeudamiento,
  CAST(CAST(k % 8 AS DECIMAL(18,4)) AS STRING) AS ratio_liquidez_corriente,
  CAST(CAST(total * 2 AS DECIMAL(18,2)) AS STRING) AS ingresos_anuales,
  CAST(cuota AS STRING) AS cuota_mensual,
  CAST(k % 3 AS STRING) AS numero_refinanciaciones, CAST(k % 2 AS STRING) AS es_refinanciado,
  CAST(k % 4 AS STRING) AS veces_pago_anticipado, CAST(ck % 5 AS STRING) AS numero_creditos_banco,
  CAST(ck % 6 AS STRING) AS numero_creditos_sistema, CAST(ck % 40 AS STRING) AS antiguedad_cliente_meses,
  CAST(ck % 30 AS STRING) AS edad_empresa_anos,
  CASE WHEN k % 9 = 0 THEN '1' ELSE '0' END AS en_castigo,
  CASE WHEN k % 9 = 0 THEN CAST(saldo AS STRING) ELSE '0' END AS monto_castigado,
  CASE WHEN k % 73 = 0 THEN '90' ELSE CAST(dias AS STRING) END AS dias_atraso,
  CASE k % 6 WHEN 0 THEN 'AGRICULTURA' WHEN 1 THEN 'comercio ' WHEN 2 THEN 'Salud'
       WHEN 3 THEN 'construccion' WHEN 4 THEN 'Transporte' ELSE NULL END AS sector_economico,
  CASE WHEN k % 41 = 0 THEN 'EXCLUIR_PROCESO_JUDICIAL' WHEN k % 43 = 0 THEN 'EXCLUIR_CREDITO_EMPLEADO' ELSE NULL END AS flag_error
FROM {loan_panel}
"""

RAW_PAYMENTS = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id_pago,
  CAST(l_orderkey AS STRING) AS id_credito, CAST(o_custkey AS STRING) AS id_cliente,
  c_mktsegment AS segmento, concat('OF-', CAST(o_custkey % 8 AS STRING)) AS oficial_credito,
  n_name AS zona_geografica,
  CAST(CAST(CASE WHEN l_partkey % 89 = 0 THEN x * 0.25 ELSE x - y END AS DECIMAL(18,2)) AS STRING) AS monto_interes_cuota,
  CAST(l_linenumber AS STRING) AS numero_cuota,
  CASE WHEN l_orderkey % 11 = 0 THEN CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE NULL END
       WHEN l_partkey % 113 = 0 THEN 'N/A' WHEN l_partkey % 127 = 0 THEN '31/31/2024'
       ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS fecha_pago_real,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS fecha_vencimiento_cuota,
  CAST(x AS STRING) AS cuota_pactada, CAST(y AS STRING) AS monto_capital_cuota,
  CASE WHEN l_orderkey % 11 = 0 THEN '0'
       WHEN l_partkey % 97 = 0 THEN concat('-', CAST(CASE WHEN l_partkey % 2 = 0 THEN x ELSE y END AS STRING))
       WHEN l_partkey % 71 = 0 THEN CAST(y AS STRING) ELSE CAST(x AS STRING) END AS monto_pagado,
  CAST(CASE WHEN l_orderkey % 11 = 0 THEN CASE WHEN l_partkey % 83 = 0 THEN y ELSE x END ELSE CAST(0 AS DECIMAL(18,2)) END AS STRING) AS saldo_pendiente_cuota,
  CAST(CAST(l_quantity AS INT) - 10 AS STRING) AS dias_retraso_pago,
  CASE l_linenumber % 4 WHEN 0 THEN 'Pago Puntual' WHEN 1 THEN 'Pago Tardío' WHEN 2 THEN 'Pago Parcial' ELSE 'No Pago' END AS estado_pago,
  CASE WHEN l_suppkey % 10 = 0 THEN NULL WHEN l_suppkey % 10 = 1 THEN '' ELSE l_returnflag END AS canal_pago,
  CASE WHEN l_quantity <= 10 THEN 'Normal' WHEN l_quantity <= 25 THEN 'Potencial' WHEN l_quantity <= 40 THEN 'Deficiente' ELSE 'Vigente' END AS calificacion_al_pago,
  CASE WHEN l_partkey % 103 = 0 THEN 'si' WHEN l_partkey % 2 = 0 THEN '1' ELSE '0' END AS es_pago_anticipado
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS x,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.80 AS DECIMAL(18,2)) AS y FROM {lineitem}) l
  JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

RAW_CUSTOMERS = """
SELECT CASE WHEN c_custkey % 67 = 0 THEN '' WHEN c_custkey % 73 = 0 THEN '30/02/1996' ELSE CAST(last_day(CAST(concat(CAST(1992 + c_custkey % 7 AS STRING), '-', lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-01') AS DATE)) AS STRING) END AS fecha_primer_credito,
  CASE WHEN c_custkey % 79 = 0 THEN NULL ELSE '2001-11-30' END AS fecha_ultimo_corte,
  CAST(c_custkey AS STRING) AS id_cliente,
  CASE WHEN c_custkey % 3 = 0 THEN 'Natural' ELSE 'Jurídica' END AS tipo_persona,
  c_mktsegment AS segmento,
  CASE c_custkey % 6 WHEN 0 THEN 'AGRICULTURA' WHEN 1 THEN 'comercio ' WHEN 2 THEN 'Salud'
       WHEN 3 THEN 'construccion' WHEN 4 THEN 'Transporte' ELSE NULL END AS sector_economico,
  n_name AS zona_geografica,
  CASE WHEN c_custkey % 25 = 0 THEN NULL ELSE concat('OF-', CAST(c_custkey % 8 AS STRING)) END AS oficial_credito,
  CAST(c_custkey % 30 AS STRING) AS edad_empresa_anos,
  CAST(c_custkey % 40 AS STRING) AS antiguedad_cliente_meses,
  CAST(c_custkey % 5 AS STRING) AS num_creditos_activos, CAST(c_custkey % 9 AS STRING) AS num_creditos_sistema,
  CAST(c_custkey % 4 AS STRING) AS num_refinanciaciones,
  CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN 'Dudoso' WHEN d = 0 THEN 'Normal' WHEN d <= 15 THEN 'Potencial'
       WHEN d <= 45 THEN 'Deficiente' WHEN d <= 90 THEN 'Dudoso' ELSE 'Pérdida' END AS calificacion_consolidada,
  CAST(200 + (c_custkey * 53) % 720 AS STRING) AS score_crediticio,
  CAST(CASE WHEN c_custkey % 97 = 0 THEN 0 - d ELSE d END AS STRING) AS max_dias_atraso,
  CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '0' END AS tiene_credito_en_mora,
  CAST(b AS STRING) AS saldo_total_deuda,
  CAST(CAST(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE abs(b) * 0.50 END AS DECIMAL(18,2)) AS STRING) AS saldo_mora_total,
  CASE WHEN c_custkey % 4 = 0 THEN '0' WHEN c_custkey % 6 = 0 THEN '130' ELSE '50' END AS tasa_mora_cliente_pct,
  CAST(CAST(abs(b) * 0.10 AS DECIMAL(18,2)) AS STRING) AS provision_total_cliente,
  CAST(CAST(abs(b) * 0.05 AS DECIMAL(18,2)) AS STRING) AS el_total_cliente,
  CASE WHEN c_custkey % 109 = 0 THEN 'x' ELSE CAST(c_custkey % 30 AS STRING) END AS tasa_nominal_promedio,
  CAST(c_custkey * 100 AS STRING) AS ingresos_anuales,
  CAST(c_custkey % 90 AS STRING) AS tasa_endeudamiento_sistema_pct,
  CASE WHEN c_custkey % 7 = 0 THEN '1' ELSE '0' END AS es_cliente_preferente,
  CAST(NULL AS STRING) AS flag_error
FROM (SELECT *, (c_custkey * 7) % 120 AS d, CAST(c_acctbal AS DECIMAL(18,2)) AS b FROM {customer}) c
  JOIN {nation} ON c_nationkey = n_nationkey
"""

# Typed monthly sums that both statements are made of.
MONTH_SUMS = """
SELECT mes_fin, CAST(month(mes_fin) AS INT) AS m, CAST(year(mes_fin) AS INT) AS a,
  CAST(sum(x) AS DECIMAL(18,2)) AS todo,
  CAST(sum(CASE WHEN l_linestatus = 'F' THEN x ELSE 0 END) AS DECIMAL(18,2)) AS f,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN x ELSE 0 END) AS DECIMAL(18,2)) AS o,
  CAST(sum(CASE WHEN l_orderkey % 9 = 0 THEN x ELSE 0 END) AS DECIMAL(18,2)) AS castigo,
  CAST(sum(CASE WHEN l_orderkey % 36 = 0 THEN x ELSE 0 END) AS DECIMAL(18,2)) AS recupero,
  CAST(sum(CASE WHEN l_orderkey % 101 = 0 THEN -x ELSE x END) AS DECIMAL(18,2)) AS cartera,
  CAST(sum(CASE WHEN l_quantity > 20 THEN x ELSE 0 END) AS DECIMAL(18,2)) AS mora,
  CAST(sum(x * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS provision,
  CAST(sum(x * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS perdida,
  CAST(sum(CASE WHEN l_linenumber = 1 THEN x ELSE 0 END) AS DECIMAL(18,2)) AS l1,
  CAST(sum(CASE WHEN l_linenumber = 2 THEN x ELSE 0 END) AS DECIMAL(18,2)) AS l2,
  CAST(sum(CASE WHEN l_linenumber = 3 THEN x ELSE 0 END) AS DECIMAL(18,2)) AS l3,
  CAST(sum(CASE WHEN l_linenumber >= 4 THEN x ELSE 0 END) AS DECIMAL(18,2)) AS l4,
  CAST(sum(CASE WHEN l_orderkey % 4 = 0 THEN x * 2 ELSE x * -0.60 END) AS DECIMAL(18,2)) AS resultado
FROM (SELECT *, last_day(CAST(l_shipdate AS DATE)) AS mes_fin, CAST(l_extendedprice AS DECIMAL(18,2)) AS x FROM {lineitem}) l
GROUP BY mes_fin
"""


# Months in which a statement column, part of no total, holds a word instead of a number.
_WORDS = {"recuperaciones_periodo": "m = 8 AND a % 2 = 0", "activos_ponderados_riesgo": "m = 8 AND a % 2 = 1"}


def _text(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING)"


def _column(name: str, expr: str) -> str:
    if name in _WORDS:
        return f"CASE WHEN {_WORDS[name]} THEN 'n/d' ELSE {_text(expr)} END AS {name}"
    return f"{_text(expr)} AS {name}"


_INCOME = {
    "ing_intereses_cartera": "f", "ing_intereses_inversiones": "l1 * 0.05",
    "ing_intereses_interbancarios": "l2 * 0.05", "ing_comisiones_ganadas": "l3 * 0.05",
    "ing_utilidades_financieras": "l4 * 0.02", "ing_servicios": "o",
    "otros_ingresos": "todo * 0.01",
    "gasto_intereses_depositos": "todo * 0.20", "gasto_intereses_obligaciones": "todo * 0.05",
    "gasto_comisiones_pagadas": "todo * 0.02",
    "gasto_provisiones_periodo": "CASE WHEN m = 2 THEN -provision ELSE provision END",
    "gasto_personal": "todo * 0.10", "gasto_honorarios": "todo * 0.03",
    "gasto_instalaciones": "todo * 0.02", "gasto_publicidad": "todo * 0.01",
    "gasto_sistemas_tecnologia": "todo * 0.01", "gasto_depreciacion": "l1 * 0.01",
    "gasto_amortizacion": "l2 * 0.01", "otros_gastos_operativos": "l3 * 0.01",
    "castigos_periodo": "CASE WHEN m = 11 THEN castigo + 250 ELSE castigo END",
    "recuperaciones_periodo": "recupero",
    "otras_perdidas_operacionales": "l4 * 0.01", "otros_gastos": "l1 * 0.02",
    "resultado_antes_impuestos": "CASE WHEN m = 5 THEN todo ELSE resultado END",
    "participacion_trabajadores_15pct": "CASE WHEN resultado > 0 AND m <> 3 THEN resultado * 0.15 ELSE 0 END",
    "impuesto_renta_25pct": "CASE WHEN resultado > 0 THEN resultado * 0.20 ELSE 0 END",
}
# Sums over the rounded texts, so that a consistent month adds up to the cent.
_INCOME_TOTALS = {
    "total_ingresos": ("ing_intereses_cartera ing_intereses_inversiones ing_intereses_interbancarios"
                       " ing_comisiones_ganadas ing_utilidades_financieras ing_servicios otros_ingresos", "CASE WHEN m = 4 THEN 1000 ELSE 0 END"),
    "total_gastos_financieros": ("gasto_intereses_depositos gasto_intereses_obligaciones gasto_comisiones_pagadas",
                                 "CASE WHEN m = 5 THEN 50 ELSE 0 END"),
    "total_gastos_operativos": ("gasto_personal gasto_honorarios gasto_instalaciones gasto_publicidad gasto_sistemas_tecnologia"
                                " gasto_depreciacion gasto_amortizacion otros_gastos_operativos", "CASE WHEN m = 6 THEN -75 ELSE 0 END"),
}


def _money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


def _plus(columns: str) -> str:
    return " + ".join(_money(c) for c in columns.split())


RAW_INCOME = (
    "SELECT p.*, " + _text(f"{_money('margen_financiero_bruto')} - {_money('gasto_provisiones_periodo')}")
    + " AS margen_financiero_neto, "
    + _text(f"{_money('resultado_antes_impuestos')} - {_money('participacion_trabajadores_15pct')} - {_money('impuesto_renta_25pct')}"
            " + CASE WHEN CAST(mes AS INT) = 8 THEN 5 ELSE 0 END")
    + " AS utilidad_neta FROM (SELECT t.*, "
    + _text(f"{_money('total_ingresos')} - {_money('total_gastos_financieros')} + CASE WHEN CAST(mes AS INT) = 7 THEN 10 ELSE 0 END")
    + " AS margen_financiero_bruto FROM (SELECT c.*, "
    + ", ".join(f"{_text(f'{_plus(parts)} + {defect}')} AS {name}" for name, (parts, defect) in _INCOME_TOTALS.items())
    + " FROM (SELECT CAST(mes_fin AS STRING) AS fecha_mes, m,"
    " CAST(CASE WHEN m = 10 THEN 9 ELSE m END AS STRING) AS mes,"
    " CAST(CASE WHEN m = 10 AND a % 2 = 0 THEN a + 1 ELSE a END AS STRING) AS ano, "
    + ", ".join(_column(name, expr) for name, expr in _INCOME.items())
    + " FROM {month_sums}) c) t) p"
)

_BALANCE = {
    "fondos_disponibles": "l4 * 0.30", "operaciones_interbancarias_activo": "l2 * 0.10",
    "inversiones": "l3",
    "cartera_bruta": "CASE WHEN m = 6 THEN cartera + 500 ELSE cartera END",
    "provisiones_acumuladas": "provision", "cuentas_por_cobrar": "todo * 0.02",
    "bienes_realizables_adjudicados": "l1 * 0.02", "propiedades_y_equipos": "l1 * 0.05",
    "otros_activos": "l2 * 0.03",
    "depositos_vista": "l4 * 0.40", "depositos_ahorro": "l4 * 0.30", "depositos_plazo": "l4 * 0.25",
    "depositos_restringidos": "l4 * 0.05",
    "operaciones_interbancarias_pasivo": "l2 * 0.05", "obligaciones_financieras_bde_cfn": "l1 * 0.20",
    "cuentas_por_pagar": "l3 * 0.10", "otros_pasivos": "l3 * 0.05",
    "capital_social": "l1", "reserva_legal": "l2 * 0.50", "reserva_especial": "l2 * 0.10",
    "superavit_valuaciones": "l3 * 0.02", "utilidad_acumulada_ejercicio": "resultado * 0.10",
    "activos_ponderados_riesgo": "todo * 0.90",
    "indice_solvencia_pct": "CASE WHEN m = 9 THEN -12 ELSE 12 + m END",
    "indice_liquidez_pct": "10 + m * 3",
    "cartera_mora_t1": "mora", "tasa_mora_pct_t1": "4 + m * 0.75",
    "provision_requerida_t1": "provision * 1.10", "provision_constituida_t1": "provision",
    "cobertura_provision_pct_t1": "80 + m * 1.50", "el_total_t1": "perdida",
}
_BALANCE_TOTALS = {
    "cartera_neta": f"{_money('cartera_bruta')} - {_money('provisiones_acumuladas')}",
    "total_activos": _plus("fondos_disponibles operaciones_interbancarias_activo inversiones cartera_bruta"
                           " cuentas_por_cobrar bienes_realizables_adjudicados propiedades_y_equipos otros_activos")
    + f" - {_money('provisiones_acumuladas')} + CASE WHEN m = 12 THEN 100000 ELSE 0 END",
    "total_obligaciones_publico": _plus("depositos_vista depositos_ahorro depositos_plazo depositos_restringidos")
    + " + CASE WHEN m = 1 THEN 7 ELSE 0 END",
    "total_pasivos": _plus("depositos_vista depositos_ahorro depositos_plazo depositos_restringidos"
                           " operaciones_interbancarias_pasivo obligaciones_financieras_bde_cfn cuentas_por_pagar otros_pasivos"),
    "total_patrimonio": "(" + _plus("capital_social reserva_legal reserva_especial superavit_valuaciones"
                                    " utilidad_acumulada_ejercicio") + ") * CASE WHEN m = 9 THEN -1 ELSE 1 END",
}

RAW_BALANCE = (
    "SELECT p.*, CAST(CAST(" + _money("total_obligaciones_publico")
    + " * CASE WHEN m > 6 THEN CAST(0.00065 AS DECIMAL(9,8)) ELSE CAST(0.00010833 AS DECIMAL(9,8)) END AS DECIMAL(18,4)) AS STRING) AS aporte_cosede"
    " FROM (SELECT t.*, "
    + ", ".join(f"{_text(expr)} AS {name}" for name, expr in _BALANCE_TOTALS.items())
    + " FROM (SELECT CAST(mes_fin AS STRING) AS fecha_mes, m, CAST(m AS STRING) AS mes, CAST(a AS STRING) AS ano, "
    + ", ".join(_column(name, expr) for name, expr in _BALANCE.items())
    + " FROM {month_sums}) t) p"
)

FIXTURES: dict[str, str] = {
    "loan_panel": LOAN_PANEL, "month_sums": MONTH_SUMS, "loans": RAW_LOANS, "income": RAW_INCOME,
    "balance": RAW_BALANCE, "payments": RAW_PAYMENTS, "customers": RAW_CUSTOMERS,
}
#: What Spark reads: the same tables, written for its shuffles.
SPARK_FIXTURES: dict[str, str] = FIXTURES | {"loan_panel": SPARK_LOAN_PANEL}
