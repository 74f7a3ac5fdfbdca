"""Profiles and audits of the raw layer, one entry per audit statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankmart import schemas as S
from bankmart.functions import as_day, as_money, as_whole
from bankmart.operators import domains, keys, profile, reconcile, rules
from bankmart.operators.clean import fix_arrears_without_balance
from catalog.registry import query
from catalog.shapes import D2, D4, d2, d4, day, freq, invalid, missing, negative, plus, whole

AS_OF = "1999-12-31"
PROFILE = "step:s field:s dirty_value:s freq:n"
NEGATIVE = "step:s field:s freq:n"
MISSING = "step:s field:s nulls:n rows:n pct:m"
FREQ = "value:s freq:n"
GAP = "reported:m recomputed:m gap:m"

# --- invalid, negative and missing values -----------------------------------------------

for name, table, fields in [
    ("dq_invalid_values", "loans", S.LOAN_NUMERIC),
    ("dq_invalid_values_income", "income", S.INCOME_NUMERIC),
    ("dq_invalid_values_balance", "balance", S.BALANCE_NUMERIC),
    ("dq_invalid_values_payments", "payments", S.PAYMENT_NUMERIC),
    ("dq_invalid_values_customers", "customers", S.CUSTOMER_NUMERIC),
]:
    query(name, PROFILE,
          lambda t, table=table, fields=fields: profile.invalid_values(getattr(t, table), fields),
          invalid(table, fields, "invalid_values"))

DATES = ["fecha_vencimiento_cuota", "fecha_pago_real"]
query("dq_invalid_dates", PROFILE, lambda t: profile.invalid_dates(t.payments, DATES),
      invalid("payments", DATES, "invalid_dates", "DATE", "'NULL', 'NaN', 'N/A'"))
query("dq_invalid_dates_rows", "id_cliente:s fecha_primer_credito:s fecha_ultimo_corte:s",
      lambda t: profile.invalid_date_rows(
          t.customers, ["fecha_primer_credito", "fecha_ultimo_corte"], ["id_cliente"]),
      f"SELECT id_cliente, fecha_primer_credito, fecha_ultimo_corte FROM {{customers}} "
      f"WHERE {day('fecha_primer_credito')} IS NULL OR {day('fecha_ultimo_corte')} IS NULL")

for name, table, fields, kinds, kind in [
    ("dq_negatives", "loans", S.LOAN_NUMERIC, {}, S.RATE),
    ("dq_negatives_income", "income", S.INCOME_SIGNED, {}, S.RATE),
    ("dq_negatives_balance", "balance", S.BALANCE_SIGNED, {}, S.RATE),
    ("dq_negatives_payments", "payments", S.PAYMENT_NUMERIC,
     {c: S.WHOLE for c in S.PAYMENT_WHOLE}, S.RATE),
    ("dq_negatives_customers", "customers", S.CUSTOMER_NUMERIC, {}, S.MONEY),
]:
    query(name, NEGATIVE,
          lambda t, table=table, fields=fields, kinds=kinds, kind=kind: profile.negatives(
              getattr(t, table), fields, kinds, kind),
          negative(table, fields, kinds, kind))

for name, table, fields in [
    ("dq_missing", "loans", S.LOAN_REQUIRED),
    ("dq_missing_income", "income", S.INCOME_REQUIRED),
    ("dq_missing_balance", "balance", S.BALANCE_REQUIRED),
    ("dq_missing_payments", "payments", S.PAYMENT_REQUIRED),
    ("dq_missing_customers", "customers", S.CUSTOMER_REQUIRED),
]:
    query(name, MISSING,
          lambda t, table=table, fields=fields: profile.missing(getattr(t, table), fields),
          missing(table, fields))

UNPAID = ["id_pago", "id_credito", "segmento", "fecha_vencimiento_cuota", "fecha_pago_real",
          "estado_pago", "monto_pagado"]
query("dq_missing_rows", " ".join(f"{c}:s" for c in UNPAID),
      lambda t: profile.missing_rows(t.payments, "fecha_pago_real", UNPAID,
                                     ["fecha_vencimiento_cuota", "id_pago"]),
      f"SELECT {', '.join(UNPAID)} FROM {{payments}} "
      "WHERE fecha_pago_real IS NULL OR fecha_pago_real = ''")
query("dq_missing_rows_rating", "id_cliente:s calificacion_consolidada:s max_dias_atraso:s",
      lambda t: profile.missing_rows(
          t.customers, "calificacion_consolidada",
          ["id_cliente", "calificacion_consolidada", "max_dias_atraso"], null_only=True),
      "SELECT id_cliente, calificacion_consolidada, max_dias_atraso FROM {customers} "
      "WHERE calificacion_consolidada IS NULL")
query("dq_missing_rows_dates", "fecha_primer_credito:s fecha_ultimo_corte:s",
      lambda t: profile.missing_rows(
          t.customers, ["fecha_primer_credito", "fecha_ultimo_corte"],
          ["fecha_primer_credito", "fecha_ultimo_corte"]),
      "SELECT fecha_primer_credito, fecha_ultimo_corte FROM {customers} "
      "WHERE coalesce(fecha_primer_credito, '') = '' OR coalesce(fecha_ultimo_corte, '') = ''")

TOP = ["id_pago", "segmento", "fecha_vencimiento_cuota", "fecha_pago_real", "monto_pagado",
       "estado_pago", "canal_pago"]
query("dq_top_missing", " ".join(f"{c}:s" for c in TOP),
      lambda t: profile.top_missing(t.payments, "canal_pago", "monto_pagado", TOP,
                                    tie_break=["id_pago", "fecha_vencimiento_cuota"]),
      f"SELECT {', '.join(TOP)} FROM {{payments}} WHERE coalesce(canal_pago, '') = '' "
      f"ORDER BY {d2('monto_pagado')} DESC NULLS LAST, id_pago, fecha_vencimiento_cuota LIMIT 20")

# --- uniqueness --------------------------------------------------------------------------

query("dq_duplicate_keys", "id_pago:s n:n loan_seen:s instalment_seen:s",
      lambda t: keys.duplicate_keys(
          t.payments, ["id_pago"],
          {"loan_seen": F.max("id_credito"), "instalment_seen": F.max("numero_cuota")}),
      "SELECT id_pago, count(*) AS n, max(id_credito) AS loan_seen, max(numero_cuota) AS "
      "instalment_seen FROM {payments} GROUP BY id_pago HAVING count(*) > 1")
# Variants in which part of the rows occurs again, so that the audits have something to find.
AGAIN = {"loans": "fecha_corte LIKE '%-12-31' AND id_credito LIKE '%7'", "income": "fecha_mes LIKE '%-12-31'", "balance": "fecha_mes LIKE '%-06-30'"}


def repeated(t, table: str):
    rows = getattr(t, table)
    return rows.unionByName(rows.where(AGAIN[table]))


def repeated_sql(table: str) -> str:
    return f"(SELECT * FROM {{{table}}} UNION ALL SELECT * FROM {{{table}}} WHERE {AGAIN[table]}) again"


query("dq_duplicate_keys_loans", "id_credito:s fecha_corte:s n:n",
      lambda t: keys.duplicate_keys(repeated(t, "loans"), ["id_credito", "fecha_corte"]),
      f"SELECT id_credito, fecha_corte, count(*) AS n FROM {repeated_sql('loans')} GROUP BY 1, 2 HAVING count(*) > 1")
query("dq_duplicate_keys_income", "fecha_mes:s n:n total_net:m",
      lambda t: keys.duplicate_keys(
          repeated(t, "income"), ["fecha_mes"], {"total_net": F.sum(as_money("utilidad_neta"))}),
      f"SELECT fecha_mes, count(*) AS n, sum({d2('utilidad_neta')}) AS total_net "
      f"FROM {repeated_sql('income')} GROUP BY 1 HAVING count(*) > 1")
query("dq_duplicate_keys_balance", "fecha_mes:s n:n first_year:s last_year:s",
      lambda t: keys.duplicate_keys(
          repeated(t, "balance"), ["fecha_mes"],
          {"first_year": F.min("ano"), "last_year": F.max("ano")}),
      "SELECT fecha_mes, count(*) AS n, min(ano) AS first_year, max(ano) AS last_year "
      f"FROM {repeated_sql('balance')} GROUP BY 1 HAVING count(*) > 1")
query("dq_uniqueness_summary", "rows:n distinct_keys:n diff:n",
      lambda t: keys.uniqueness(t.customers, "id_cliente").withColumnRenamed("distinct", "distinct_keys"),
      "SELECT count(*) AS rows, count(DISTINCT id_cliente) AS distinct_keys, "
      "count(*) - count(DISTINCT id_cliente) AS diff FROM {customers}")
query("dq_uniqueness_summary_payments", "rows:n distinct_keys:n diff:n",
      lambda t: keys.uniqueness(t.payments, "id_pago").withColumnRenamed("distinct", "distinct_keys"),
      "SELECT count(*) AS rows, count(DISTINCT id_pago) AS distinct_keys, "
      "count(*) - count(DISTINCT id_pago) AS diff FROM {payments}")

# --- domains and ranges ------------------------------------------------------------------

for name, table, field in [
    ("dq_category_freq", "loans", "segmento"),
    ("dq_category_freq_loan_sector", "loans", "sector_economico"),
    ("dq_category_freq_payment_state", "payments", "estado_pago"),
    ("dq_category_freq_early_flag", "payments", "es_pago_anticipado"),
    ("dq_category_freq_payment_rating", "payments", "calificacion_al_pago"),
    ("dq_category_freq_payment_segment", "payments", "segmento"),
    ("dq_category_freq_payment_officer", "payments", "oficial_credito"),
    ("dq_category_freq_payment_zone", "payments", "zona_geografica"),
    ("dq_category_freq_person_type", "customers", "tipo_persona"),
    ("dq_category_freq_customer_segment", "customers", "segmento"),
    ("dq_category_freq_customer_sector", "customers", "sector_economico"),
    ("dq_category_freq_customer_zone", "customers", "zona_geografica"),
]:
    query(name, FREQ,
          lambda t, table=table, field=field: domains.category_freq(getattr(t, table), field),
          freq(table, field))

query("dq_distinct_values", "calificacion_sbs:s",
      lambda t: domains.distinct_values(t.loans, "calificacion_sbs"),
      "SELECT DISTINCT calificacion_sbs FROM {loans}")
query("dq_distinct_values_preferred", "es_cliente_preferente:n",
      lambda t: domains.distinct_values(t.mart_customers, "es_cliente_preferente"),
      "SELECT DISTINCT es_cliente_preferente FROM {mart_customers}")
query("dq_numeric_freq", "value:n freq:n",
      lambda t: domains.numeric_freq(t.payments, "numero_cuota", descending=True),
      f"SELECT {whole('numero_cuota')} AS value, count(*) AS freq FROM {{payments}} GROUP BY 1")
for field in ("num_creditos_activos", "num_creditos_sistema", "num_refinanciaciones"):
    query(f"dq_numeric_freq_{field}", FREQ,
          lambda t, field=field: domains.numeric_freq(t.customers, field, cast=False),
          freq("customers", field))
query("dq_out_of_domain", FREQ,
      lambda t: domains.out_of_domain(t.customers, "sector_economico", S.SECTORS),
      freq("customers", "sector_economico",
           f"sector_economico NOT IN ({', '.join(repr(s) for s in S.SECTORS)})"))
query("dq_out_of_domain_zone", FREQ,
      lambda t: domains.out_of_domain(t.customers, "zona_geografica", S.ZONES),
      freq("customers", "zona_geografica",
           f"zona_geografica NOT IN ({', '.join(repr(s) for s in S.ZONES)})"))
query("dq_out_of_range", FREQ,
      lambda t: domains.out_of_range(t.customers, "score_crediticio", high=850),
      freq("customers", "score_crediticio", f"{d2('score_crediticio')} > 850"))
query("dq_out_of_range_rows", "id_cliente:s score_crediticio:s",
      lambda t: domains.out_of_range(t.customers, "score_crediticio", high=850, form="rows",
                                     context=["id_cliente"]),
      f"SELECT id_cliente, score_crediticio FROM {{customers}} WHERE {d2('score_crediticio')} > 850")
query("dq_out_of_range_tenure", FREQ,
      lambda t: domains.out_of_range(t.customers, "antiguedad_cliente_meses", low=3),
      freq("customers", "antiguedad_cliente_meses", f"{d2('antiguedad_cliente_meses')} < 3"))
query("dq_out_of_range_days_count", "n:n",
      lambda t: domains.out_of_range(t.customers, "max_dias_atraso", low=0, form="count"),
      f"SELECT count(*) AS n FROM {{customers}} WHERE {d2('max_dias_atraso')} < 0")
query("dq_out_of_range_days_rows", "id_cliente:s max_dias_atraso:s",
      lambda t: domains.out_of_range(t.customers, "max_dias_atraso", low=0, form="rows",
                                     context=["id_cliente"]),
      f"SELECT id_cliente, max_dias_atraso FROM {{customers}} WHERE {d2('max_dias_atraso')} < 0")

for name, table, field, shown in [
    ("dq_sign_text", "payments", "dias_retraso_pago",
     ["fecha_vencimiento_cuota", "fecha_pago_real", "dias_retraso_pago", "estado_pago", "monto_pagado"]),
    ("dq_sign_text_paid", "payments", "monto_pagado",
     ["id_pago", "dias_retraso_pago", "cuota_pactada", "estado_pago", "monto_pagado"]),
    ("dq_sign_text_debt", "customers", "saldo_total_deuda", ["id_cliente", "saldo_total_deuda"]),
]:
    query(name, " ".join(f"{c}:s" for c in shown),
          lambda t, table=table, field=field, shown=shown: domains.sign_text(
              getattr(t, table), field, shown),
          f"SELECT {', '.join(shown)} FROM {{{table}}} WHERE {field} LIKE '%-%'")

query("dq_group_minmax", "tipo_persona:s n:n min_value:m max_value:m",
      lambda t: domains.group_minmax(t.customers, "tipo_persona", "edad_empresa_anos"),
      f"SELECT tipo_persona, count(*) AS n, min({d2('edad_empresa_anos')}) AS min_value, "
      f"max({d2('edad_empresa_anos')}) AS max_value FROM {{customers}} GROUP BY tipo_persona")
ALL_CUSTOMER = " ".join(f"{c}:s" for c in S.RAW_COLUMNS["customers"])
query("dq_conditional_constant", ALL_CUSTOMER,
      lambda t: domains.conditional_constant(
          t.customers, "tipo_persona", "Natural", "edad_empresa_anos", "0"),
      "SELECT * FROM {customers} WHERE tipo_persona = 'Natural' AND edad_empresa_anos <> '0'")

# --- row rules ---------------------------------------------------------------------------

query("dq_chronology", "id_credito:s fecha_corte:s fecha_desembolso:s fecha_vencimiento:s",
      lambda t: rules.chronology(t.loans, "fecha_desembolso", "fecha_vencimiento", AS_OF,
                                 ["id_credito", "fecha_corte"]),
      f"SELECT id_credito, fecha_corte, fecha_desembolso, fecha_vencimiento FROM {{loans}} "
      f"WHERE {day('fecha_vencimiento')} <= {day('fecha_desembolso')} "
      f"OR {day('fecha_desembolso')} > DATE '{AS_OF}'")
for name, mode, word in [("dq_date_parts", "all", "AND"), ("dq_date_parts_any", "any", "OR")]:
    query(name, "fecha_mes:s mes:s ano:s",
          lambda t, mode=mode: rules.date_parts(t.income, "fecha_mes", "ano", "mes", mode),
          f"SELECT fecha_mes, mes, ano FROM {{income}} WHERE year({day('fecha_mes')}) <> {whole('ano')} "
          f"{word} month({day('fecha_mes')}) <> {whole('mes')}")

LOAN_BANDS = (
    "(r = 'Normal' AND d <> 0) OR (r = 'Potencial' AND d NOT BETWEEN 1 AND 15) OR "
    "(r = 'Deficiente' AND d NOT BETWEEN 16 AND 45) OR (r = 'Dudoso' AND d NOT BETWEEN 46 AND 90) OR "
    "(r = 'Pérdida' AND d < {floor})"
)
for name, floor, options in [
    ("dq_rating_bands", 90, {"open_band_floor": 90}), ("dq_rating_bands_strict", 91, {"strict": True}),
]:
    query(name, "calificacion_sbs:s n_wrong:n",
          lambda t, options=options: rules.rating_band_counts(
              t.loans, "calificacion_sbs", "dias_atraso", **options),
          f"SELECT r AS calificacion_sbs, count(*) AS n_wrong FROM (SELECT calificacion_sbs AS r, "
          f"{whole('dias_atraso')} AS d FROM {{loans}}) x WHERE {LOAN_BANDS.format(floor=floor)} GROUP BY r")
query("dq_rating_bands_customers", "id_cliente:s calificacion_consolidada:s max_dias_atraso:s",
      lambda t: rules.rating_band_rows(
          t.customers, "calificacion_consolidada", "max_dias_atraso", ["id_cliente"],
          open_band_floor=91, below_first_ok=True),
      f"SELECT id_cliente, r AS calificacion_consolidada, max_dias_atraso FROM (SELECT *, "
      f"calificacion_consolidada AS r, {whole('max_dias_atraso')} AS d FROM {{customers}}) x WHERE "
      "(r = 'Normal' AND d > 0) OR (r = 'Potencial' AND (d < 1 OR d > 15)) OR "
      "(r = 'Deficiente' AND (d < 16 OR d > 45)) OR (r = 'Dudoso' AND (d < 46 OR d > 90)) OR "
      "(r = 'Pérdida' AND d <= 90)")
query("dq_not_greater", "id_credito:s fecha_corte:s monto_aprobado:s saldo_capital:s",
      lambda t: rules.not_greater(t.loans, "saldo_capital", "monto_aprobado",
                                  ["id_credito", "fecha_corte"]),
      f"SELECT id_credito, fecha_corte, monto_aprobado, saldo_capital FROM {{loans}} "
      f"WHERE {d2('saldo_capital')} > {d2('monto_aprobado')} AND {d2('monto_aprobado')} > 0")

# --- formulas of the income statement ---------------------------------------------------

RESULT = (f"{d2('margen_financiero_neto')} - {d2('total_gastos_operativos')} - "
          f"{d2('otras_perdidas_operacionales')} - {d2('otros_gastos')}")


def _result(df, **options):
    expected = as_money("margen_financiero_neto") - as_money("total_gastos_operativos") - as_money(
        "otras_perdidas_operacionales") - as_money("otros_gastos")
    return rules.gap_audit(df, as_money("resultado_antes_impuestos"), expected, ["fecha_mes"],
                           **options)


def gap_sql(table, reported, expected, where="", gap="reported - recomputed", extra=""):
    return (f"SELECT *, {gap} AS gap{extra} FROM (SELECT fecha_mes, {reported} AS reported, "
            f"{expected} AS recomputed FROM {{{table}}}) x {where}")


query("dq_formula_signed", "fecha_mes:s " + GAP,
      lambda t: _result(t.income, tolerance=0, signed=True),
      gap_sql("income", d2("resultado_antes_impuestos"), RESULT, "WHERE reported - recomputed > 0"))
query("dq_status_audit", "fecha_mes:s result:m reported:m recomputed:q gap:q status:s",
      lambda t: rules.gap_audit(
          t.income, as_money("participacion_trabajadores_15pct"),
          rules.profit_share(as_money("resultado_antes_impuestos")),
          {"fecha_mes": F.col("fecha_mes"), "result": as_money("resultado_antes_impuestos")},
          label_below=F.lit("0.05").cast("decimal(4,2)")).orderBy("fecha_mes"),
      f"SELECT fecha_mes, result, reported, recomputed, reported - recomputed AS gap, CASE WHEN "
      f"abs(reported - recomputed) < 0.05 THEN 'CORRECTO' ELSE 'ERROR_CALCULO' END AS status FROM (SELECT "
      f"fecha_mes, {d2('resultado_antes_impuestos')} AS result, {d2('participacion_trabajadores_15pct')} AS reported, "
      f"CASE WHEN {d2('resultado_antes_impuestos')} > 0 THEN {d2('resultado_antes_impuestos')} * 0.15 ELSE 0 END AS recomputed "
      "FROM {income}) x")
query("dq_net_income_audit",
      "fecha_mes:s result:m share:m tax:m " + GAP,
      lambda t: rules.gap_audit(
          t.income, as_money("utilidad_neta"),
          as_money("resultado_antes_impuestos") - as_money("participacion_trabajadores_15pct")
          - as_money("impuesto_renta_25pct"),
          {"fecha_mes": F.col("fecha_mes"), "result": as_money("resultado_antes_impuestos"),
           "share": as_money("participacion_trabajadores_15pct"),
           "tax": as_money("impuesto_renta_25pct")},
          tolerance=1, absolute=True),
      f"SELECT fecha_mes, result, share, tax, reported, result - share - tax AS recomputed, "
      f"abs(reported - (result - share - tax)) AS gap FROM (SELECT fecha_mes, {d2('resultado_antes_impuestos')} AS result, "
      f"{d2('participacion_trabajadores_15pct')} AS share, {d2('impuesto_renta_25pct')} AS tax, "
      f"{d2('utilidad_neta')} AS reported FROM {{income}}) x WHERE abs(reported - (result - share - tax)) > 1")

for name, reported, parts in [
    ("dq_component_sum", "total_ingresos", S.INCOME_PARTS),
    ("dq_component_sum_cost", "total_gastos_financieros", S.COST_PARTS),
    ("dq_component_sum_opex", "total_gastos_operativos", S.OPEX_PARTS),
]:
    query(name, "fecha_mes:s " + GAP,
          lambda t, reported=reported, parts=parts: rules.component_sum(
              t.income, reported, parts, ["fecha_mes"], tolerance=1, absolute=True),
          gap_sql("income", d2(reported), plus(parts), "WHERE abs(reported - recomputed) > 1",
                  "abs(reported - recomputed)"))
for name, reported, parts, minus, order in [
    ("dq_component_sum_equity", "total_patrimonio", S.EQUITY_PARTS, [], ["fecha_mes"]),
    ("dq_component_sum_assets", "total_activos", S.ASSET_PARTS, ["provisiones_acumuladas"], ["fecha_mes"]),
    ("dq_component_sum_liabilities", "total_pasivos", S.LIABILITY_PARTS, [], ["fecha_mes"]),
    ("dq_component_sum_deposits", "total_obligaciones_publico", S.DEPOSIT_PARTS, [], [F.desc]),
]:
    less = f" - ({plus(minus)})" if minus else ""
    query(name, "fecha_mes:s " + GAP,
          lambda t, reported=reported, parts=parts, minus=minus, order=order: rules.component_sum(
              t.balance, reported, parts, ["fecha_mes"], minus=minus,
              order=[o if isinstance(o, str) else o("gap") for o in order]),
          gap_sql("balance", d2(reported), plus(parts) + less))
ONE_MONTH = "1998-09-30"
query("dq_component_sum_one_month", "fecha_mes:s " + GAP,
      lambda t: rules.component_sum(
          rules.point_lookup(t.balance, "fecha_mes", [ONE_MONTH],
                             ["fecha_mes", "total_patrimonio", *S.EQUITY_PARTS]),
          "total_patrimonio", S.EQUITY_PARTS, ["fecha_mes"], absolute=True),
      gap_sql("balance", d2("total_patrimonio"), plus(S.EQUITY_PARTS), f"WHERE fecha_mes = '{ONE_MONTH}'",
              "abs(reported - recomputed)"))
query("dq_point_lookup", "fecha_mes:s utilidad_neta:m",
      lambda t: rules.point_lookup(t.income, "fecha_mes", ["1997-08-31", "1998-05-31"],
                                   ["fecha_mes", "utilidad_neta"]),
      "SELECT fecha_mes, utilidad_neta FROM {income} WHERE fecha_mes = '1997-08-31' OR fecha_mes = '1998-05-31'")
query("dq_margin_audit",
      "fecha_mes:s income:m financial_cost:m gross_reported:m gross_recomputed:m gross_gap:m "
      "provisions:m net_reported:m net_recomputed:m net_gap:m",
      lambda t: rules.margin_audit(t.income, ["fecha_mes"]),
      f"SELECT fecha_mes, i AS income, c AS financial_cost, g AS gross_reported, i - c AS gross_recomputed, "
      f"abs(g - (i - c)) AS gross_gap, p AS provisions, n AS net_reported, g - p AS net_recomputed, "
      f"abs(n - (g - p)) AS net_gap FROM (SELECT fecha_mes, {d2('total_ingresos')} AS i, "
      f"{d2('total_gastos_financieros')} AS c, {d2('margen_financiero_bruto')} AS g, "
      f"{d2('gasto_provisiones_periodo')} AS p, {d2('margen_financiero_neto')} AS n FROM {{income}}) x "
      "WHERE abs(g - (i - c)) > 1 OR abs(n - (g - p)) > 1")
query("dq_ratio_band", "fecha_mes:s castigos_periodo:m recuperaciones_periodo:m share_pct:r status:s",
      lambda t: rules.ratio_band(t.income, "recuperaciones_periodo", "castigos_periodo", ["fecha_mes"]),
      f"SELECT fecha_mes, c AS castigos_periodo, r AS recuperaciones_periodo, r / c * 100 AS share_pct, CASE "
      "WHEN r / c < 0.08 THEN 'BAJO (Menor al 8%)' WHEN r / c > 0.35 THEN 'ALTO (Mayor al 35%)' ELSE 'DENTRO DE RANGO' END "
      f"AS status FROM (SELECT fecha_mes, {d2('castigos_periodo')} AS c, {d2('recuperaciones_periodo')} AS r "
      "FROM {income}) x WHERE c > 0")

# --- balance sheet -----------------------------------------------------------------------

query("dq_levy_audit", "fecha_mes:s deposits:q reported:q recomputed:q gap:q status:s",
      lambda t: rules.gap_audit(
          t.balance, F.col("aporte_cosede").try_cast("decimal(18,4)"),
          rules.deposit_levy(F.col("total_obligaciones_publico").try_cast("decimal(18,4)")),
          {"fecha_mes": F.col("fecha_mes"),
           "deposits": F.col("total_obligaciones_publico").try_cast("decimal(18,4)")},
          label_below=1).orderBy("fecha_mes"),
      "SELECT fecha_mes, deposits, reported, recomputed, reported - recomputed AS gap, CASE WHEN "
      "abs(reported - recomputed) < 1 THEN 'CORRECTO' ELSE 'ERROR_CALCULO' END AS status FROM (SELECT fecha_mes, "
      f"{d4('total_obligaciones_publico')} AS deposits, {d4('aporte_cosede')} AS reported, "
      f"CAST(CAST({d4('total_obligaciones_publico')} AS DECIMAL(28,4)) * 0.00065 / 6 AS DECIMAL(18,4)) AS recomputed FROM {{balance}}) x")
NEGATIVE_SHOWN = ["fecha_mes", "total_patrimonio", "indice_solvencia_pct", "capital_social",
                  "reserva_legal", "utilidad_acumulada_ejercicio"]
query("dq_negative_context", "fecha_mes:s " + " ".join(f"{c}:m" for c in NEGATIVE_SHOWN[1:]),
      lambda t: rules.negative_context(
          t.balance, ["total_patrimonio", "indice_solvencia_pct"], NEGATIVE_SHOWN),
      f"SELECT {', '.join(NEGATIVE_SHOWN)} FROM {{balance}} WHERE {d4('total_patrimonio')} < 0 "
      f"OR {d4('indice_solvencia_pct')} < 0")

# --- payments ----------------------------------------------------------------------------

query("dq_attribute_mismatch", "id_credito:s cuota_mensual:m cuota_pactada:m",
      lambda t: reconcile.attribute_mismatch(t.payments, t.loans, form="pairs"),
      f"SELECT p.id_credito, cuota_mensual, cuota_pactada FROM (SELECT DISTINCT id_credito, {d2('cuota_pactada')} "
      f"AS cuota_pactada FROM {{payments}}) p JOIN (SELECT DISTINCT id_credito, {d2('cuota_mensual')} AS cuota_mensual "
      "FROM {loans}) l ON p.id_credito = l.id_credito WHERE cuota_mensual <> cuota_pactada")
query("dq_attribute_mismatch_summary",
      "id_credito:s cuota_pactada:m n_differing:n right_min:m right_max:m",
      lambda t: reconcile.attribute_mismatch(t.payments, t.loans),
      f"SELECT p.id_credito, cuota_pactada, count(*) FILTER (WHERE cuota_mensual <> cuota_pactada) AS n_differing, "
      f"min(cuota_mensual) AS right_min, max(cuota_mensual) AS right_max FROM (SELECT DISTINCT id_credito, "
      f"{d2('cuota_pactada')} AS cuota_pactada FROM {{payments}}) p JOIN (SELECT DISTINCT id_credito, "
      f"{d2('cuota_mensual')} AS cuota_mensual FROM {{loans}}) l ON p.id_credito = l.id_credito GROUP BY ALL "
      "HAVING count(*) FILTER (WHERE cuota_mensual <> cuota_pactada) > 0")
query("dq_difference_exact", "id_pago:s " + GAP,
      lambda t: rules.difference_exact(t.payments, "monto_interes_cuota", "cuota_pactada",
                                       "monto_capital_cuota", ["id_pago"]),
      f"SELECT *, reported - recomputed AS gap FROM (SELECT id_pago, {d2('monto_interes_cuota')} AS reported, "
      f"{d2('cuota_pactada')} - {d2('monto_capital_cuota')} AS recomputed FROM {{payments}}) x WHERE reported <> recomputed")
query("dq_negative_not_mirror", "monto_pagado:m cuota_pactada:m estado_pago:s dias_retraso_pago:s",
      lambda t: rules.negative_not_mirror(t.payments, "monto_pagado", "cuota_pactada",
                                          ["estado_pago", "dias_retraso_pago"]),
      f"SELECT {d2('monto_pagado')} AS monto_pagado, {d2('cuota_pactada')} AS cuota_pactada, estado_pago, "
      f"dias_retraso_pago FROM {{payments}} WHERE {d2('monto_pagado')} < 0 AND abs({d2('monto_pagado')}) <> {d2('cuota_pactada')}")
query("dq_floor_zero", "id_credito:s cuota_pactada:m " + GAP,
      lambda t: rules.floor_zero(t.payments, "saldo_pendiente_cuota", "cuota_pactada", "monto_pagado",
                                 ["id_credito"]),
      f"SELECT *, reported - recomputed AS gap FROM (SELECT id_credito, {d2('cuota_pactada')} AS cuota_pactada, "
      f"{d2('saldo_pendiente_cuota')} AS reported, greatest({d2('cuota_pactada')} - {d2('monto_pagado')}, 0) AS recomputed "
      "FROM {payments}) x WHERE reported <> recomputed")

# --- cross-table checks ------------------------------------------------------------------

query("dq_cross_sum", "fecha_mes:s reported:m detail_sum:m gap:m",
      lambda t: reconcile.cross_sum(t.income, t.loans, "castigos_periodo", "monto_castigado"),
      f"SELECT fecha_mes, r AS reported, coalesce(s, 0) AS detail_sum, abs(r - coalesce(s, 0)) AS gap FROM (SELECT "
      f"fecha_mes, {d2('castigos_periodo')} AS r FROM {{income}}) i LEFT JOIN (SELECT fecha_corte, sum({d2('monto_castigado')}) "
      "AS s FROM {loans} GROUP BY fecha_corte) l ON fecha_mes = fecha_corte WHERE abs(r - coalesce(s, 0)) > 1")
query("dq_cross_sum_exact", "fecha_mes:s reported:m detail_sum:m gap:m",
      lambda t: reconcile.cross_sum_exact(t.balance, t.loans, "cartera_bruta", "saldo_capital"),
      f"SELECT fecha_mes, r AS reported, s AS detail_sum, r - s AS gap FROM (SELECT fecha_mes, {d2('cartera_bruta')} AS r "
      f"FROM {{balance}}) b LEFT JOIN (SELECT fecha_corte, sum({d2('saldo_capital')}) AS s FROM {{loans}} GROUP BY fecha_corte) l "
      "ON fecha_mes = fecha_corte WHERE r <> s")
query("dq_lookup_candidates", "id_cliente:s segmento:s candidate:s",
      lambda t: reconcile.lookup_candidates(t.customers, t.loans),
      "SELECT c.id_cliente, c.segmento, l.oficial_credito AS candidate FROM {customers} c LEFT JOIN (SELECT DISTINCT "
      "id_cliente, oficial_credito, segmento FROM {loans}) l ON c.id_cliente = l.id_cliente "
      "WHERE c.oficial_credito IS NULL AND c.segmento = l.segmento")
PROBED = "id_cliente:s id_credito:s fecha_corte:s monto_aprobado:s saldo_capital:s balance:m"
PROBE = {"id_cliente": ["8", "101", "462", "501", "1115", "1455"], "moneda": ["USD"]}
# Balances as they are written, of single loans at each size of the given tables.
PROBE_BALANCES = {"id_cliente": PROBE["id_cliente"],
                  "saldo_capital": ["102061.09", "102491.25", "10300.89", "103180.26", "100828.68", "12011.34", "100408.61", "101151.77"]}
for name, wanted in [("dq_key_value_probe", PROBE), ("dq_key_value_probe_balances", PROBE_BALANCES)]:
    query(name, PROBED,
          lambda t, wanted=wanted: domains.key_value_probe(
              t.loans, wanted, ["id_cliente", "id_credito", "fecha_corte", "monto_aprobado", "saldo_capital",
                                F.abs(as_money("saldo_capital")).alias("balance")]),
          f"SELECT id_cliente, id_credito, fecha_corte, monto_aprobado, saldo_capital, abs({d2('saldo_capital')}) AS balance FROM {{loans}} WHERE "
          + " AND ".join(f"{c} IN ({', '.join(map(repr, texts))})" for c, texts in wanted.items()))
query("dq_flag_rederive", FREQ, lambda t: rules.flag_rederive(t.customers),
      f"SELECT CASE WHEN {whole('max_dias_atraso')} > 0 AND {whole('num_creditos_activos')} > 0 THEN '1' ELSE '0' END "
      "AS value, count(*) AS freq FROM {customers} GROUP BY 1")
query("dq_flag_rederive_stored", FREQ,
      lambda t: rules.flag_rederive(t.customers, "tiene_credito_en_mora"),
      freq("customers", "tiene_credito_en_mora"))
query("dq_flag_contradiction", "id_cliente:s tiene_credito_en_mora:n max_dias_atraso:n saldo_mora_total:m",
      lambda t: rules.flag_contradiction(t.customers),
      f"SELECT * FROM (SELECT id_cliente, {whole('tiene_credito_en_mora')} AS tiene_credito_en_mora, "
      f"{whole('max_dias_atraso')} AS max_dias_atraso, {d2('saldo_mora_total')} AS saldo_mora_total FROM {{customers}}) x WHERE "
      "(saldo_mora_total > 0 AND tiene_credito_en_mora = 0) OR (saldo_mora_total = 0 AND tiene_credito_en_mora = 1 AND max_dias_atraso > 0)")
query("dq_rate_recalc", "id_cliente:s reported:m recomputed:r gap:r",
      lambda t: rules.rate_recalc(t.customers, "tasa_mora_cliente_pct", "saldo_mora_total",
                                  "saldo_total_deuda", ["id_cliente"]),
      f"SELECT *, reported - recomputed AS gap FROM (SELECT id_cliente, {d2('tasa_mora_cliente_pct')} AS reported, "
      f"coalesce(100 * ({d2('saldo_mora_total')} / nullif({d2('saldo_total_deuda')}, 0)), 0) AS recomputed FROM {{customers}}) x "
      "WHERE reported - recomputed > 1")

CUSTOMER_GAP = "id_cliente:s reported:m recomputed:m gap:m"
for name, reported, detail in [
    ("dq_latest_sum", "provision_total_cliente", "provision_constituida"),
    ("dq_latest_sum_loss", "el_total_cliente", "el_expected_loss"),
]:
    query(name, CUSTOMER_GAP,
          lambda t, reported=reported, detail=detail: reconcile.latest_sum_audit(
              t.customers, t.loans, reported, detail),
          f"SELECT c.id_cliente, {d2(reported)} AS reported, s AS recomputed, {d2(reported)} - s AS gap FROM {{customers}} c JOIN "
          f"(SELECT id_cliente, sum({d2(detail)}) AS s, row_number() OVER (PARTITION BY id_cliente ORDER BY {day('fecha_corte')} DESC) AS rn "
          f"FROM {{loans}} GROUP BY id_cliente, {day('fecha_corte')}) l ON c.id_cliente = l.id_cliente "
          f"WHERE rn = 1 AND abs({d2(reported)} - s) > 0.01")
CUTOFF = "2000-06-30"
query("dq_weighted_avg", "id_cliente:s reported:q recomputed:r gap:r",
      lambda t: reconcile.weighted_avg_audit(t.customers, t.loans, CUTOFF),
      f"SELECT c.id_cliente, {d4('tasa_nominal_promedio')} AS reported, w AS recomputed, {d4('tasa_nominal_promedio')} - w AS gap "
      f"FROM {{customers}} c JOIN (SELECT id_cliente, sum({d2('saldo_capital')} * {d4('tasa_nominal_anual_pct')}) / "
      f"nullif(sum({d2('saldo_capital')}), 0) AS w FROM {{loans}} WHERE {day('fecha_corte')} = DATE '{CUTOFF}' GROUP BY id_cliente) l "
      f"ON c.id_cliente = l.id_cliente WHERE abs({d4('tasa_nominal_promedio')} - w) > 0.01")
query("dq_first_record", CUSTOMER_GAP,
      lambda t: reconcile.first_record_audit(t.customers, t.loans),
      f"SELECT c.id_cliente, {d2('c.ingresos_anuales')} AS reported, v AS recomputed, {d2('c.ingresos_anuales')} - v AS gap "
      f"FROM {{customers}} c JOIN {{first_income}} f ON c.id_cliente = f.id_cliente "
      f"WHERE abs({d2('c.ingresos_anuales')} - v) > 0.01")
INCOME_BY_MODE = {
    "record": f"SELECT id_cliente, v FROM (SELECT id_cliente, {d2('ingresos_anuales')} AS v, row_number() OVER (PARTITION BY id_cliente "
              f"ORDER BY {day('fecha_corte')} DESC, id_credito DESC) AS rn FROM {{loans}}) y WHERE rn = 1",
    "sum": "SELECT id_cliente, income AS v FROM {last_roll}",
}
for name, mode in [("dq_debt_to_income", "record"), ("dq_debt_to_income_sum", "sum")]:
    query(name, "id_cliente:s reported:m recomputed:r gap:r",
          lambda t, mode=mode: reconcile.debt_to_income_audit(t.customers, t.loans, income_mode=mode),
          f"SELECT id_cliente, reported, recomputed, reported - recomputed AS gap FROM (SELECT c.id_cliente, "
          f"{d4('c.tasa_endeudamiento_sistema_pct')} AS reported, e / nullif(v, 0) * 100 AS recomputed FROM {{customers}} c JOIN "
          f"(SELECT id_cliente, sum({d2('saldo_total_exposicion')}) AS e FROM {{loans}} WHERE fecha_corte = (SELECT max(fecha_corte) "
          f"FROM {{loans}}) GROUP BY id_cliente) x ON c.id_cliente = x.id_cliente JOIN ({INCOME_BY_MODE[mode]}) i "
          "ON c.id_cliente = i.id_cliente) g WHERE abs(reported - recomputed) > 0.1")
for name, mode in [("dq_preferred_flag", "cutoff"), ("dq_preferred_flag_row1", "row1")]:
    active = "1" if mode == "row1" else (
        "(SELECT count(*) FROM {loans} b WHERE b.id_cliente = a.id_cliente AND b.fecha_corte = a.top)")
    query(name, "id_cliente:s reported:n last_rating:s tenure_months:n active_loans:n reason:s",
          lambda t, mode=mode: reconcile.preferred_flag_audit(t.customers, t.loans, mode),
          f"SELECT * FROM (SELECT c.id_cliente, {whole('es_cliente_preferente')} AS reported, r AS last_rating, m AS tenure_months, "
          "n AS active_loans, CASE WHEN r <> 'Normal' THEN 'ERROR: No es calificación Normal' WHEN m <= 24 THEN "
          "'ERROR: Antigüedad <= 24 meses' WHEN n <= 1 THEN 'ERROR: Solo tiene 1 crédito activo' END AS reason FROM {customers} c JOIN "
          f"(SELECT id_cliente, r, (year({day('top')}) * 12 + month({day('top')})) - (year({day('low')}) * 12 + month({day('low')})) AS m, "
          f"{active} AS n FROM (SELECT id_cliente, calificacion_sbs AS r, max(fecha_corte) OVER (PARTITION BY id_cliente) AS top, "
          "min(fecha_corte) OVER (PARTITION BY id_cliente) AS low, row_number() OVER (PARTITION BY id_cliente ORDER BY fecha_corte DESC, "
          "id_credito DESC) AS rn FROM {loans}) a WHERE rn = 1) l ON c.id_cliente = l.id_cliente) q WHERE "
          "(reported = 1 AND (last_rating <> 'Normal' OR tenure_months <= 24 OR active_loans <= 1)) OR "
          "(reported = 0 AND last_rating = 'Normal' AND tenure_months > 24 AND active_loans > 1)")
