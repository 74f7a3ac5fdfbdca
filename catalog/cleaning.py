"""Cleaning steps, each on the whole table, and the five cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankmart import schemas as S
from bankmart.functions import as_money, as_rate, as_whole, replace_if_differs
from bankmart.operators import clean, rollup
from bankmart.plans import marts
from bankmart.schemas import LOAN_TYPES
from catalog.reference import SECTOR, TABLES, income_mart, typed
from catalog.registry import query
from catalog.shapes import d2, d4, day, whole

LOAN_ID = "id_credito:s fecha_corte:s"
FORM = {"string": "s", "date": "s", "int": "n", "boolean": "n", S.MONEY: "m", S.RATE: "q"}


def forms(types: dict[str, str], **other: str) -> str:
    return " ".join(f"{c}:{other.get(c, FORM[k])}" for c, k in types.items())


# --- loans -------------------------------------------------------------------------------

CAST = {"dias_atraso": S.WHOLE, "saldo_capital": S.MONEY, "tasa_nominal_anual_pct": S.RATE,
        "score_crediticio": S.MONEY, "monto_aprobado": S.MONEY, "plazo_meses": S.WHOLE}
query("cast_once", LOAN_ID + " " + forms(CAST),
      lambda t: clean.project_typed(t.loans, {"id_credito": S.TEXT, "fecha_corte": S.DAY, **CAST}),
      f"SELECT {typed({'id_credito': S.TEXT, 'fecha_corte': S.DAY, **CAST})} FROM {{loans}}")
query("cast_rejects", LOAN_ID + " field:s dirty_value:s",
      lambda t: clean.cast_rejects(t.loans, {c: k for c, k in CAST.items()} | {"fecha_desembolso": S.DAY},
                                   ["id_credito", "fecha_corte"]),
      " UNION ALL ".join(
          f"SELECT id_credito, fecha_corte, '{c}' AS field, {c} AS dirty_value FROM {{loans}} "
          f"WHERE {c} <> '' AND TRY_CAST({c} AS {k}) IS NULL"
          for c, k in [*CAST.items(), ("fecha_desembolso", "DATE")]))
for name, step, where in [
    ("exclude_chronology", clean.exclude_chronology, f"{day('fecha_vencimiento')} > {day('fecha_desembolso')}"),
    ("exclude_policy_flags", clean.exclude_policy_flags,
     "coalesce(flag_error, '') NOT IN ('EXCLUIR_PROCESO_JUDICIAL', 'EXCLUIR_CREDITO_EMPLEADO')"),
    ("exclude_rate_range", clean.exclude_rate_range,
     f"{d4('tasa_nominal_anual_pct')} > 0 AND {d4('tasa_nominal_anual_pct')} <= 30"),
    ("exclude_score_range", clean.exclude_score_range, f"{d2('score_crediticio')} BETWEEN 200 AND 850"),
    ("exclude_negative_balance", clean.exclude_negative_balance, f"{d2('saldo_capital')} >= 0"),
]:
    query(name, LOAN_ID + " flag_error:s",
          lambda t, step=step: step(t.loans).select("id_credito", "fecha_corte", "flag_error"),
          f"SELECT id_credito, fecha_corte, flag_error FROM {{loans}} WHERE {where}")
query("project_typed", forms(LOAN_TYPES), lambda t: clean.project_typed(t.loans, LOAN_TYPES),
      f"SELECT {typed(LOAN_TYPES)} FROM {{loans}}")
query("clamp_days", LOAN_ID + " dias_atraso:n",
      lambda t: clean.clamp_days(clean.project_typed(
          t.loans, {"id_credito": S.TEXT, "fecha_corte": S.DAY, "dias_atraso": S.WHOLE})),
      f"SELECT id_credito, fecha_corte, greatest({whole('dias_atraso')}, 0) AS dias_atraso FROM {{loans}}")
query("normalize_sector", LOAN_ID + " sector_economico:s",
      lambda t: clean.sector_labels(t.loans.select("id_credito", "fecha_corte", "sector_economico")),
      f"SELECT id_credito, fecha_corte, {SECTOR} AS sector_economico FROM {{loans}}")
query("mart_credits", forms(LOAN_TYPES), lambda t: t.mart_credits, "SELECT * FROM {mart_credits}")

# --- income statement and balance sheet -------------------------------------------------

query("abs_repair", "fecha_mes:s gasto_provisiones_periodo:q resultado_antes_impuestos:q",
      lambda t: clean.abs_repair(
          t.income.select("fecha_mes", *[as_rate(c).alias(c) for c in (
              "gasto_provisiones_periodo", "resultado_antes_impuestos")]),
          ["gasto_provisiones_periodo", "resultado_antes_impuestos"]),
      f"SELECT fecha_mes, abs({d4('gasto_provisiones_periodo')}) AS gasto_provisiones_periodo, "
      f"abs({d4('resultado_antes_impuestos')}) AS resultado_antes_impuestos FROM {{income}}")
query("profit_share", "fecha_mes:s participacion_trabajadores_15pct:q",
      lambda t: clean.profit_share_column(t.income).select("fecha_mes", "participacion_trabajadores_15pct"),
      f"SELECT fecha_mes, CASE WHEN {d2('resultado_antes_impuestos')} > 0 THEN {d2('resultado_antes_impuestos')} * 0.15 ELSE 0 END "
      "AS participacion_trabajadores_15pct FROM {income}")
DERIVED = ["margen_financiero_bruto", "margen_financiero_neto", "utilidad_neta"]
query("derive_margins", "fecha_mes:s " + " ".join(f"{c}:q" for c in DERIVED),
      lambda t: t.mart_income.select("fecha_mes", *DERIVED),
      f"SELECT fecha_mes, {', '.join(DERIVED)} FROM {{mart_income}}")
INCOME_OUT = [c for c in S.INCOME_AMOUNTS if c not in (
    "gasto_depreciacion", "gasto_amortizacion", "otros_gastos_operativos", "otras_perdidas_operacionales", "otros_gastos")]
INCOME_FORMS = "fecha_mes:s " + " ".join(f"{c}:q" for c in INCOME_OUT)
query("mart_income", INCOME_FORMS, lambda t: t.mart_income, "SELECT * FROM {mart_income}")
query("mart_income_keep_sign", INCOME_FORMS,
      lambda t: marts.mart_income(t.income, keep_sign=True),
      income_mart(d4("resultado_antes_impuestos")))
query("portfolio_from_loans", "fecha_mes:s cartera_bruta:m cartera_vigente:m",
      lambda t: clean.portfolio_from_loans(t.loans, S.PERFORMING), "SELECT * FROM {portfolio}")
query("rebuild_totals", "fecha_mes:s total_patrimonio:m total_activos:m aporte_cosede:q",
      lambda t: t.mart_balance.select("fecha_mes", "total_patrimonio", "total_activos", "aporte_cosede"),
      "SELECT fecha_mes, total_patrimonio, total_activos, aporte_cosede FROM {mart_balance}")
BALANCE_OUT = "fecha_mes:s " + " ".join(
    f"{c}:{'q' if c == 'aporte_cosede' else 'm'}" for c in [*S.BALANCE_AMOUNTS, "cartera_vigente"])
query("mart_balance", BALANCE_OUT, lambda t: t.mart_balance, "SELECT * FROM {mart_balance}")
query("mart_balance_shared_rollup", BALANCE_OUT,
      lambda t: marts.mart_balance(t.balance, t.loans, t.rolled), "SELECT * FROM {mart_balance}")

# --- payments ----------------------------------------------------------------------------

PAY = {"id_pago": S.TEXT, "monto_pagado": S.MONEY, "canal_pago": S.TEXT, "dias_retraso_pago": S.WHOLE}


def paid(t):
    return clean.abs_paid(clean.project_typed(t.payments, PAY))


query("abs_paid", "id_pago:s monto_pagado:m", lambda t: paid(t),
      f"SELECT id_pago, abs({d2('monto_pagado')}) AS monto_pagado FROM {{payments}}")
query("impute_channel", "id_pago:s monto_pagado:m canal_pago:s", lambda t: clean.impute_channel(paid(t)),
      "SELECT id_pago, monto_pagado, coalesce(canal_pago, CASE WHEN monto_pagado > 0 THEN 'No Identificado' "
      "WHEN monto_pagado <= 0 THEN 'No Aplica (Sin Pago)' END) AS canal_pago FROM {typed_payments}")
query("repair_delay", "id_pago:s monto_pagado:m dias_retraso_pago:n", lambda t: clean.repair_delay(paid(t)),
      "SELECT id_pago, monto_pagado, CASE WHEN dias_retraso_pago >= 0 THEN dias_retraso_pago WHEN monto_pagado = 0 THEN 180 ELSE 0 END "
      "AS dias_retraso_pago FROM {typed_payments}")
query("early_payment_flag", "id_pago:s dias_retraso_pago:n es_pago_anticipado:n",
      lambda t: clean.early_payment_flag(paid(t)),
      "SELECT id_pago, dias_retraso_pago, CASE WHEN dias_retraso_pago < 0 AND monto_pagado > 0 THEN 1 ELSE 0 END AS es_pago_anticipado "
      "FROM {typed_payments}")
query("impute_instalment", "id_pago:s id_credito:s cuota_pactada:m",
      lambda t: clean.impute_instalment(
          clean.project_typed(t.payments, {"id_pago": S.TEXT, "id_credito": S.TEXT, "cuota_pactada": S.MONEY}), t.loans),
      "SELECT id_pago, p.id_credito, coalesce(cuota_mensual, cuota_pactada) AS cuota_pactada "
      "FROM {typed_payments} p LEFT JOIN {loan_instalment} l ON p.id_credito = l.id_credito")
query("mart_payments", forms(S.PAYMENT_TYPES) + " es_pago_anticipado:n", lambda t: t.mart_payments,
      "SELECT * FROM {mart_payments}")

# --- customers ---------------------------------------------------------------------------

query("fix_arrears_without_balance", "id_cliente:s tiene_credito_en_mora:s max_dias_atraso:s flag_error:s",
      lambda t: clean.fix_arrears_without_balance(t.customers),
      "SELECT id_cliente, tiene_credito_en_mora, max_dias_atraso, flag_error FROM {fixed_customers}")
ROLL = ("provisions:m expected_loss:m exposure:m income:m weighted_rate:r n_loans:n rating:s")
query("loan_rollup", "id_cliente:s fecha_corte:s " + ROLL, lambda t: t.rolled, "SELECT * FROM {roll}")
query("latest_rollup", "id_cliente:s last_cutoff:s tenure_months:n " + ROLL,
      lambda t: rollup.latest_rollup(t.rolled),
      "SELECT *, fecha_corte AS last_cutoff FROM {last_roll}")
query("first_income", "id_cliente:s first_income:m", lambda t: rollup.first_income(t.loans),
      "SELECT id_cliente, v AS first_income FROM {first_income}")
CUSTOMER = ["id_cliente", "calificacion_consolidada"]
query("impute_rating", "id_cliente:s calificacion_consolidada:s",
      lambda t: clean.impute_rating(t.customers.select(
          *CUSTOMER, as_whole("max_dias_atraso").alias("max_dias_atraso"))),
      f"SELECT id_cliente, coalesce(calificacion_consolidada, CASE WHEN {whole('max_dias_atraso')} = 0 THEN 'Normal' "
      f"WHEN {whole('max_dias_atraso')} <= 15 THEN 'Potencial' WHEN {whole('max_dias_atraso')} <= 45 THEN 'Deficiente' "
      f"WHEN {whole('max_dias_atraso')} <= 90 THEN 'Dudoso' WHEN {whole('max_dias_atraso')} > 90 THEN 'Pérdida' END) "
      "AS calificacion_consolidada FROM {customers}")
query("impute_officer", "id_cliente:s oficial_credito:s",
      lambda t: clean.impute_officer(t.customers.select("id_cliente", "oficial_credito"), t.loans),
      "SELECT c.id_cliente, coalesce(c.oficial_credito, o) AS oficial_credito FROM {customers} c LEFT JOIN "
      "(SELECT id_cliente, max(oficial_credito) AS o FROM {loans} GROUP BY id_cliente) l ON c.id_cliente = l.id_cliente")
query("fix_company_age", "id_cliente:s tipo_persona:s edad_empresa_anos:m",
      lambda t: clean.fix_company_age(clean.project_typed(t.customers, {
          "id_cliente": S.TEXT, "tipo_persona": S.TEXT, "edad_empresa_anos": S.MONEY})),
      f"SELECT id_cliente, tipo_persona, CASE WHEN tipo_persona = 'Natural' THEN 0 ELSE {d2('edad_empresa_anos')} END AS edad_empresa_anos "
      "FROM {customers}")
query("replace_if_differs", "id_cliente:s provision_total_cliente:m",
      lambda t: t.customers.join(rollup.latest_rollup(t.rolled), "id_cliente", "left").select(
          "id_cliente",
          replace_if_differs(as_money("provision_total_cliente"), "provisions").alias("provision_total_cliente")),
      f"SELECT c.id_cliente, CASE WHEN abs({d2('provision_total_cliente')} - provisions) > 0.01 THEN provisions "
      f"ELSE {d2('provision_total_cliente')} END AS provision_total_cliente FROM {{customers}} c LEFT JOIN {{last_roll}} r "
      "ON c.id_cliente = r.id_cliente")
query("debt_to_income", "id_cliente:s debt_to_income_pct:r",
      lambda t: rollup.latest_rollup(t.rolled).select(
          "id_cliente", clean.debt_to_income("exposure", "income").alias("debt_to_income_pct")),
      "SELECT id_cliente, exposure / nullif(income, 0) * 100 AS debt_to_income_pct FROM {last_roll}")
query("preferred_flag", "id_cliente:s preferred:n",
      lambda t: rollup.latest_rollup(t.rolled).select(
          "id_cliente", clean.preferred_flag("rating", "tenure_months", "n_loans").alias("preferred")),
      "SELECT id_cliente, CASE WHEN rating = 'Normal' AND tenure_months > 24 AND n_loans > 1 THEN 1 ELSE 0 END AS preferred FROM {last_roll}")
query("exclude_customers", "id_cliente:s saldo_total_deuda:m tasa_mora_cliente_pct:m score_crediticio:n",
      lambda t: clean.exclude_customers(clean.abs_debt(clean.project_typed(t.customers, S.CUSTOMER_TYPES))),
      f"SELECT id_cliente, abs({d2('saldo_total_deuda')}) AS saldo_total_deuda, {d2('tasa_mora_cliente_pct')} AS tasa_mora_cliente_pct, "
      f"{whole('score_crediticio')} AS score_crediticio FROM {{customers}} WHERE abs({d2('saldo_total_deuda')}) NOT IN (251958.69, 3099540.33) "
      f"AND {d2('tasa_mora_cliente_pct')} <= 100 AND {whole('score_crediticio')} BETWEEN 200 AND 850")
query("abs_debt", "id_cliente:s saldo_total_deuda:m saldo_mora_total:m",
      lambda t: clean.abs_debt(clean.project_typed(t.customers, {
          "id_cliente": S.TEXT, "saldo_total_deuda": S.MONEY, "saldo_mora_total": S.MONEY})),
      f"SELECT id_cliente, abs({d2('saldo_total_deuda')}) AS saldo_total_deuda, abs({d2('saldo_mora_total')}) AS saldo_mora_total FROM {{customers}}")
query("mart_customers",
      forms(S.CUSTOMER_TYPES, tasa_nominal_promedio="r") + " tasa_endeudamiento_sistema_pct:r es_cliente_preferente:n",
      lambda t: t.mart_customers, "SELECT * FROM {mart_customers}")
