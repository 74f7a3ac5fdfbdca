"""Aggregation, join, window, sort, set and scalar primitives the audits are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankmart.functions import (
    as_boolean, as_day, as_decimal, as_money, as_rate, as_whole, blank, blank_to_null,
    month_gap, month_index, ratio, rating_from_days,
)
from bankmart.operators import domains, keys, profile, reconcile, rollup
from bankmart.operators.dimension import with_calendar_parts
from bankmart.operators.joins import hot_keys, lookup
from bankmart.plans import galaxy, kpi
from catalog.kpis import LONG, SHORT
from catalog.registry import query
from catalog.shapes import d2, d4, day, whole

# --- aggregation -------------------------------------------------------------------------

query("agg_group_count", "segmento:s zona_geografica:s n:n",
      lambda t: t.loans.groupBy("segmento", "zona_geografica").agg(F.count("*").alias("n")),
      "SELECT segmento, zona_geografica, count(*) AS n FROM {loans} GROUP BY 1, 2")
query("agg_sum_min_max", "fecha_corte:s total:m low:m high:m",
      lambda t: t.loans.groupBy("fecha_corte").agg(
          F.sum(as_money("saldo_capital")).alias("total"), F.min(as_money("saldo_capital")).alias("low"),
          F.max(as_money("saldo_capital")).alias("high")),
      f"SELECT fecha_corte, sum({d2('saldo_capital')}) AS total, min({d2('saldo_capital')}) AS low, max({d2('saldo_capital')}) AS high FROM {{loans}} GROUP BY 1")
query("agg_count_distinct", "segmento:s customers:n loans:n",
      lambda t: t.loans.groupBy("segmento").agg(
          F.count_distinct("id_cliente").alias("customers"), F.count_distinct("id_credito").alias("loans")),
      "SELECT segmento, count(DISTINCT id_cliente) AS customers, count(DISTINCT id_credito) AS loans FROM {loans} GROUP BY 1")
query("agg_having", "id_cliente:s fecha_corte:s n:n",
      lambda t: keys.duplicate_keys(t.loans, ["id_cliente", "fecha_corte"]),
      "SELECT id_cliente, fecha_corte, count(*) AS n FROM {loans} GROUP BY 1, 2 HAVING count(*) > 1")
query("agg_conditional", "segmento:s n_missing:n healthy:m latest_rating:s",
      lambda t: t.loans.groupBy("segmento").agg(
          F.count_if(blank("monto_aprobado")).alias("n_missing"),
          F.sum(F.when(F.col("calificacion_sbs") == "Normal", as_money("saldo_capital"))).alias("healthy"),
          F.max(F.when(as_whole("dias_atraso") > 90, F.col("calificacion_sbs"))).alias("latest_rating")),
      f"SELECT segmento, sum(CASE WHEN monto_aprobado IS NULL OR monto_aprobado = '' THEN 1 ELSE 0 END) AS n_missing, "
      f"sum(CASE WHEN calificacion_sbs = 'Normal' THEN {d2('saldo_capital')} END) AS healthy, "
      f"max(CASE WHEN {whole('dias_atraso')} > 90 THEN calificacion_sbs END) AS latest_rating FROM {{loans}} GROUP BY 1")
query("agg_weighted_avg", "id_cliente:s rate:r",
      lambda t: t.loans.groupBy("id_cliente").agg(
          rollup.weighted_avg(as_rate("tasa_nominal_anual_pct"), as_money("saldo_capital")).alias("rate")),
      f"SELECT id_cliente, sum({d2('saldo_capital')} * {d4('tasa_nominal_anual_pct')}) / nullif(sum({d2('saldo_capital')}), 0) AS rate FROM {{loans}} GROUP BY 1")
query("agg_over_filtered", "fecha_mes:s cartera_bruta:m cartera_vigente:m",
      lambda t: t.rolled.groupBy(F.col("fecha_corte").alias("fecha_mes")).agg(
          F.sum("balance").alias("cartera_bruta"), F.sum("performing_balance").alias("cartera_vigente")),
      "SELECT * FROM {portfolio}")
query("agg_pct_of_total", "segmento:s pct:m",
      lambda t: t.loans.groupBy("segmento").agg(
          profile.percent(F.count_if(blank("sector_economico")), F.count("*")).alias("pct")),
      "SELECT segmento, ((n * 20000 + c) // (2 * c)) / 100.0 AS pct FROM (SELECT segmento, count(*) AS c, "
      "count(*) FILTER (WHERE coalesce(sector_economico, '') = '') AS n FROM {loans} GROUP BY 1) x")
query("agg_multi_one_pass", "id_cliente:s fecha_corte:s provisions:m exposure:m weighted_rate:r n_loans:n rating:s",
      lambda t: t.rolled, "SELECT * FROM {roll}")

# --- joins -------------------------------------------------------------------------------

CUSTOMER = "SELECT id_cliente, max_dias_atraso FROM {customers}"
query("join_inner_equi", "id_credito:s fecha_corte:s id_cliente:s max_dias_atraso:s",
      lambda t: lookup(t.loans.select("id_credito", "fecha_corte", "id_cliente"),
                       t.customers.select("id_cliente", "max_dias_atraso"), ["id_cliente"], "inner"),
      f"SELECT id_credito, fecha_corte, l.id_cliente, max_dias_atraso FROM {{loans}} l JOIN ({CUSTOMER}) c ON l.id_cliente = c.id_cliente")
query("join_left_equi", "id_pago:s id_credito:s cuota_mensual:m",
      lambda t: lookup(t.payments.select("id_pago", "id_credito"),
                       rollup.loan_latest_instalment(t.loans), ["id_credito"]),
      "SELECT id_pago, p.id_credito, cuota_mensual FROM {payments} p LEFT JOIN {loan_instalment} l ON p.id_credito = l.id_credito")
query("join_left_multikey", "id_credito:s fecha_corte:s id_cliente_PK:n",
      lambda t: lookup(t.staged_credits, t.dim_customer, galaxy.CUSTOMER_KEYS),
      "SELECT * FROM {fact_credits}")
query("join_left_multikey_salted", "id_credito:s fecha_corte:s id_cliente_PK:n",
      lambda t: lookup(t.staged_credits, t.dim_customer, galaxy.CUSTOMER_KEYS, share=4),
      "SELECT * FROM {fact_credits}")
query("join_hot_keys", "moneda:s segmento:s _salts:n",
      lambda t: hot_keys(t.loans, ["moneda", "segmento"], share=6),
      "SELECT moneda, segmento, ceil(count(*) * 6 / (SELECT count(*) FROM {loans})) AS _salts FROM {loans} GROUP BY 1, 2 "
      "HAVING count(*) * 6 > (SELECT count(*) FROM {loans})")
query("join_left_ranked", "id_cliente:s provisions:m ranking:n",
      lambda t: t.customers.select("id_cliente").join(
          t.rolled.join(rollup.rank_cutoffs(t.rolled).where("ranking = 1"), ["id_cliente", "fecha_corte"]),
          "id_cliente", "left"),
      "SELECT c.id_cliente, provisions, ranking FROM {customers} c LEFT JOIN {ranked_roll} r ON c.id_cliente = r.id_cliente AND ranking = 1")
query("join_lateral_top1", "id_pago:s fecha_vencimiento_cuota:s id_cliente_PK:n",
      lambda t: lookup(t.staged_payments, galaxy.best_customer(t.dim_customer),
                       ["id_cliente", "segmento", "zona_geografica", "oficial_credito"]),
      "SELECT * FROM {fact_payments}")
query("join_lateral_values", "id_credito:s fecha_corte:s field:s value:s",
      lambda t: t.loans.unpivot(["id_credito", "fecha_corte"], ["monto_aprobado", "plazo_meses", "dias_atraso"], "field", "value"),
      " UNION ALL ".join(f"SELECT id_credito, fecha_corte, '{c}' AS field, {c} AS value FROM {{loans}}"
                         for c in ("monto_aprobado", "plazo_meses", "dias_atraso")))
query("join_scalar_subquery", "id_credito:s fecha_corte:s",
      lambda t: t.loans.select("id_credito", "fecha_corte").where(
          F.col("fecha_corte") == t.loans.agg(F.max("fecha_corte")).scalar()),
      "SELECT id_credito, fecha_corte FROM {loans} WHERE fecha_corte = (SELECT max(fecha_corte) FROM {loans})")
query("join_agg_pushed", "fecha_mes:s castigos_periodo:s detail_sum:m",
      lambda t: t.income.select(as_day("fecha_mes").alias("fecha_mes"), "castigos_periodo").join(
          reconcile.month_sums(t.loans, {"detail_sum": as_money("monto_castigado")}), "fecha_mes", "left"),
      f"SELECT i.fecha_mes, castigos_periodo, s AS detail_sum FROM {{income}} i LEFT JOIN (SELECT fecha_corte, sum({d2('monto_castigado')}) AS s "
      "FROM {loans} GROUP BY 1) l ON i.fecha_mes = l.fecha_corte")

# --- windows -----------------------------------------------------------------------------

query("win_latest_per_key", "id_credito:s cuota_mensual:m",
      lambda t: rollup.loan_latest_instalment(t.loans), "SELECT * FROM {loan_instalment}")
query("win_first_per_key", "id_cliente:s income:m", lambda t: rollup.first_income(t.loans, "income"),
      "SELECT id_cliente, v AS income FROM {first_income}")
query("win_recent_per_key", "id_cliente:s income:m", lambda t: rollup.recent_income(t.loans, "income"),
      f"SELECT id_cliente, v AS income FROM (SELECT id_cliente, {d2('ingresos_anuales')} AS v, row_number() OVER (PARTITION BY id_cliente "
      f"ORDER BY {day('fecha_corte')} DESC, id_credito DESC) AS rn FROM {{loans}}) x WHERE rn = 1")
query("win_rank_over_agg", "id_cliente:s fecha_corte:s ranking:n",
      lambda t: rollup.rank_cutoffs(t.rolled), "SELECT * FROM {ranked_roll}")
query("win_min_over_partition", "id_cliente:s fecha_corte:s tenure_months:n",
      lambda t: rollup.rank_cutoffs(t.rolled), "SELECT * FROM {ranked_roll}")
query("win_global_row_number", "id_cliente_PK:n id_cliente:s sector_economico:s",
      lambda t: t.dim_customer, "SELECT * FROM {dim_customer}")

# --- sort, limit and sets ----------------------------------------------------------------

query("sort_result", "fecha_mes:s total_ingresos:m",
      lambda t: t.income.select("fecha_mes", "total_ingresos").orderBy(F.desc(as_money("total_ingresos")), "fecha_mes"),
      "SELECT fecha_mes, total_ingresos FROM {income} ORDER BY 2 DESC")
query("topk", "id_pago:s monto_pagado:s",
      lambda t: profile.top_missing(t.payments, "canal_pago", "monto_pagado", ["id_pago", "monto_pagado"], 50,
                                    ["id_pago", "fecha_vencimiento_cuota"]),
      f"SELECT id_pago, monto_pagado FROM {{payments}} WHERE coalesce(canal_pago, '') = '' ORDER BY {d2('monto_pagado')} DESC NULLS LAST, id_pago, "
      "fecha_vencimiento_cuota LIMIT 50")
query("top1_per_key", "id_cliente:s segmento:s zona_geografica:s oficial_credito:s id_cliente_PK:n",
      lambda t: galaxy.best_customer(t.dim_customer), "SELECT * FROM {best_customer}")
query("set_union_distinct", "calificacion:s",
      lambda t: galaxy.rating_domain(t.mart_credits, t.mart_customers, t.mart_payments), "SELECT * FROM {ratings}")
query("set_distinct", "estado_pago:s canal_pago:s",
      lambda t: domains.distinct_values(t.mart_payments, ["estado_pago", "canal_pago"]),
      "SELECT DISTINCT estado_pago, canal_pago FROM {mart_payments}")

# --- scalar functions --------------------------------------------------------------------

query("fn_try_cast", "id_credito:s fecha_corte:s amount:q term:n paid_out:s",
      lambda t: t.loans.select("id_credito", "fecha_corte", as_decimal("monto_aprobado").alias("amount"),
                               as_whole("plazo_meses").alias("term"), as_day("fecha_desembolso").alias("paid_out")),
      f"SELECT id_credito, fecha_corte, {d4('monto_aprobado')} AS amount, {whole('plazo_meses')} AS term, {day('fecha_desembolso')} AS paid_out FROM {{loans}}")
query("fn_null_handling", "id_pago:s channel:s filled:s paid:n",
      lambda t: t.payments.select(
          "id_pago", blank_to_null("canal_pago").alias("channel"),
          F.coalesce(blank_to_null("canal_pago"), F.lit("-")).alias("filled"),
          as_boolean("monto_pagado").alias("paid")),
      f"SELECT id_pago, nullif(canal_pago, '') AS channel, coalesce(nullif(canal_pago, ''), '-') AS filled, {d2('monto_pagado')} <> 0 AS paid FROM {{payments}}")
query("fn_abs_divide", "id_cliente:s debt:m share:r",
      lambda t: t.customers.select("id_cliente", F.abs(as_money("saldo_total_deuda")).alias("debt"),
                                   ratio(as_money("saldo_mora_total"), as_money("saldo_total_deuda"), 0.0).alias("share")),
      f"SELECT id_cliente, abs({d2('saldo_total_deuda')}) AS debt, coalesce(CAST({d2('saldo_mora_total')} AS DOUBLE) / "
      f"nullif(CAST({d2('saldo_total_deuda')} AS DOUBLE), 0), 0) AS share FROM {{customers}}")
query("fn_case_bands", "id_cliente:s rating:s",
      lambda t: t.customers.select("id_cliente", rating_from_days(as_whole("max_dias_atraso")).alias("rating")),
      f"SELECT id_cliente, CASE WHEN d = 0 THEN 'Normal' WHEN d <= 15 THEN 'Potencial' WHEN d <= 45 THEN 'Deficiente' WHEN d <= 90 THEN 'Dudoso' "
      f"WHEN d > 90 THEN 'Pérdida' END AS rating FROM (SELECT id_cliente, {whole('max_dias_atraso')} AS d FROM {{customers}}) x")
query("fn_like_in_between", "id_pago:s dias_retraso_pago:s estado_pago:s",
      lambda t: t.payments.where(
          F.col("estado_pago").like("%Pago%") & F.col("estado_pago").isin("Pago Puntual", "No Pago")
          & as_whole("dias_retraso_pago").between(5, 15)).select("id_pago", "dias_retraso_pago", "estado_pago"),
      f"SELECT id_pago, dias_retraso_pago, estado_pago FROM {{payments}} WHERE estado_pago LIKE '%Pago%' AND estado_pago IN ('Pago Puntual', 'No Pago') "
      f"AND {whole('dias_retraso_pago')} BETWEEN 5 AND 15")
query("fn_month_arithmetic", "id_credito:s fecha_corte:s months:n month_no:n back_11:s",
      lambda t: t.loans.select(
          "id_credito", "fecha_corte", month_gap(as_day("fecha_desembolso"), as_day("fecha_corte")).alias("months"),
          month_index(as_day("fecha_corte")).alias("month_no"),
          F.add_months(as_day("fecha_corte"), -11).alias("back_11")),
      f"SELECT id_credito, fecha_corte, datediff('month', {day('fecha_desembolso')}, {day('fecha_corte')}) AS months, "
      f"year({day('fecha_corte')}) * 12 + month({day('fecha_corte')}) AS month_no, CAST({day('fecha_corte')} - INTERVAL 11 MONTH AS DATE) AS back_11 FROM {{loans}}")
query("fn_calendar_parts", "fecha:s ano:n nombre_mes:s mes_corto:s trimestre:s ano_mes:s",
      lambda t: with_calendar_parts(t.payments.select(as_day("fecha_vencimiento_cuota").alias("fecha")).distinct(), "fecha"),
      f"SELECT fecha, year(fecha) AS ano, {LONG}[month(fecha)] AS nombre_mes, {SHORT}[month(fecha)] AS mes_corto, concat('T', quarter(fecha)) AS trimestre, "
      f"strftime(fecha, '%Y-%m') AS ano_mes FROM (SELECT DISTINCT {day('fecha_vencimiento_cuota')} AS fecha FROM {{payments}}) x")
query("fn_blank_difference", "fecha_mes:s value:m previous:m diff:m",
      lambda t: kpi.kpi_index(t.months, "cartera_vigente"),
      "SELECT fecha_mes, v AS value, p AS previous, CASE WHEN v IS NULL AND p IS NULL THEN NULL ELSE coalesce(v, 0) - coalesce(p, 0) END AS diff FROM "
      "(SELECT fecha_mes, cartera_vigente AS v, lag(cartera_vigente) OVER (ORDER BY fecha_mes) AS p FROM {months}) x")
