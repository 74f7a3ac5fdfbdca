"""Sources and sinks, dimensions, facts, calendar and load checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bankmart import schemas as S
from bankmart.functions import as_day
from bankmart.operators import dimension as D
from bankmart.operators.clean import instalments
from bankmart.operators.keys import row_count_check
from bankmart.plans import galaxy as G, marts
from bankmart.sources import in_rounds, mart_view, read_raw, staging_root, write_table
from catalog.cleaning import forms
from catalog.registry import query

# --- sources and sinks -------------------------------------------------------------------


def csv_round_trip(t):
    """Write the raw customers as the CSV files a source system delivers, and read them."""
    path = f"{staging_root(t.spark)}/raw-customers-{uuid.uuid4().hex}"
    keep = {"nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    t.customers.select(*S.RAW_COLUMNS["customers"]).write.options(**keep).csv(path, header=True)
    return read_raw(t.spark, path, "customers")


query("read_raw", " ".join(f"{c}:s" for c in S.RAW_COLUMNS["customers"]), csv_round_trip,
      "SELECT * FROM {customers}")
query("mart_view", "segmento:s n:n portfolio:m",
      lambda t: mart_view("mart_credits", t.mart_credits).groupBy("segmento").agg(
          F.count("*").alias("n"), F.sum("saldo_capital").alias("portfolio")),
      "SELECT segmento, count(*) AS n, sum(saldo_capital) AS portfolio FROM {mart_credits} GROUP BY segmento")


def table_rewrite(t):
    path = f"{staging_root(t.spark)}/payments-{uuid.uuid4().hex}"
    found = instalments(t.payments, t.loans) if t.rounds > 1 else None
    # Whole months go to a round, so that a round of the written table needs no rows of another.
    months = in_rounds(t.payments, [F.last_day(as_day("fecha_vencimiento_cuota"))], t.rounds)
    typed = [marts.mart_payments(part, t.loans, found).withColumn("mes", F.last_day("fecha_vencimiento_cuota"))
             for part in months]
    return write_table(typed, path, ["mes"]).groupBy("mes").agg(
        F.count("*").alias("n"), F.sum("monto_pagado").alias("paid"))


query("write_table", "mes:s n:n paid:m", table_rewrite,
      "SELECT last_day(fecha_vencimiento_cuota) AS mes, count(*) AS n, sum(monto_pagado) AS paid FROM {mart_payments} GROUP BY 1")
query("row_count_check", "n_before:n n_after:n diff:n",
      lambda t: row_count_check(t.balance, t.mart_balance),
      "SELECT b AS n_before, a AS n_after, a - b AS diff FROM (SELECT (SELECT count(*) FROM {balance}) AS b, (SELECT count(*) FROM {mart_balance}) AS a) x")
query("row_count_check_payments", "n_before:n n_after:n diff:n",
      lambda t: row_count_check(
          t.staged_payments, G.fact_payments(t.staged_payments, t.dim_customer, t.dim_rating, t.dim_state)),
      "SELECT b AS n_before, a AS n_after, a - b AS diff FROM (SELECT (SELECT count(*) FROM {mart_payments}) AS b, (SELECT count(*) FROM {fact_payments}) AS a) x")
query("row_count_check_customers", "n_before:n n_after:n diff:n",
      lambda t: row_count_check(
          t.staged_customers, G.fact_customers(t.staged_customers, t.dim_customer, t.dim_status, t.dim_rating)),
      "SELECT b AS n_before, a AS n_after, a - b AS diff FROM (SELECT (SELECT count(*) FROM {mart_customers}) AS b, (SELECT count(*) FROM {fact_customers}) AS a) x")
query("row_count_check_credits", "n_before:n n_after:n diff:n",
      lambda t: row_count_check(
          t.staged_credits, G.fact_credits(t.staged_credits, t.dim_customer, t.dim_rating, t.dim_product)),
      "SELECT b AS n_before, a AS n_after, a - b AS diff FROM (SELECT (SELECT count(*) FROM {mart_credits}) AS b, (SELECT count(*) FROM {fact_credits}) AS a) x")

# --- dimensions --------------------------------------------------------------------------

SIX = " ".join(f"{c}:s" for c in S.CUSTOMER_KEYS)
query("dim_customer", "id_cliente_PK:n " + SIX, lambda t: t.dim_customer, "SELECT * FROM {dim_customer}")
query("dim_customer_latest", "id_cliente_PK:n " + SIX,
      lambda t: G.dim_customer(t.mart_credits, latest_only=True),
      f"SELECT row_number() OVER (ORDER BY id_cliente) AS id_cliente_PK, {', '.join(S.CUSTOMER_KEYS)} FROM (SELECT *, row_number() OVER "
      "(PARTITION BY id_cliente ORDER BY fecha_corte DESC, id_credito DESC) AS rn FROM {mart_credits}) x WHERE rn = 1")
query("dim_status", "id_status_t5:n es_cliente_preferente:n tiene_credito_en_mora:n",
      lambda t: G.dim_status(t.mart_customers), "SELECT * FROM {dim_status}")
query("dim_rating", "id_calificacion_sk:n calificacion:s",
      lambda t: G.dim_rating(t.mart_credits, t.mart_customers, t.mart_payments), "SELECT * FROM {dim_rating}")
query("dim_product", "id_producto_PK:n producto_crediticio:s tipo_garantia:s",
      lambda t: G.dim_product(t.mart_credits), "SELECT * FROM {dim_product}")
query("dim_payment_state", "id_estado_PK:n estado_pago:s canal_pago:s",
      lambda t: G.dim_payment_state(t.mart_payments), "SELECT * FROM {dim_state}")
query("surrogate_key", "key:n id_pago:s fecha_vencimiento_cuota:s monto_pagado:s",
      lambda t: D.surrogate_key(
          t.payments.select("id_pago", "fecha_vencimiento_cuota", "monto_pagado").distinct(),
          ["id_pago", "fecha_vencimiento_cuota", "monto_pagado"], "key"),
      "SELECT row_number() OVER (ORDER BY id_pago NULLS FIRST, fecha_vencimiento_cuota NULLS FIRST, monto_pagado NULLS FIRST) AS key, * "
      "FROM (SELECT DISTINCT id_pago, fecha_vencimiento_cuota, monto_pagado FROM {payments}) x")
CALENDAR = "fecha:s ano:n mes:n nombre_mes:s mes_corto:s trimestre:s ano_mes:s"
NAMES = "['" + "','".join(D.MONTHS) + "']"
SHORT = "['" + "','".join(D.SHORT_MONTHS) + "']"
query("dim_calendar", CALENDAR, lambda t: D.calendar_of(
          t.given("orders").select(F.col("o_orderdate").cast("date").alias("fecha")), "fecha"),
      f"SELECT fecha, year(fecha) AS ano, month(fecha) AS mes, {NAMES}[month(fecha)] AS nombre_mes, {SHORT}[month(fecha)] AS mes_corto, "
      "concat('T', quarter(fecha)) AS trimestre, strftime(fecha, '%Y-%m') AS ano_mes FROM (SELECT CAST(unnest(generate_series("
      "date_trunc('year', lo)::DATE, (date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE, INTERVAL 1 DAY)) AS DATE) AS fecha FROM "
      "(SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM {orders}) b) d")

# --- facts -------------------------------------------------------------------------------

LOAN_FACT = {c: k for c, k in S.LOAN_TYPES.items() if c not in G.LOAN_ATTRIBUTES}
query("fact_credits", forms(LOAN_FACT) + " id_cliente_PK:n id_calificacion_sk:n id_producto_PK:n",
      lambda t: G.fact_credits(t.staged_credits, t.dim_customer, t.dim_rating, t.dim_product),
      "SELECT * FROM {fact_credits}")
PAY_FORMS = {**S.PAYMENT_TYPES, **{c: "int" for c in ("id_calificacion_sk", "id_estado_PK", "id_cliente_PK")}}
query("fact_payments", forms({c: PAY_FORMS[c] for c in G.PAYMENT_FACT}),
      lambda t: G.fact_payments(t.staged_payments, t.dim_customer, t.dim_rating, t.dim_state),
      "SELECT * FROM {fact_payments}")
CUST_FORMS = {**S.CUSTOMER_TYPES, "es_cliente_preferente": "int", "tasa_endeudamiento_sistema_pct": S.RATE,
              **{c: "int" for c in ("id_cliente_PK", "id_status_t5", "id_calificacion_sk")}}
query("fact_customers", forms({c: CUST_FORMS[c] for c in G.CUSTOMER_FACT}, tasa_endeudamiento_sistema_pct="r"),
      lambda t: G.fact_customers(t.staged_customers, t.dim_customer, t.dim_status, t.dim_rating),
      "SELECT * FROM {fact_customers}")
query("fact_income", "fecha_mes:s " + " ".join(f"{c}:q" for c in G.INCOME_FACT[1:]),
      lambda t: G.fact_income(t.mart_income), "SELECT * FROM {mart_income}")
query("fact_balance", "fecha_mes:s " + " ".join(f"{c}:{'q' if c == 'aporte_cosede' else 'm'}" for c in G.BALANCE_FACT[1:]),
      lambda t: G.fact_balance(t.mart_balance), "SELECT * FROM {mart_balance}")
for role in ("fecha_desembolso", "fecha_vencimiento", "fecha_corte"):
    query("role_date_join" if role == "fecha_corte" else f"role_date_join_{role}", "ano_mes:s portfolio:m",
          lambda t, role=role: D.role_date_sum(
              t.mart_credits, D.calendar_of(t.mart_credits, role), role, "ano_mes",
              {"portfolio": F.col("saldo_capital")}),
          f"SELECT strftime({role}, '%Y-%m') AS ano_mes, sum(saldo_capital) AS portfolio FROM {{mart_credits}} GROUP BY 1")
for table, role, measure in (
    ("mart_payments", "fecha_pago_real", "monto_pagado"),
    ("mart_payments", "fecha_vencimiento_cuota", "monto_pagado"),
    ("mart_customers", "fecha_primer_credito", "saldo_total_deuda"),
):
    query(f"role_date_join_{role}", "ano_mes:s amount:m",
          lambda t, table=table, role=role, measure=measure: D.role_date_sum(
              getattr(t, table), D.calendar_of(getattr(t, table), role), role, "ano_mes",
              {"amount": F.col(measure)}),
          f"SELECT strftime({role}, '%Y-%m') AS ano_mes, sum({measure}) AS amount FROM {{{table}}} WHERE {role} IS NOT NULL GROUP BY 1")
query("fk_coverage", "fk:s rows:n n_null:n null_share:r",
      lambda t: D.fk_coverage(
          G.fact_payments(t.staged_payments, t.dim_customer, t.dim_rating, t.dim_state),
          ["id_cliente_PK", "id_calificacion_sk", "id_estado_PK"]),
      " UNION ALL ".join(
          f"SELECT '{k}' AS fk, count(*) AS rows, count(*) FILTER (WHERE {k} IS NULL) AS n_null, "
          f"count(*) FILTER (WHERE {k} IS NULL) / count(*) AS null_share FROM {{fact_payments}}"
          for k in ("id_cliente_PK", "id_calificacion_sk", "id_estado_PK")))
