"""KPI measures as monthly series, checked against windowed SQL."""

from __future__ import annotations

from bankmart.operators.dimension import MONTHS, SHORT_MONTHS
from bankmart.plans import galaxy, kpi
from catalog.reference import loan_sums
from catalog.registry import query

SHORT = "['" + "','".join(SHORT_MONTHS) + "']"
LONG = "['" + "','".join(MONTHS) + "']"
PAIR = "value:r previous:r diff:r"
BLANK_DIFF = ("CASE WHEN value IS NULL AND previous IS NULL THEN NULL ELSE coalesce(value, 0) - coalesce(previous, 0) END AS diff")


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"{dbl(a)} / nullif({dbl(b)}, 0)"


def series(value: str, source: str = "{months}", extra: str = "", by: str = "", default: str = "") -> str:
    """Value, previous row and difference within a slice."""
    part = f"PARTITION BY {by} " if by else ""
    lag = f"lag(value) OVER ({part}ORDER BY fecha_mes)"
    lag = f"coalesce({lag}, {default})" if default else lag
    return (f"SELECT *, {BLANK_DIFF} FROM (SELECT *, {lag} AS previous FROM (SELECT *, {value} AS value{extra} FROM {source}) v) p")


# --- anchor and portfolio ----------------------------------------------------------------

query("kpi_as_of", "as_of:s", lambda t: kpi.as_of(t.mart_income), "SELECT max(fecha_mes) AS as_of FROM {mart_income}")
query("kpi_as_of_balance", "as_of:s", lambda t: kpi.as_of(t.mart_balance), "SELECT max(fecha_mes) AS as_of FROM {mart_balance}")
query("kpi_prev_month", "segmento:s fecha_mes:s portfolio:m previous:m diff:m",
      lambda t: kpi.with_previous(kpi.loan_months(t.mart_credits, ["segmento"]), "portfolio", ["segmento"]),
      "SELECT segmento, fecha_mes, portfolio, previous, portfolio - coalesce(previous, 0) AS diff FROM (SELECT *, lag(portfolio) OVER "
      "(PARTITION BY segmento ORDER BY fecha_mes) AS previous FROM (SELECT segmento, fecha_corte AS fecha_mes, sum(saldo_capital) AS portfolio "
      "FROM {mart_credits} GROUP BY 1, 2) a) b")
query("kpi_loan_balance", "zona_geografica:s portfolio:m",
      lambda t: kpi.kpi_loan_balance(t.mart_credits, ["zona_geografica"]),
      "SELECT zona_geografica, sum(saldo_capital) AS portfolio FROM {mart_credits} GROUP BY 1")
query("kpi_loan_counts", "segmento:s n_loans:n", lambda t: kpi.kpi_loan_counts(t.mart_credits, ["segmento"]),
      "SELECT segmento, count(DISTINCT id_credito) AS n_loans FROM {mart_credits} GROUP BY 1")
query("kpi_loan_counts_payments", "n_loans:n", lambda t: kpi.kpi_loan_counts(t.mart_payments),
      "SELECT count(DISTINCT id_credito) AS n_loans FROM {payments}")
query("kpi_portfolio_by_rating", "segmento:s in_arrears:m performing:m",
      lambda t: kpi.kpi_portfolio_by_rating(t.mart_credits, ["segmento"]),
      f"SELECT segmento, in_arrears, performing FROM ({loan_sums('segmento')}) s")
query("kpi_portfolio_by_rating_last_month", "segmento:s fecha_mes:s portfolio:m in_arrears:m performing:m",
      lambda t: kpi.at_last_month(kpi.loan_months(t.mart_credits, ["segmento"]), t.mart_income),
      f"SELECT segmento, fecha_corte AS fecha_mes, portfolio, in_arrears, performing FROM ({loan_sums('segmento, fecha_corte')}) s "
      "WHERE fecha_corte = (SELECT max(fecha_mes) FROM {mart_income})")
query("kpi_portfolio_by_disbursement", "fecha_mes:s portfolio:m in_arrears:m performing:m",
      lambda t: kpi.loan_months(t.mart_credits, date_col="fecha_desembolso"),
      "SELECT month AS fecha_mes, portfolio, in_arrears, performing FROM ("
      + loan_sums("month", "(SELECT last_day(fecha_desembolso) AS month, * FROM {mart_credits})") + ") s")

# --- profitability -----------------------------------------------------------------------

for name, base in [("roe", "total_patrimonio"), ("roa", "total_activos")]:
    query(f"kpi_{name}", f"fecha_mes:s net_income:m base:m {PAIR}",
          lambda t, base=base: kpi.kpi_return(t.months, base),
          series(div("utilidad_neta", base), extra=f", utilidad_neta AS net_income, {base} AS base"))
    query(f"kpi_{name}_last_month", f"fecha_mes:s {PAIR}",
          lambda t, base=base: kpi.at_last_month(kpi.kpi_return(t.months, base), t.mart_income),
          f"SELECT * FROM ({series(div('utilidad_neta', base))}) z WHERE fecha_mes = (SELECT max(fecha_mes) FROM {{mart_income}})")
ASSETS = ("(SELECT *, coalesce(cartera_bruta, 0) + coalesce(inversiones, 0) + coalesce(operaciones_interbancarias_activo, 0) AS assets FROM {months})")
NIM_SOURCE = f"(SELECT *, (assets + coalesce(lag(assets) OVER (ORDER BY fecha_mes), 0)) / 2 AS assets_mean FROM {ASSETS} a)"
query("kpi_nim", f"fecha_mes:s margin:m assets:m assets_mean:q {PAIR}", lambda t: kpi.kpi_nim(t.months),
      series(div("margen_financiero_bruto", "assets_mean"), NIM_SOURCE, ", margen_financiero_bruto AS margin", default="0"))

# --- stored indices ----------------------------------------------------------------------

for name, column in [("arrears_index", "tasa_mora_pct_t1"), ("coverage", "cobertura_provision_pct_t1"),
                     ("liquidity", "indice_liquidez_pct"), ("solvency", "indice_solvencia_pct")]:
    query(f"kpi_{name}", f"fecha_mes:s {PAIR}",
          lambda t, column=column: kpi.kpi_index(t.months, column), series(column))
BAND = "CASE WHEN {c} < 14 THEN 'low' WHEN {c} < 23 THEN 'alert' WHEN {c} <= 35 THEN 'optimal' WHEN {c} > 35 THEN 'high' END"
query("kpi_status_band", "fecha_mes:s liquidity:m liquidity_status:s solvency:m solvency_status:s",
      lambda t: kpi.kpi_status(t.months),
      f"SELECT fecha_mes, indice_liquidez_pct AS liquidity, {BAND.replace('{c}', 'indice_liquidez_pct')} AS liquidity_status, "
      f"indice_solvencia_pct AS solvency, {BAND.replace('{c}', 'indice_solvencia_pct')} AS solvency_status FROM {{months}}")
for name, column, good in [("kpi_direction", "indice_liquidez_pct", ">"), ("kpi_direction_inverse", "tasa_mora_pct_t1", "<")]:
    query(name, f"fecha_mes:s {PAIR} trend:s good:n",
          lambda t, column=column, good=good: kpi.kpi_direction(
              kpi.kpi_index(t.months, column), "value", good == ">"),
          f"SELECT *, CASE WHEN diff > 0 THEN 'up' ELSE 'down' END AS trend, coalesce(diff {good} 0, FALSE) AS good FROM ({series(column)}) d")

# --- loan risk ---------------------------------------------------------------------------

RATE = div("coalesce(in_arrears, 0)", "portfolio")
for name, by in [("kpi_arrears_rate", "segmento"), ("kpi_arrears_rate_zone", "zona_geografica"),
                 ("kpi_arrears_rate_officer", "oficial_credito")]:
    query(name, f"{by}:s fecha_mes:s portfolio:m in_arrears:m performing:m arrears_rate:r previous:r diff:r",
          lambda t, by=by: kpi.kpi_arrears_rate(kpi.loan_months(t.mart_credits, [by]), [by]),
          f"SELECT *, value AS arrears_rate FROM ({series(RATE, f'(SELECT *, fecha_corte AS fecha_mes FROM ({loan_sums(f'{by}, fecha_corte')}) s)', by=by)}) z")
SLICED = " UNION ALL ".join(
    f"SELECT '{name}' AS slice, CAST({c or 'NULL'} AS STRING) AS slice_value, fecha_corte AS fecha_mes, * EXCLUDE ({f'{c}, ' if c else ''}fecha_corte) "
    f"FROM ({loan_sums(f'{c}, fecha_corte' if c else 'fecha_corte')}) s"
    for name, c in [*kpi.SLICES.items(), ("total", None)])
query("kpi_arrears_all_slices", "slice:s slice_value:s fecha_mes:s portfolio:m in_arrears:m performing:m arrears_rate:r previous:r diff:r",
      lambda t: kpi.kpi_arrears_rate(kpi.slice_months(t.mart_credits), ["slice", "slice_value"]),
      f"SELECT *, value AS arrears_rate FROM ({series(RATE, f'({SLICED})', by='slice, slice_value')}) z")
STAR = "producto_crediticio"
query("kpi_arrears_rate_star", f"{STAR}:s fecha_mes:s portfolio:m in_arrears:m performing:m arrears_rate:r previous:r diff:r",
      lambda t: kpi.kpi_arrears_rate(kpi.loan_months(galaxy.star_credits(
          galaxy.fact_credits(t.staged_credits, t.dim_customer, t.dim_rating, t.dim_product),
          t.dim_customer, t.dim_rating, t.dim_product), [STAR]), [STAR]),
      f"SELECT *, value AS arrears_rate FROM ({series(RATE, f'(SELECT *, fecha_corte AS fecha_mes FROM ({loan_sums(f"{STAR}, fecha_corte")}) s)', by=STAR)}) z")
query("kpi_coverage_manual", "fecha_mes:s provisions:m in_arrears:m value:r",
      lambda t: kpi.kpi_coverage_manual(t.loan_months),
      f"SELECT *, {div('provisions', 'in_arrears')} AS value FROM {{loan_months}}")
query("kpi_risk_coverage", "fecha_mes:s in_arrears:m provisions:m value:r",
      lambda t: kpi.kpi_risk_coverage(t.loan_months),
      f"SELECT *, coalesce({div('in_arrears', 'provisions')}, 0) AS value FROM {{loan_months}}")
query("kpi_cost_of_risk", f"fecha_mes:s provisions:m portfolio:m {PAIR}",
      lambda t: kpi.kpi_cost_of_risk(t.loan_months),
      series(f"coalesce({div('provisions', 'portfolio')}, 0)", "{loan_months}"))
query("kpi_cost_of_risk_average", f"fecha_mes:s provisions:m portfolio:m {PAIR}",
      lambda t: kpi.kpi_cost_of_risk(t.loan_months, mode="average"),
      series("coalesce(CAST(provisions AS DOUBLE) / nullif(avg(CAST(portfolio AS DOUBLE)) OVER (ORDER BY fecha_mes ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0), 0)",
             "{loan_months}"))
query("kpi_expected_loss", "fecha_mes:s expected_loss:m", lambda t: kpi.kpi_expected_loss(t.loan_months),
      "SELECT fecha_mes, expected_loss FROM {loan_months}")
query("kpi_expected_loss_product", "producto_crediticio:s tipo_garantia:s fecha_mes:s expected_loss:m",
      lambda t: kpi.kpi_expected_loss(
          kpi.loan_months(t.mart_credits, ["producto_crediticio", "tipo_garantia"]),
          ["producto_crediticio", "tipo_garantia"]),
      f"SELECT *, fecha_corte AS fecha_mes FROM ({loan_sums('producto_crediticio, tipo_garantia, fecha_corte')}) s")

# --- trailing windows --------------------------------------------------------------------

TRAIL = ("SELECT a.fecha_mes, {agg} AS value FROM {{months}} a JOIN {{months}} b ON (year(b.fecha_mes) * 12 + month(b.fecha_mes)) "
         "BETWEEN (year(a.fecha_mes) * 12 + month(a.fecha_mes)) - 11 AND (year(a.fecha_mes) * 12 + month(a.fecha_mes)) GROUP BY a.fecha_mes")
query("kpi_provisions_12m", "fecha_mes:s value:m", lambda t: kpi.kpi_provisions_12m(t.mart_income),
      TRAIL.format(agg="sum(b.gasto_provisiones_periodo)"))
query("kpi_portfolio_avg_12m", "fecha_mes:s value:q", lambda t: kpi.kpi_portfolio_avg_12m(t.months),
      TRAIL.format(agg="avg(CAST(b.cartera_bruta AS DOUBLE))"))

# --- charts ------------------------------------------------------------------------------

query("kpi_portfolio_series", "ano:n mes:n gross:m performing:m gross_max:m",
      lambda t: kpi.kpi_portfolio_series(t.months),
      "SELECT year(fecha_mes) AS ano, month(fecha_mes) AS mes, sum(cartera_bruta) AS gross, sum(cartera_vigente) AS performing, max(cartera_bruta) AS gross_max FROM {months} GROUP BY 1, 2")
query("kpi_portfolio_series_quarter", "ano:n trimestre:s gross:m performing:m gross_max:m",
      lambda t: kpi.kpi_portfolio_series(t.months, "quarter"),
      "SELECT year(fecha_mes) AS ano, concat('T', quarter(fecha_mes)) AS trimestre, sum(cartera_bruta) AS gross, sum(cartera_vigente) AS performing, max(cartera_bruta) AS gross_max FROM {months} GROUP BY 1, 2")
for name, column in [("kpi_extremes_year", "cartera_bruta"), ("kpi_extremes_year_performing", "cartera_vigente")]:
    query(name, "fecha_mes:s value:m is_max:n is_min:n",
          lambda t, column=column: kpi.kpi_extremes_year(t.months, column),
          f"SELECT fecha_mes, value, value = hi AS is_max, value = lo AS is_min FROM (SELECT fecha_mes, {column} AS value, max({column}) OVER () AS hi, "
          f"min({column}) OVER () AS lo FROM {{months}} WHERE year(fecha_mes) = (SELECT max(year(fecha_mes)) FROM {{months}})) x WHERE value = hi OR value = lo")
for name, column, grain, label in [
    ("kpi_extremes_period", "cartera_bruta", "month", f"{SHORT}[month(fecha_mes)]"),
    ("kpi_extremes_period_quarter", "cartera_bruta", "quarter", "concat('T', quarter(fecha_mes))"),
    ("kpi_extremes_period_performing", "cartera_vigente", "month", f"{SHORT}[month(fecha_mes)]"),
]:
    query(name, "period:s total:m is_max:n is_min:n",
          lambda t, column=column, grain=grain: kpi.kpi_extremes_period(t.months, column, grain),
          f"SELECT period, total, total = hi AS is_max, total = lo AS is_min FROM (SELECT *, max(total) OVER () AS hi, min(total) OVER () AS lo FROM "
          f"(SELECT {label} AS period, sum({column}) AS total FROM {{months}} GROUP BY 1) a) b WHERE total = hi OR total = lo")
for name, grain, label in [("kpi_period_param", "month", f"{LONG}[month(fecha_mes)]"),
                           ("kpi_period_param_quarter", "quarter", "concat('T', quarter(fecha_mes))")]:
    query(name, "fecha_mes:s period:s", lambda t, grain=grain: kpi.kpi_period_param(t.mart_income, grain),
          f"SELECT fecha_mes, {label} AS period FROM {{months}}")

# --- write-offs --------------------------------------------------------------------------

query("kpi_writeoffs", "fecha_mes:s value:m previous:m diff:m", lambda t: kpi.kpi_writeoffs(t.mart_income),
      series("castigos_periodo"))
REFERENCE = ("(SELECT ano, (SELECT avg(CAST(castigos_periodo AS DOUBLE)) FROM {months} WHERE year(fecha_mes) < ano) AS mean_earlier, "
             "(SELECT CAST(sum(castigos_periodo) AS DOUBLE) FROM {months} WHERE year(fecha_mes) = ano - 1) AS last_year FROM "
             "(SELECT DISTINCT year(fecha_mes) AS ano FROM {months}) y)")
query("kpi_writeoff_reference", "ano:n mean_earlier:q per_month:q per_quarter:q",
      lambda t: kpi.kpi_writeoff_reference(t.mart_income),
      f"SELECT ano, mean_earlier, last_year / 12 AS per_month, last_year / 4 AS per_quarter FROM {REFERENCE} r")
for name, grain, period, parts in [("kpi_writeoff_alert", "month", "CAST(month(fecha_mes) AS STRING)", 12),
                                   ("kpi_writeoff_alert_quarter", "quarter", "concat('T', quarter(fecha_mes))", 4)]:
    query(name, "ano:n period:s writeoffs:m reference:q mean_earlier:q over_last_year:n over_mean:n",
          lambda t, grain=grain: kpi.kpi_writeoff_alert(t.mart_income, grain),
          f"SELECT w.ano, period, writeoffs, last_year / {parts} AS reference, mean_earlier, writeoffs > coalesce(last_year / {parts}, 0) AS over_last_year, "
          f"writeoffs > coalesce(mean_earlier, 0) AS over_mean FROM (SELECT year(fecha_mes) AS ano, {period} AS period, sum(castigos_periodo) AS writeoffs "
          f"FROM {{months}} GROUP BY 1, 2) w JOIN {REFERENCE} r ON w.ano = r.ano")

# --- scorecard ---------------------------------------------------------------------------

GENERAL_SUMS = ("(SELECT sum(total_patrimonio) AS eq, sum(total_activos) AS ac, sum(tasa_mora_pct_t1) AS mo, sum(cobertura_provision_pct_t1) AS co, "
                "sum(indice_liquidez_pct) AS li, sum(indice_solvencia_pct) AS so FROM {mart_balance})")
query("kpi_general", "roe:r roa:r arrears:m coverage:m cost_of_risk:r risk_coverage:r liquidity:m solvency:m writeoffs:m",
      lambda t: kpi.kpi_general(t.mart_income, t.mart_balance, t.mart_credits),
      f"SELECT {div('net', 'eq')} AS roe, {div('net', 'ac')} AS roa, mo AS arrears, co AS coverage, {div('provisions', 'portfolio')} AS cost_of_risk, "
      f"{div('in_arrears', 'provisions')} AS risk_coverage, li AS liquidity, so AS solvency, writeoffs FROM (SELECT sum(utilidad_neta) AS net, "
      f"sum(castigos_periodo) AS writeoffs FROM {{mart_income}}) i, {GENERAL_SUMS} b, ({loan_sums('')}) l")

CARDS = {
    "roe": (div("utilidad_neta", "total_patrimonio"), ">", False), "roa": (div("utilidad_neta", "total_activos"), ">", False),
    "nim": (div("margen_financiero_bruto", "assets_mean"), ">", False), "liquidity": ("indice_liquidez_pct", ">", True),
    "solvency": ("indice_solvencia_pct", ">", True), "arrears": ("tasa_mora_pct_t1", "<", False),
    "coverage": ("cobertura_provision_pct_t1", ">", False), "cost_of_risk": (f"coalesce({div('provisions', 'portfolio')}, 0)", "<", False),
}
CARD_SOURCE = f"(SELECT n.*, l.portfolio, l.provisions FROM {NIM_SOURCE} n LEFT JOIN {{loan_months}} l ON n.fecha_mes = l.fecha_mes)"
CARD_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS kpi, fecha_mes, CAST(value AS DOUBLE) AS value, CAST(previous AS DOUBLE) AS previous, CAST(diff AS DOUBLE) AS diff, "
    f"CASE WHEN diff > 0 THEN 'up' ELSE 'down' END AS trend, coalesce(diff {good} 0, FALSE) AS good, "
    f"{BAND.replace('{c}', 'value') if band else 'CAST(NULL AS STRING)'} AS status FROM "
    f"({series(f'CAST({value} AS DOUBLE)', CARD_SOURCE, default='0' if name == 'nim' else '')}) c_{name}"
    for name, (value, good, band) in CARDS.items()
)
CARD_FORM = f"kpi:s fecha_mes:s {PAIR} trend:s good:n status:s"
query("kpi_scorecard_series", CARD_FORM,
      lambda t: kpi.scorecard_series(t.mart_income, t.mart_balance, t.mart_credits), CARD_SQL)
query("kpi_scorecard", CARD_FORM,
      lambda t: kpi.kpi_scorecard(t.mart_income, t.mart_balance, t.mart_credits),
      f"SELECT * FROM ({CARD_SQL}) s WHERE fecha_mes = (SELECT max(fecha_mes) FROM {{mart_income}})")
query("kpi_scorecard_month", CARD_FORM,
      lambda t: kpi.kpi_scorecard(t.mart_income, t.mart_balance, t.mart_credits, "1999-06-30"),
      f"SELECT * FROM ({CARD_SQL}) s WHERE fecha_mes = DATE '1999-06-30'")
