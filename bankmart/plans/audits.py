"""The audits of each raw table as one report: see ``bankmart.operators.report``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bankmart import schemas as S
from bankmart.functions import as_decimal, as_money, as_whole, band_mismatch
from bankmart.operators import profile, rules
from bankmart.operators.report import (
    Metric, audit_report, by_label, failing, row_count, spread, value_report,
)

RATINGS = [label for label, _, _ in S.RATING_BANDS]
PAYMENT_DATES = ["fecha_vencimiento_cuota", "fecha_pago_real"]
CUSTOMER_DATES = ["fecha_primer_credito", "fecha_ultimo_corte"]
# Components of the reported totals of the income statement.
INCOME_TOTALS = {
    "total_ingresos": S.INCOME_PARTS, "total_gastos_financieros": S.COST_PARTS,
    "total_gastos_operativos": S.OPEX_PARTS,
}


def _profiles(numeric, required, signed=None, kinds=None, kind=S.RATE) -> list[Metric]:
    """Row count, invalid numbers, missing cells and negative amounts."""
    return [
        *row_count(),
        *failing("invalid_values", profile.invalid_tests(numeric)),
        *failing("missing", profile.missing_tests(required)),
        *failing("negatives", profile.negative_tests(signed or numeric, kinds, kind)),
    ]


def _gap(reported: Column, expected: Column, tolerance) -> Column:
    return F.abs(reported - expected) > tolerance


def loan_audits(as_of: str) -> list[Metric]:
    days = as_whole("dias_atraso")
    rate, score = as_decimal("tasa_nominal_anual_pct"), as_money("score_crediticio")
    return [
        *_profiles(S.LOAN_NUMERIC, S.LOAN_REQUIRED),
        *failing("chronology", {
            "fecha_vencimiento": rules.chronology_test("fecha_desembolso", "fecha_vencimiento", as_of)}),
        *by_label("rating_bands", "calificacion_sbs", RATINGS,
                  band_mismatch(F.col("calificacion_sbs"), days, open_band_floor=90)),
        *by_label("rating_bands_strict", "calificacion_sbs", RATINGS,
                  band_mismatch(F.col("calificacion_sbs"), days)),
        *failing("not_greater", {"saldo_capital": rules.not_greater_test("saldo_capital", "monto_aprobado")}),
        *failing("out_of_range", {
            "tasa_nominal_anual_pct": (rate <= 0) | (rate > 30),
            "score_crediticio": (score < 200) | (score > 850)}),
        *by_label("policy_flags", "flag_error", S.POLICY_FLAGS, F.lit(True)),
        *spread("spread", ["saldo_capital", "provision_constituida", "monto_castigado"]),
    ]


def income_audits() -> list[Metric]:
    share = rules.profit_share(as_money("resultado_antes_impuestos"))
    gross = as_money("total_ingresos") - as_money("total_gastos_financieros")
    return [
        *_profiles(S.INCOME_NUMERIC, S.INCOME_REQUIRED, S.INCOME_SIGNED),
        *failing("date_parts", {"fecha_mes": rules.date_parts_test("fecha_mes", "ano", "mes")}),
        *failing("date_parts_any", {"fecha_mes": rules.date_parts_test("fecha_mes", "ano", "mes", "any")}),
        *failing("component_sum", {
            whole: _gap(as_money(whole), rules.total(parts), 1) for whole, parts in INCOME_TOTALS.items()}),
        *failing("margins", {"margen_financiero_bruto": _gap(as_money("margen_financiero_bruto"), gross, 1)}),
        *failing("profit_share", {
            "participacion_trabajadores_15pct": _gap(as_money("participacion_trabajadores_15pct"), share, 0)}),
        *spread("spread", ["utilidad_neta", "castigos_periodo"]),
    ]


def balance_audits() -> list[Metric]:
    levy = rules.deposit_levy(as_money("total_obligaciones_publico"))
    return [
        *_profiles(S.BALANCE_NUMERIC, S.BALANCE_REQUIRED, S.BALANCE_SIGNED),
        *failing("date_parts", {"fecha_mes": rules.date_parts_test("fecha_mes", "ano", "mes")}),
        *failing("component_sum", {
            "total_patrimonio": _gap(as_money("total_patrimonio"), rules.total(S.EQUITY_PARTS), 1)}),
        *failing("levy", {"aporte_cosede": _gap(as_decimal("aporte_cosede", S.RATE), levy, 1)}),
        *spread("spread", ["cartera_bruta", "total_patrimonio"]),
    ]


def payment_audits() -> list[Metric]:
    unpaid = rules.unpaid_part("cuota_pactada", "monto_pagado")
    return [
        *_profiles(S.PAYMENT_NUMERIC, S.PAYMENT_REQUIRED, kinds={c: S.WHOLE for c in S.PAYMENT_WHOLE}),
        *failing("invalid_dates", profile.invalid_date_tests(PAYMENT_DATES)),
        *failing("sign_text", {c: F.col(c).contains("-") for c in ("dias_retraso_pago", "monto_pagado")}),
        *failing("not_mirror", {"monto_pagado": rules.not_mirror_test("monto_pagado", "cuota_pactada")}),
        *failing("floor_zero", {"saldo_pendiente_cuota": as_money("saldo_pendiente_cuota") != unpaid}),
        *spread("spread", ["monto_pagado", "saldo_pendiente_cuota"]),
    ]


def customer_audits() -> list[Metric]:
    days = as_whole("max_dias_atraso")
    score, tenure = as_money("score_crediticio"), as_money("antiguedad_cliente_meses")
    arrears = as_money("tasa_mora_cliente_pct") - rules.share_in_percent("saldo_mora_total", "saldo_total_deuda")
    return [
        *_profiles(S.CUSTOMER_NUMERIC, S.CUSTOMER_REQUIRED, kind=S.MONEY),
        *failing("invalid_dates", profile.invalid_date_tests(CUSTOMER_DATES)),
        *failing("out_of_domain", {
            "sector_economico": ~F.col("sector_economico").isin(*S.SECTORS),
            "zona_geografica": ~F.col("zona_geografica").isin(*S.ZONES)}),
        *failing("out_of_range", {
            "score_crediticio": score > 850, "antiguedad_cliente_meses": tenure < 3, "max_dias_atraso": as_money("max_dias_atraso") < 0}),
        *by_label("rating_bands", "calificacion_consolidada", RATINGS,
                  band_mismatch(F.col("calificacion_consolidada"), days, open_band_floor=91, below_first_ok=True)),
        *failing("flag_contradiction", {"tiene_credito_en_mora": rules.contradiction_test()}),
        *failing("rate_recalc", {"tasa_mora_cliente_pct": arrears > 1}),
        *spread("spread", ["saldo_total_deuda", "edad_empresa_anos"]),
    ]


def loan_report(loans: DataFrame, as_of: str) -> DataFrame:
    """``as_of`` is the day after which a payout lies in the future."""
    return audit_report(loans, loan_audits(as_of))


def income_report(income: DataFrame) -> DataFrame:
    return audit_report(income, income_audits())


def balance_report(balance: DataFrame) -> DataFrame:
    return audit_report(balance, balance_audits())


def payment_report(payments: DataFrame) -> DataFrame:
    return audit_report(payments, payment_audits())


def customer_report(customers: DataFrame) -> DataFrame:
    return audit_report(customers, customer_audits())


# --- fixed values: columns whose values the audits list --------------------------------
LOAN_CATEGORIES = ["segmento", "sector_economico", "calificacion_sbs", "producto_crediticio", "tipo_garantia", "moneda"]
PAYMENT_CATEGORIES = [
    "estado_pago", "canal_pago", "es_pago_anticipado", "calificacion_al_pago", "segmento", "oficial_credito",
    "zona_geografica", "numero_cuota",
]
CUSTOMER_CATEGORIES = [
    "tipo_persona", "segmento", "sector_economico", "zona_geografica", "num_creditos_activos",
    "num_creditos_sistema", "num_refinanciaciones", "tiene_credito_en_mora",
]


def loan_values(loans: DataFrame) -> DataFrame:
    return value_report(loans, LOAN_CATEGORIES, {"invalid_values": profile.invalid_tests(S.LOAN_NUMERIC)})


def payment_values(payments: DataFrame) -> DataFrame:
    return value_report(payments, PAYMENT_CATEGORIES, {
        "invalid_values": profile.invalid_tests(S.PAYMENT_NUMERIC),
        "invalid_dates": profile.invalid_date_tests(PAYMENT_DATES)})


def customer_values(customers: DataFrame) -> DataFrame:
    return value_report(customers, CUSTOMER_CATEGORIES, {
        "invalid_values": profile.invalid_tests(S.CUSTOMER_NUMERIC),
        "out_of_domain": {"sector_economico": ~F.col("sector_economico").isin(*S.SECTORS)},
        "out_of_range": {"score_crediticio": as_money("score_crediticio") > 850}})
