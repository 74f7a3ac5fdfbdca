"""One-scan audit reports of the raw tables, and the frequencies of their values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from bankmart import schemas as S
from bankmart.plans import audits
from catalog.quality import AS_OF
from catalog.registry import query
from catalog.shapes import D2, D4, d2, d4, day, freq, invalid, plus, whole

COLUMNS = "step:s field:s metric:s value:q"
VALUES = "step:s field:s value:s freq:n"
Item = tuple[str, str, str, str]


def rows_where(step: str, tests: Mapping[str, str], metric: str = "rows") -> list[Item]:
    return [(step, f, metric, f"count(*) FILTER (WHERE {test})") for f, test in tests.items()]


def by_label(step: str, field: str, tests: Mapping[str, str]) -> list[Item]:
    return [(step, field, label, f"count(*) FILTER (WHERE {field} = '{label}' AND ({test}))") for label, test in tests.items()]


def spread(fields: Sequence[str]) -> list[Item]:
    return [("spread", f, how, f"{how}({d2(f)})") for f in fields for how in ("min", "max", "sum")]


def profiles(numeric, required, signed=None, kinds=None, kind=D4) -> list[Item]:
    kinds = kinds or {}
    return [
        ("rows", "*", "rows", "count(*)"),
        *rows_where("invalid_values", {f: f"{f} <> '' AND {d4(f)} IS NULL" for f in numeric}),
        *rows_where("missing", {f: f"coalesce({f}, '') = ''" for f in required}),
        *rows_where("negatives", {f: f"TRY_CAST({f} AS {kinds.get(f, kind)}) < 0" for f in signed or numeric}),
    ]


def report_sql(table: str, items: Sequence[Item]) -> str:
    """All aggregates in one row, then one row for each."""
    figures = ", ".join(f"CAST({agg} AS DECIMAL(34,4)) AS m{i}" for i, (*_, agg) in enumerate(items))
    rows = ", ".join(
        f"{{{{'step': '{step}', 'field': '{field}', 'metric': '{metric}', 'value': m{i}}}}}"
        for i, (step, field, metric, _) in enumerate(items))
    return f"SELECT unnest([{rows}], recursive := true) FROM (SELECT {figures} FROM {{{table}}}) figures"


def bad_dates(fields: Sequence[str]) -> list[Item]:
    return rows_where("invalid_dates", {f: f"{f} <> '' AND {day(f)} IS NULL AND {f} NOT IN ('NULL', 'NaN', 'N/A')" for f in fields})


def bands(days: str, first: str, floor: str) -> dict[str, str]:
    d = whole(days)
    return {
        "Normal": f"{d} {first}", "Potencial": f"{d} NOT BETWEEN 1 AND 15", "Deficiente": f"{d} NOT BETWEEN 16 AND 45",
        "Dudoso": f"{d} NOT BETWEEN 46 AND 90", "Pérdida": f"{d} < {floor}",
    }


def gap(reported: str, expected: str, tolerance: int) -> str:
    return f"abs({reported} - ({expected})) > {tolerance}"


RATE, SCORE = d4("tasa_nominal_anual_pct"), d2("score_crediticio")
RESULT, SHARE = d2("resultado_antes_impuestos"), d2("participacion_trabajadores_15pct")
PAID, DUE = d2("monto_pagado"), d2("cuota_pactada")
PARTS_WRONG = [f"{part}({day('fecha_mes')}) <> {whole(c)}" for part, c in (("year", "ano"), ("month", "mes"))]
WHOLE_DEBT = d2("saldo_total_deuda")

ITEMS: dict[str, list[Item]] = {
    "loans": [
        *profiles(S.LOAN_NUMERIC, S.LOAN_REQUIRED),
        *rows_where("chronology", {"fecha_vencimiento": f"{day('fecha_vencimiento')} <= {day('fecha_desembolso')} OR {day('fecha_desembolso')} > DATE '{AS_OF}'"}),
        *by_label("rating_bands", "calificacion_sbs", bands("dias_atraso", "<> 0", "90")),
        *by_label("rating_bands_strict", "calificacion_sbs", bands("dias_atraso", "<> 0", "91")),
        *rows_where("not_greater", {"saldo_capital": f"{d2('saldo_capital')} > {d2('monto_aprobado')} AND {d2('monto_aprobado')} > 0"}),
        *rows_where("out_of_range", {
            "tasa_nominal_anual_pct": f"{RATE} <= 0 OR {RATE} > 30", "score_crediticio": f"{SCORE} < 200 OR {SCORE} > 850"}),
        *by_label("policy_flags", "flag_error", {flag: "TRUE" for flag in S.POLICY_FLAGS}),
        *spread(["saldo_capital", "provision_constituida", "monto_castigado"]),
    ],
    "income": [
        *profiles(S.INCOME_NUMERIC, S.INCOME_REQUIRED, S.INCOME_SIGNED),
        *rows_where("date_parts", {"fecha_mes": " AND ".join(PARTS_WRONG)}),
        *rows_where("date_parts_any", {"fecha_mes": " OR ".join(PARTS_WRONG)}),
        *rows_where("component_sum", {c: gap(d2(c), plus(parts), 1) for c, parts in audits.INCOME_TOTALS.items()}),
        *rows_where("margins", {"margen_financiero_bruto": gap(d2("margen_financiero_bruto"), f"{d2('total_ingresos')} - {d2('total_gastos_financieros')}", 1)}),
        *rows_where("profit_share", {"participacion_trabajadores_15pct": gap(SHARE, f"CASE WHEN {RESULT} > 0 THEN {RESULT} * 0.15 ELSE 0 END", 0)}),
        *spread(["utilidad_neta", "castigos_periodo"]),
    ],
    "balance": [
        *profiles(S.BALANCE_NUMERIC, S.BALANCE_REQUIRED, S.BALANCE_SIGNED),
        *rows_where("date_parts", {"fecha_mes": " AND ".join(PARTS_WRONG)}),
        *rows_where("component_sum", {"total_patrimonio": gap(d2("total_patrimonio"), plus(S.EQUITY_PARTS), 1)}),
        *rows_where("levy", {"aporte_cosede": gap(d4("aporte_cosede"), f"CAST(CAST({d2('total_obligaciones_publico')} AS DECIMAL(28,2)) * 0.00065 / 6 AS DECIMAL(18,4))", 1)}),
        *spread(["cartera_bruta", "total_patrimonio"]),
    ],
    "payments": [
        *profiles(S.PAYMENT_NUMERIC, S.PAYMENT_REQUIRED, kinds={c: "INT" for c in S.PAYMENT_WHOLE}),
        *bad_dates(audits.PAYMENT_DATES),
        *rows_where("sign_text", {c: f"{c} LIKE '%-%'" for c in ("dias_retraso_pago", "monto_pagado")}),
        *rows_where("not_mirror", {"monto_pagado": f"{PAID} < 0 AND abs({PAID}) <> {DUE}"}),
        *rows_where("floor_zero", {"saldo_pendiente_cuota": f"{d2('saldo_pendiente_cuota')} <> CASE WHEN {DUE} - {PAID} < 0 THEN 0 ELSE {DUE} - {PAID} END"}),
        *spread(["monto_pagado", "saldo_pendiente_cuota"]),
    ],
    "customers": [
        *profiles(S.CUSTOMER_NUMERIC, S.CUSTOMER_REQUIRED, kind=D2),
        *bad_dates(audits.CUSTOMER_DATES),
        *rows_where("out_of_domain", {c: f"{c} NOT IN ({', '.join(repr(v) for v in known)})" for c, known in (
            ("sector_economico", S.SECTORS), ("zona_geografica", S.ZONES))}),
        *rows_where("out_of_range", {
            "score_crediticio": f"{SCORE} > 850", "antiguedad_cliente_meses": f"{d2('antiguedad_cliente_meses')} < 3",
            "max_dias_atraso": f"{d2('max_dias_atraso')} < 0"}),
        *by_label("rating_bands", "calificacion_consolidada", bands("max_dias_atraso", "> 0", "91")),
        *rows_where("flag_contradiction", {"tiene_credito_en_mora":
            f"({d2('saldo_mora_total')} > 0 AND {whole('tiene_credito_en_mora')} = 0) OR ({d2('saldo_mora_total')} = 0 AND "
            f"{whole('tiene_credito_en_mora')} = 1 AND {whole('max_dias_atraso')} > 0)"}),
        *rows_where("rate_recalc", {"tasa_mora_cliente_pct":
            f"{d2('tasa_mora_cliente_pct')} - coalesce({d2('saldo_mora_total')} / nullif({WHOLE_DEBT}, 0) * 100, 0) > 1"}),
        *spread(["saldo_total_deuda", "edad_empresa_anos"]),
    ],
}

for name, run in [
    ("loans", lambda t: audits.loan_report(t.loans, AS_OF)),
    ("income", lambda t: audits.income_report(t.income)),
    ("balance", lambda t: audits.balance_report(t.balance)),
    ("payments", lambda t: audits.payment_report(t.payments)),
    ("customers", lambda t: audits.customer_report(t.customers)),
]:
    query(f"dq_report_{name}", COLUMNS, run, report_sql(name, ITEMS[name]))


def values_sql(table: str, categories: Sequence[str], *faults: str) -> str:
    known = [f"SELECT 'values' AS step, '{c}' AS field, value, freq FROM ({freq(table, c)}) v" for c in categories]
    found = [f"SELECT step, field, dirty_value AS value, freq FROM ({sql}) f" for sql in faults]
    return " UNION ALL ".join([*known, *found])


def cells(table: str, step: str, field: str, where: str) -> str:
    return f"SELECT '{step}' AS step, '{field}' AS field, value AS dirty_value, freq FROM ({freq(table, field, where)}) c"


query("dq_values_loans", VALUES, lambda t: audits.loan_values(t.loans),
      values_sql("loans", audits.LOAN_CATEGORIES, invalid("loans", S.LOAN_NUMERIC, "invalid_values")))
query("dq_values_payments", VALUES, lambda t: audits.payment_values(t.payments),
      values_sql("payments", audits.PAYMENT_CATEGORIES, invalid("payments", S.PAYMENT_NUMERIC, "invalid_values"),
                 invalid("payments", audits.PAYMENT_DATES, "invalid_dates", "DATE", "'NULL', 'NaN', 'N/A'")))
query("dq_values_customers", VALUES, lambda t: audits.customer_values(t.customers),
      values_sql("customers", audits.CUSTOMER_CATEGORIES, invalid("customers", S.CUSTOMER_NUMERIC, "invalid_values"),
                 cells("customers", "out_of_domain", "sector_economico", f"sector_economico NOT IN ({', '.join(repr(v) for v in S.SECTORS)})"),
                 cells("customers", "out_of_range", "score_crediticio", f"{SCORE} > 850")))
