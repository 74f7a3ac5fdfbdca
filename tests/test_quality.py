from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from bankmart.functions import as_money
from bankmart.operators import domains, keys, profile, reconcile, rules
from catalog import all_queries
from tests.frames import loans, rows, text


def test_invalid_values_count_bad_cells_only(spark):
    df = text(spark, "a b", ("1", "x"), ("", "x"), (None, "2"), ("N/A", "1e3"))
    got = set(rows(profile.invalid_values(df, ["a", "b"])))
    assert got == {("invalid_values", "a", "N/A", 1), ("invalid_values", "b", "x", 2)}
    strict = profile.invalid_values(df, ["a", "b"], strict=True)
    assert ("invalid_values", "b", "1e3", 1) in rows(strict)


def test_invalid_dates_skip_words_for_missing(spark):
    df = text(spark, "d", ("NULL",), ("NaN",), ("N/A",), ("31/31/2024",), ("2024-01-31",), ("",))
    assert rows(profile.invalid_dates(df, ["d"])) == [("invalid_dates", "d", "31/31/2024", 1)]


def test_negatives_leave_clean_columns_out(spark):
    df = text(spark, "a b", ("-1", "2"), ("-2.5", "x"), ("", None))
    assert rows(profile.negatives(df, ["a", "b"])) == [("negatives", "a", 2)]


def test_missing_counts_null_and_empty(spark):
    df = text(spark, "a b", ("", "1"), (None, "1"), ("x", ""))
    assert rows(profile.missing(df, ["a", "b"])) == [
        ("missing", "a", 2, 3, Decimal("66.67")), ("missing", "b", 1, 3, Decimal("33.33"))]


def test_profiles_are_additive_over_parts(spark):
    first, second = text(spark, "a", ("-1",), ("x",)), text(spark, "a", ("-2",), ("x",), ("y",))
    whole = dict((r[2], r[3]) for r in rows(profile.invalid_values(first.union(second), ["a"])))
    assert whole == {"x": 2, "y": 1}


def test_empty_table_has_no_percentages(spark):
    df = text(spark, "a", ("x",)).where("false")
    assert rows(profile.missing(df, ["a"])) == [("missing", "a", 0, 0, None)]


def test_top_missing_orders_by_number_not_text(spark):
    df = text(spark, "id c m", ("1", None, "9"), ("2", "", "100"), ("3", "web", "500"), ("4", None, "-1"))
    assert rows(profile.top_missing(df, "c", "m", ["id"], k=2)) == [("2",), ("1",)]


def test_duplicates_and_uniqueness(spark):
    df = text(spark, "k v", ("a", "1"), ("a", "2"), ("b", "3"))
    dup = keys.duplicate_keys(df, ["k"], {"s": F.sum(as_money("v"))})
    assert rows(dup) == [("a", 2, Decimal("3.00"))]
    assert rows(keys.uniqueness(df, "k")) == [(3, 2, 1)]
    assert rows(keys.uniqueness(df, "k", approx=True)) == [(3, 2, 1)]


def test_row_count_check_of_empty_tables(spark):
    df = text(spark, "k", ("a",))
    assert rows(keys.row_count_check(df, df.where("false"))) == [(1, 0, -1)]
    assert rows(keys.row_count_check(df.where("false"), df.where("false"))) == [(0, 0, 0)]


def test_domain_ignores_null(spark):
    df = text(spark, "c", ("x",), (None,), ("y",))
    assert rows(domains.out_of_domain(df, "c", ["x"])) == [("y", 1)]


def test_range_is_numeric(spark):
    df = text(spark, "s", ("9",), ("1000",), ("abc",))
    assert rows(domains.out_of_range(df, "s", high=850)) == [("1000", 1)]
    assert rows(domains.out_of_range(df, "s", low=10, form="count")) == [(1,)]


def test_chronology_needs_a_reference_date(spark):
    df = text(spark, "id s e", ("1", "2024-01-01", "2024-01-01"), ("2", "2024-06-01", "2025-01-01"),
              ("3", "2024-01-01", "2025-01-01"), ("4", "", "2025-01-01"))
    assert [r[0] for r in rows(rules.chronology(df, "s", "e", "2024-03-31", ["id"]))] == ["1", "2"]


@pytest.mark.parametrize("mode, found", [("all", ["2"]), ("any", ["2", "3"])])
def test_date_parts_modes(spark, mode, found):
    df = text(spark, "d y m", ("2024-01-31", "2024", "1"), ("2024-01-31", "2023", "2"), ("2024-01-31", "2024", "3"))
    got = rows(rules.date_parts(df, "d", "y", "m", mode))
    assert sorted(r[1] for r in got) == [f for f in found]


def test_rating_band_floor_of_each_source(spark):
    df = text(spark, "r d", ("Pérdida", "90"), ("Pérdida", "89"), ("Normal", "-1"), ("Dudoso", "90"), ("Vigente", "99"))
    loose = rules.rating_band_rows(df, "r", "d", open_band_floor=90)
    assert rows(loose) == [("Pérdida", "89"), ("Normal", "-1")]
    strict = rules.rating_band_rows(df, "r", "d", strict=True)
    assert rows(strict) == [("Pérdida", "90"), ("Pérdida", "89"), ("Normal", "-1")]
    customers = rules.rating_band_rows(df, "r", "d", open_band_floor=91, below_first_ok=True)
    assert rows(customers) == [("Pérdida", "90"), ("Pérdida", "89")]


def test_recorded_equity_case(spark):
    """Reported -3,007,840.36 against components of 37,598,004.45."""
    df = text(spark, "m t a b", ("2024-09-30", "-3007840.36", "37000000.00", "598004.45"))
    got = rows(rules.component_sum(df, "t", ["a", "b"], ["m"], tolerance=1))
    assert got == [("2024-09-30", Decimal("-3007840.36"), Decimal("37598004.45"), Decimal("-40605844.81"))]


def test_missing_part_makes_total_missing(spark):
    df = text(spark, "m t a b", ("1", "5", "5", None))
    assert rows(rules.component_sum(df, "t", ["a", "b"], ["m"], tolerance=1)) == []
    assert rows(rules.component_sum(df, "t", ["a", "b"], ["m"]))[0][2] is None


def test_levy_without_the_divisor_is_flagged(spark):
    df = text(spark, "v r", ("6000000.00", "650.0000"), ("6000000.00", "3900.0000"))
    got = rules.gap_audit(df, F.col("r").cast("decimal(18,4)"),
                          rules.deposit_levy(F.col("v").cast("decimal(18,2)")), [], label_below=1)
    assert [r["status"] for r in got.collect()] == ["CORRECTO", "ERROR_CALCULO"]


def test_signed_formula_reports_positive_gaps_only(spark):
    df = spark.createDataFrame([(5, 3), (3, 5)], "r int, e int")
    got = rules.gap_audit(df, F.col("r"), F.col("e"), [], tolerance=0, signed=True)
    assert rows(got) == [(5, 3, 2)]


def test_rate_recalc_with_zero_debt(spark):
    df = text(spark, "r p w", ("10", "5", "0"), ("50", "5", "10"))
    assert rows(rules.rate_recalc(df, "r", "p", "w")) == [(Decimal("10.00"), Decimal("0"), Decimal("10.00"))]


def test_cross_sum_counts_no_loans_as_zero(spark):
    monthly = text(spark, "fecha_mes v", ("2024-01-31", "100"), ("2024-02-29", "50"), ("2024-03-31", "0.5"))
    panel = loans(spark, {"monto_castigado": "60"}, {"monto_castigado": "40"})
    got = rows(reconcile.cross_sum(monthly, panel, "v", "monto_castigado"))
    assert [(str(r[0]), r[3]) for r in got] == [("2024-02-29", Decimal("50.00"))]
    assert rows(reconcile.cross_sum_exact(monthly, panel, "v", "monto_castigado")) == []


def test_mismatch_summary_agrees_with_pairs(spark):
    paid = text(spark, "id_credito cuota_pactada", ("a", "1"), ("a", "2"), ("a", "2"), ("b", "5"), (None, "1"))
    panel = loans(spark, {"id_credito": "a", "cuota_mensual": "1"}, {"id_credito": "a", "cuota_mensual": "3"},
                  {"id_credito": "b", "cuota_mensual": "5"})
    pairs = rows(reconcile.attribute_mismatch(paid, panel, form="pairs"))
    assert sorted((k, int(r), int(v)) for k, r, v in pairs) == [("a", 1, 2), ("a", 3, 1), ("a", 3, 2)]
    summary = rows(reconcile.attribute_mismatch(paid, panel))
    assert sorted((k, int(v), n) for k, v, n, _, _ in summary) == [("a", 1, 1), ("a", 2, 2)]


def test_preferred_flag_row_count_can_never_exceed_one(spark):
    panel = loans(
        spark,
        {"id_cliente": "c", "id_credito": "1", "fecha_corte": "2021-01-31", "calificacion_sbs": "Normal"},
        {"id_cliente": "c", "id_credito": "1", "calificacion_sbs": "Normal"},
        {"id_cliente": "c", "id_credito": "2", "calificacion_sbs": "Normal"})
    customers = text(spark, "id_cliente es_cliente_preferente", ("c", "1"))
    assert rows(reconcile.preferred_flag_audit(customers, panel)) == []
    assert len(rows(reconcile.preferred_flag_audit(customers, panel, "row1"))) == 1
    missed = text(spark, "id_cliente es_cliente_preferente", ("c", "0"))
    assert rows(reconcile.preferred_flag_audit(missed, panel))[0][2:5] == ("Normal", 36, 2)


def test_debt_to_income_modes(spark):
    panel = loans(
        spark, {"id_cliente": "c", "id_credito": "1", "saldo_total_exposicion": "50", "ingresos_anuales": "100"},
        {"id_cliente": "c", "id_credito": "2", "saldo_total_exposicion": "50", "ingresos_anuales": "300"})
    customers = text(spark, "id_cliente tasa_endeudamiento_sistema_pct", ("c", "0"))
    assert rows(reconcile.debt_to_income_audit(customers, panel))[0][2] == pytest.approx(100 / 3)
    assert rows(reconcile.debt_to_income_audit(customers, panel, income_mode="sum"))[0][2] == 25.0


def test_latest_sum_and_ties(spark):
    panel = loans(
        spark, {"id_cliente": "c", "id_credito": "1", "provision_constituida": "5", "fecha_corte": "2023-12-31"},
        {"id_cliente": "c", "id_credito": "1", "provision_constituida": "7"},
        {"id_cliente": "c", "id_credito": "2", "provision_constituida": "8"})
    customers = text(spark, "id_cliente provision_total_cliente", ("c", "15"), ("d", "1"))
    assert rows(reconcile.latest_sum_audit(customers, panel, "provision_total_cliente", "provision_constituida")) == []


def test_key_value_probe_lists_every_loan_of_the_customers(spark):
    panel = loans(
        spark,
        {"id_cliente": "101", "id_credito": "1", "moneda": "USD", "saldo_capital": "5.00"},
        {"id_cliente": "101", "id_credito": "2", "moneda": "USD", "saldo_capital": "102061.09"},
        {"id_cliente": "102", "id_credito": "3", "moneda": "USD", "saldo_capital": "102061.09"},
    )
    tables = SimpleNamespace(loans=panel)
    found = {name: {r.id_credito for r in all_queries()[name].run(tables).collect()}
             for name in ("dq_key_value_probe", "dq_key_value_probe_balances")}
    assert found == {"dq_key_value_probe": {"1", "2"}, "dq_key_value_probe_balances": {"2"}}
