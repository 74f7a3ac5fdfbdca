from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankmart.plans import kpi
from tests.frames import rows


def month(i, year=2024):
    nxt = date(year + i // 12, i % 12 + 1, 1)
    return date.fromordinal(nxt.toordinal() - 1)


def income(spark, *values):
    """Income months; each value is a dict of amounts."""
    names = ["fecha_mes", *kpi.INCOME_SUMS]
    return spark.createDataFrame([tuple(v.get(c) for c in names) for v in values],
                                 "fecha_mes date, " + ", ".join(f"{c} double" for c in kpi.INCOME_SUMS))


def balance(spark, *values):
    names = ["fecha_mes", *kpi.BALANCE_SUMS]
    return spark.createDataFrame([tuple(v.get(c) for c in names) for v in values],
                                 "fecha_mes date, " + ", ".join(f"{c} double" for c in kpi.BALANCE_SUMS))


def credits(spark, *values):
    values = [(d, s, r, *map(Decimal, map(str, amounts))) for d, s, r, *amounts in values]
    return spark.createDataFrame(
        values, "fecha_corte date, segmento string, calificacion_sbs string, saldo_capital decimal(18,2), "
        "provision_constituida decimal(18,2), pd_probabilidad_default decimal(18,4), lgd_loss_given_default decimal(18,4)")


def by_month(df, column="value"):
    return {r["fecha_mes"]: r[column] for r in df.collect()}


def test_previous_is_the_last_available_month(spark):
    months = kpi.bank_months(
        income(spark, {"fecha_mes": month(1), "utilidad_neta": 1.0}, {"fecha_mes": month(3), "utilidad_neta": 3.0}),
        balance(spark, {"fecha_mes": month(1), "total_patrimonio": 10.0}, {"fecha_mes": month(2), "total_patrimonio": 10.0},
                {"fecha_mes": month(3), "total_patrimonio": 10.0}))
    got = kpi.kpi_roe(months).where(F.col("fecha_mes") == month(3)).first()
    assert (got["value"], got["previous"]) == (0.3, 0.1) and got["diff"] == pytest.approx(0.2)


def test_blank_counts_as_zero_in_differences(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (None, None)], "a double, b double")
    assert rows(df.select(kpi.difference("a", "b"))) == [(1.0,), (-1.0,), (None,)]


def test_nim_of_the_first_month_uses_half_the_assets(spark):
    months = kpi.bank_months(
        income(spark, {"fecha_mes": month(1), "margen_financiero_bruto": 5.0}, {"fecha_mes": month(2), "margen_financiero_bruto": 9.0}),
        balance(spark, {"fecha_mes": month(1), "cartera_bruta": 100.0}, {"fecha_mes": month(2), "cartera_bruta": 150.0, "inversiones": 50.0}))
    got = {r["fecha_mes"]: r for r in kpi.kpi_nim(months).collect()}
    assert (got[month(1)]["value"], got[month(1)]["previous"]) == (0.1, 0.0)
    assert got[month(2)]["value"] == 9 / 150 and got[month(2)]["previous"] == 0.1


def test_series_keeps_each_slice_apart(spark):
    panel = credits(spark, (month(1), "A", "Dudoso", 40, 1, 0, 0), (month(1), "A", "Normal", 60, 1, 0, 0),
                    (month(2), "A", "Normal", 50, 1, 0, 0), (month(2), "B", "Vigente", 10, 1, 0, 0))
    got = {(r["segmento"], r["fecha_mes"]): (r["arrears_rate"], r["previous"])
           for r in kpi.kpi_arrears_rate(kpi.loan_months(panel, ["segmento"]), ["segmento"]).collect()}
    assert got == {("A", month(1)): (0.4, None), ("A", month(2)): (0.0, 0.4), ("B", month(2)): (0.0, None)}


def test_expected_loss_keeps_small_probabilities(spark):
    panel = credits(spark, (month(1), "A", "Normal", "1000000.01", 1, "0.0001", "0.0003"))
    assert float(kpi.loan_months(panel).first()["expected_loss"]) == pytest.approx(0.0300000003)


def test_cost_of_risk_without_portfolio_is_zero(spark):
    panel = credits(spark, (month(1), "A", "Normal", 0, 1, 0, 0), (month(2), "A", "Normal", 10, 1, 0, 0))
    assert by_month(kpi.kpi_cost_of_risk(kpi.loan_months(panel))) == {month(1): 0.0, month(2): 0.1}
    assert by_month(kpi.kpi_cost_of_risk(kpi.loan_months(panel), mode="average"))[month(2)] == 0.2


def test_trailing_year_is_by_calendar(spark):
    values = [{"fecha_mes": month(i, 2023), "gasto_provisiones_periodo": 1.0} for i in (1, 2, 13, 14)]
    months = kpi.bank_months(income(spark, *values), balance(spark))
    assert by_month(kpi.kpi_provisions_12m(months)) == {
        month(1, 2023): 1.0, month(2, 2023): 2.0, month(13, 2023): 2.0, month(14, 2023): 2.0}


def test_writeoff_references(spark):
    values = [{"fecha_mes": month(i, 2022), "castigos_periodo": v} for i, v in ((1, 12.0), (13, 24.0), (14, 36.0), (25, 7.0), (26, 3.0))]
    months = kpi.bank_months(income(spark, *values), balance(spark))
    got = {r["ano"]: tuple(r)[1:] for r in kpi.kpi_writeoff_reference(months).collect()}
    assert got == {2022: (None, None, None), 2023: (12.0, 1.0, 3.0), 2024: (24.0, 5.0, 15.0)}
    alert = {(r["ano"], r["period"]): (r["over_last_year"], r["over_mean"]) for r in kpi.kpi_writeoff_alert(months).collect()}
    assert alert[(2024, "1")] == (True, False) and alert[(2024, "2")] == (False, False)


def test_extremes_of_the_current_year_only(spark):
    held = [{"fecha_mes": month(i, 2023), "cartera_bruta": v} for i, v in ((12, 999.0), (13, 5.0), (14, 9.0), (15, 7.0))]
    months = kpi.bank_months(income(spark, *[{"fecha_mes": h["fecha_mes"]} for h in held]), balance(spark, *held))
    got = {r["fecha_mes"]: (r["is_max"], r["is_min"]) for r in kpi.kpi_extremes_year(months, "cartera_bruta").collect()}
    assert got == {month(13, 2023): (False, True), month(14, 2023): (True, False)}
    periods = kpi.kpi_extremes_period(months, "cartera_bruta", "quarter", year=2024).collect()
    assert [(r["period"], r["total"]) for r in periods] == [("T1", 21.0)]


def test_scorecard_of_the_published_month(spark):
    """Published values of one month: arrears 11.48 (+0.32), coverage 83.52 (-9.83), liquidity 43.47 (-12.59)."""
    earned = income(spark, {"fecha_mes": month(11), "utilidad_neta": 1.0, "margen_financiero_bruto": 1.0},
                    {"fecha_mes": month(12), "utilidad_neta": 5.07, "margen_financiero_bruto": 1.0})
    held = balance(
        spark, {"fecha_mes": month(11), "total_patrimonio": 100.0, "tasa_mora_pct_t1": 11.16, "cobertura_provision_pct_t1": 93.35,
                "indice_liquidez_pct": 56.06, "indice_solvencia_pct": 16.0, "cartera_bruta": 1.0},
        {"fecha_mes": month(12), "total_patrimonio": 100.0, "tasa_mora_pct_t1": 11.48, "cobertura_provision_pct_t1": 83.52,
         "indice_liquidez_pct": 43.47, "indice_solvencia_pct": 16.09, "cartera_bruta": 1.0})
    panel = credits(spark, (month(12), "A", "Normal", 100, "8.74", 0, 0))
    got = {r["kpi"]: r for r in kpi.kpi_scorecard(earned, held, panel).collect()}
    assert len(got) == 8 and {r["fecha_mes"] for r in got.values()} == {month(12)}
    assert got["roe"]["value"] == pytest.approx(0.0507)
    assert got["arrears"]["diff"] == pytest.approx(0.32) and got["arrears"]["good"] is False
    assert got["coverage"]["diff"] == pytest.approx(-9.83) and got["coverage"]["trend"] == "down"
    assert got["liquidity"]["diff"] == pytest.approx(-12.59) and got["liquidity"]["status"] == "high"
    assert got["solvency"]["status"] == "alert" and got["solvency"]["good"] is True
    assert got["cost_of_risk"]["value"] == pytest.approx(0.0874)
    assert all(r["diff"] == pytest.approx((r["value"] or 0) - (r["previous"] or 0))
               for r in got.values() if r["diff"] is not None)
    before = {r["kpi"]: r for r in kpi.kpi_scorecard(earned, held, panel, month(11)).collect()}
    assert before["arrears"]["value"] == 11.16 and before["arrears"]["previous"] is None
