"""One-scan reports: values equal to those of the single audits, one scan in the plan."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankmart import schemas as S
from bankmart.operators import domains, profile, report, rules
from bankmart.plans import audits, kpi
from bankmart.sources import stage
from catalog.quality import AS_OF
from catalog.registry import Tables
from tests.frames import rows, text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="module")
def loans(tables):
    return stage(tables.loans, "report-loans")


@pytest.fixture(scope="module")
def loan_values(loans):
    return {(r.step, r.field, r.metric): r.value for r in audits.loan_report(loans, AS_OF).collect()}


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_one_scan_and_one_shuffle_for_all_audits(loans):
    for df in (audits.loan_report(loans, AS_OF), audits.loan_values(loans)):
        assert scans(df) == 1 and exchanges(df) == 1


def test_equal_to_the_single_audits(loans, loan_values):
    assert loan_values["rows", "*", "rows"] == loans.count()
    single = {f: 0 for f in S.LOAN_NUMERIC}
    for r in profile.invalid_values(loans, S.LOAN_NUMERIC).collect():
        single[r.field] += r.freq
    assert {f: loan_values["invalid_values", f, "rows"] for f in single} == single
    single = {f: 0 for f in S.LOAN_NUMERIC} | {r.field: r.freq for r in profile.negatives(loans, S.LOAN_NUMERIC).collect()}
    assert {f: loan_values["negatives", f, "rows"] for f in single} == single
    single = {r.field: r.nulls for r in profile.missing(loans, S.LOAN_REQUIRED).collect()}
    assert {f: loan_values["missing", f, "rows"] for f in single} == single
    wrong = rules.chronology(loans, "fecha_desembolso", "fecha_vencimiento", AS_OF, []).count()
    assert loan_values["chronology", "fecha_vencimiento", "rows"] == wrong
    for step, options in (("rating_bands", {"open_band_floor": 90}), ("rating_bands_strict", {"strict": True})):
        single = {r.calificacion_sbs: r.n_wrong for r in rules.rating_band_counts(loans, "calificacion_sbs", "dias_atraso", **options).collect()}
        assert {k: loan_values[step, "calificacion_sbs", k] for k in audits.RATINGS} == {k: single.get(k, 0) for k in audits.RATINGS}
    spread = loans.agg(F.sum(F.col("saldo_capital").try_cast(S.MONEY))).first()[0]
    assert loan_values["spread", "saldo_capital", "sum"] == spread


def test_all_bands_fire_and_the_strict_form_differs(loan_values):
    plain, strict = ({k: loan_values[s, "calificacion_sbs", k] for k in audits.RATINGS} for s in ("rating_bands", "rating_bands_strict"))
    assert all(plain.values()) and strict["Pérdida"] > plain["Pérdida"]


def test_values_equal_to_the_single_audits(loans):
    found = {(r.step, r.field, r.value): r.freq for r in audits.loan_values(loans).collect()}
    for field in audits.LOAN_CATEGORIES:
        single = {r.value: r.freq for r in domains.category_freq(loans, field).collect()}
        assert {v: n for (s, f, v), n in found.items() if (s, f) == ("values", field)} == single
    single = {(r.field, r.dirty_value): r.freq for r in profile.invalid_values(loans, S.LOAN_NUMERIC).collect()}
    assert {(f, v): n for (s, f, v), n in found.items() if s == "invalid_values"} == single


@pytest.mark.parametrize("run, table", [
    (audits.income_report, "income"), (audits.balance_report, "balance"), (audits.payment_report, "payments"), (audits.customer_report, "customers")])
def test_every_metric_is_named_once(tables, run, table):
    found = run(getattr(tables, table)).collect()
    assert len({(r.step, r.field, r.metric) for r in found}) == len(found) and {r.step for r in found} >= {"rows", "missing", "negatives", "spread"}


def test_report_of_an_empty_table(spark):
    df = text(spark, "a b")
    found = report.audit_report(df, [*report.row_count(), *report.failing("missing", profile.missing_tests(["a"])), *report.spread("spread", ["b"])])
    assert [r.value for r in found.collect()] == [0, 0, None, None, None]
    assert rows(report.value_report(df, ["a"], {})) == []


def test_value_report_counts_nulls_and_faults(spark):
    df = text(spark, "a b", (None, "x"), ("k", "1"), ("k", "x"), ("k", None))
    found = report.value_report(df, ["a"], {"invalid": profile.invalid_tests(["b"])})
    assert sorted(rows(found), key=str) == sorted([("values", "a", None, 1), ("values", "a", "k", 3), ("invalid", "b", "x", 2)], key=str)


def test_slices_in_one_scan(spark, tables):
    credits = stage(tables.mart_credits, "slice-credits")
    sliced = kpi.slice_months(credits)
    assert scans(sliced) == 1
    found = {(r["slice"], r.slice_value, r.fecha_mes): r.portfolio for r in sliced.collect()}
    assert len(found) == sliced.count()
    for name, column in kpi.SLICES.items():
        single = {(name, r[column], r.fecha_mes): r.portfolio for r in kpi.loan_months(credits, [column]).collect()}
        assert {k: v for k, v in found.items() if k[0] == name} == single
    total = {("total", None, r.fecha_mes): r.portfolio for r in kpi.loan_months(credits).collect()}
    assert {k: v for k, v in found.items() if k[0] == "total"} == total


def test_a_null_slice_is_not_the_total(spark):
    from tests.frames import loans as loan_rows

    typed = loan_rows(spark, {"id_credito": "1", "segmento": None}, {"id_credito": "2", "segmento": "A"}).select(
        F.col("fecha_corte").cast("date").alias("fecha_corte"), "segmento", "calificacion_sbs",
        *[F.col(c).cast(S.MONEY).alias(c) for c in ("saldo_capital", "provision_constituida")],
        *[F.col(c).cast(S.RATE).alias(c) for c in ("pd_probabilidad_default", "lgd_loss_given_default")])
    found = {(r["slice"], r.slice_value): r.portfolio for r in kpi.slice_months(typed, {"segment": "segmento"}).collect()}
    assert found == {("segment", None): Decimal(100), ("segment", "A"): Decimal(100), ("total", None): Decimal(200)}
