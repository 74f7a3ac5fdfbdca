"""Shape of the physical plans at scale: what is scanned, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from bankmart import schemas as S
from bankmart.operators import profile, rollup
from bankmart.plans import kpi, marts
from bankmart.sources import stage, write_table
from catalog.registry import Tables
from tests.frames import rows, text

SF = "/root/testdata/sf0.001"
def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark):
    """The raw loans as a stored table, as they are in production."""
    return stage(Tables(spark, SF).loans, "plan-loans")


def read_columns(df):
    scanned = re.findall(r"Scan parquet \[([^\]]*)\]", plan(df))
    assert len(scanned) == 1
    return {c.split("#")[0] for c in scanned[0].split(",")}


def test_profiles_read_only_their_columns(raw):
    assert read_columns(profile.negatives(raw, ["saldo_capital", "dias_atraso"])) == {"saldo_capital", "dias_atraso"}
    assert read_columns(kpi.kpi_loan_balance(marts.mart_credits(raw), ["segmento"])) == {
        "segmento", "saldo_capital", "fecha_vencimiento", "fecha_desembolso", "flag_error",
        "tasa_nominal_anual_pct", "score_crediticio"}


def test_one_pass_profile_shuffles_one_row_per_task(raw):
    text = plan(profile.missing(raw, S.LOAN_REQUIRED))
    assert text.count("Scan parquet") == 1 and "partial_count" in text


def test_latest_per_key_aggregates_before_the_shuffle(raw):
    text = plan(rollup.loan_latest_instalment(raw))
    assert "Window" not in text and "partial_max(" in text and text.count("Exchange") == 1


def test_customer_figures_scan_the_loans_once(spark, raw):
    text = plan(marts.mart_customers(Tables(spark, SF).customers, raw))
    assert len(re.findall(r"Scan parquet \[id_credito", text)) == 1


def test_wide_tables_are_not_multiplied(raw):
    text = plan(profile.invalid_values(raw, S.LOAN_NUMERIC))
    assert text.index("Generate explode") < text.index("Filter")


def test_flagship_windows_run_on_monthly_rows(spark, raw):
    text = plan(kpi.kpi_arrears_rate(kpi.loan_months(marts.mart_credits(raw), ["segmento"]), ["segmento"]))
    assert text.index("Window") < text.index("HashAggregate") and "partial_sum" in text
    assert "SinglePartition" not in text


@pytest.mark.parametrize("month", [None, "1998-06-30"])
def test_scorecard_reads_only_its_months(spark, tmp_path, month):
    tables = Tables(spark, SF)
    fact = write_table(tables.mart_credits, str(tmp_path / "fact"), ["fecha_corte"])
    income, balance = stage(tables.mart_income, "income"), stage(tables.mart_balance, "balance")
    # The plan text cuts long filters off otherwise.
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    card = kpi.kpi_scorecard(income, balance, fact, month)
    filters = re.findall(r"PartitionFilters: (.*fecha_corte.*), PushedFilters", plan(card))
    assert filters and all(re.search(f"fecha_corte#\\d+ {way}= ", f) for f in filters for way in "<>")
    whole = kpi.scorecard_series(income, balance, fact)
    last = month or income.agg({"fecha_mes": "max"}).first()[0]
    want = whole.where(F.col("fecha_mes") == F.lit(last).cast("date"))
    assert sorted(card.collect(), key=repr) == sorted(want.collect(), key=repr) and card.count() == 8


def test_latest_amounts_need_no_sort(spark):
    """Date and amount in one number: hash aggregates only, in the order of (date, amount)."""
    from bankmart.functions import as_day, as_money

    cases = [("a", "2024-01-31", "5.00"), ("a", "2024-02-29", "-7.25"), ("b", None, "9"), ("b", "0001-01-01", None), ("c", "9999-12-31", "9999999999999999.99"),
             ("c", "9999-12-31", "-9999999999999999.99"), ("d", "2024-01-31", None), ("d", "2024-01-31", "0.00"), ("e", "2024-03-31", "x"), ("f", None, None)]
    df = text(spark, "k d v", *cases)
    found = rollup.latest_amount(df, ["k"], as_day("d"), as_money("v"), "decimal(18,2)")
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    want = rollup.latest_per_key(df, ["k"], [as_day("d"), as_money("v")], {"amount": as_money("v")})
    assert sorted(rows(found), key=str) == sorted(rows(want), key=str)
    loans = Tables(spark, SF).loans
    for df in (rollup.loan_latest_instalment(loans), rollup.latest_sum(loans, "provision_constituida", "p")):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
