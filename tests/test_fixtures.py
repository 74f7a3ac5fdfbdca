"""The raw layer as Spark reads it."""

from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import functions as F

from bankmart.plans import galaxy
from bankmart.schemas import CUSTOMER_KEYS, DAY, MONEY
from bankmart.sources import stage
from bankmart.sources.raw import bad_cells
from catalog import registry
from catalog.fixtures import FIXTURES, SPARK_FIXTURES
from tests.frames import rows, text

DAYS = [datetime(1996, 1, 3), datetime(1996, 1, 30), datetime(1996, 2, 1), None]
LINE = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"
ORDER = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def given(spark):
    """Orders that repeat, whole and with another price, customers that repeat, keys and values that are missing."""
    lines = [(k, n, 7.0 + n, 10.25 * n if n != 2 else None, 0.05, 0.02, "AR"[n % 2], DAYS[n]) for k in (1, 2, 3, None) for n in (0, 1, 1, 2, 3)]
    orders = [(1, 5, 9.5, DAYS[0], "HIGH"), (1, 5, 9.5, DAYS[0], "HIGH"), (1, 5, 8.5, DAYS[0], "HIGH"), (2, 6, None, None, None),
              (3, 6, 1.0, DAYS[1], "LOW"), (3, None, 1.0, DAYS[1], "LOW"), (None, 5, 1.0, DAYS[1], "LOW")]
    customers = [(5, 1, "A"), (5, 1, "A"), (6, 1, None), (6, 2, "B"), (None, 1, "A")]
    return {
        "lineitem": spark.createDataFrame(lines, LINE), "orders": spark.createDataFrame(orders, ORDER),
        "customer": spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": spark.createDataFrame([(1, "X"), (2, "Y"), (2, "Y"), (None, "Z")], "n_nationkey int, n_name string"),
    }


def test_loan_panel_has_the_rows_of_its_sql(spark):
    tables = given(spark)
    want = spark.sql(FIXTURES["loan_panel"], **tables)
    got = spark.sql(SPARK_FIXTURES["loan_panel"], **tables)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)
    assert got.count() > 5


def test_loan_panel_sums_lines_before_any_join(spark):
    plan = spark.sql(SPARK_FIXTURES["loan_panel"], **given(spark))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan[: plan.index("l_orderkey")].splitlines()
    assert any("Aggregate [k" in x and "n_name" not in x for x in lines)
    assert any("RepartitionByExpression [k" in x for x in lines)


def test_no_task_that_reads_orders_keeps_a_table_of_them(spark):
    """Orders are counted behind the shuffle that deals them by key, however many one task reads."""
    plan = spark.sql(SPARK_FIXTURES["loan_panel"], **given(spark))._jdf.queryExecution().optimizedPlan().toString()
    orders = plan[plan.index("Aggregate [o_orderkey") :].splitlines()
    assert "RepartitionByExpression [o_orderkey" in orders[1] and not any("Aggregate" in x for x in orders[2:])


def test_orders_are_dealt_with_their_lines(spark, monkeypatch):
    """As many partitions on both sides, from as soon as there are more parts than cores."""
    tables = registry.Tables(spark, "")
    monkeypatch.setattr(tables, "given", lambda name: given(spark)[name])
    monkeypatch.setattr(registry, "LINES_AT_ONCE", 2)
    plan = tables._fixture("loan_panel")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [") == 2 and plan.count(f", {tables._line_parts.strip(', ')}\n") == 2


def test_many_lines_are_dealt_by_their_number(spark, monkeypatch):
    tables = registry.Tables(spark, "")
    monkeypatch.setattr(tables, "given", lambda name: spark.range(100))
    assert tables._line_parts == ""
    monkeypatch.setattr(registry, "LINES_AT_ONCE", 1)
    del tables.__dict__["_line_parts"]
    assert tables._line_parts == "100, "


def test_both_statements_read_the_month_sums_once(spark, monkeypatch):
    lines = given(spark)["lineitem"].selectExpr("*", "'F' AS l_linestatus").where("l_shipdate IS NOT NULL AND l_orderkey IS NOT NULL")
    tables, apart = registry.Tables(spark, ""), registry.Tables(spark, "")
    staged = []
    monkeypatch.setattr(registry, "stage", lambda df, name: staged.append(name) or stage(df, name))
    for t in (tables, apart):
        t.__dict__.update(loans=None, payments=None, customers=None)
        monkeypatch.setattr(t, "given", lambda name: {"lineitem": lines}[name])
    both = tables.raw
    assert staged == ["month_sums"]
    for df, alone in ((both.income, apart.income), (both.balance, apart.balance)):
        assert "l_extendedprice" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert df.dtypes == alone.dtypes and sorted(rows(df)) == sorted(rows(alone)) and df.count() == 2


def test_dimensions_write_no_more_of_the_loans_than_they_read(spark, monkeypatch):
    staged = {}
    monkeypatch.setattr(registry, "stage", lambda df, name: staged.update({name: df}) or df)
    monkeypatch.setattr(galaxy, "dim_customer", lambda df: df)
    names = [*CUSTOMER_KEYS, "calificacion_sbs", *galaxy.PRODUCT_PAIR, "saldo_capital"]
    tables = registry.Tables(spark, "")
    tables.__dict__["mart_credits"] = text(spark, " ".join(names), names)
    assert "saldo_capital" not in tables.dim_customer.columns
    assert set(staged) == {"credit_attributes", "dim_customer"}
    whole = registry.Tables(spark, "")
    whole.__dict__["staged_credits"] = tables.mart_credits
    assert whole.dim_customer.columns == names


def test_customer_fact_derives_the_customers_once(spark, monkeypatch):
    derived = []
    monkeypatch.setattr(registry.marts, "mart_customers", lambda c, l: derived.append(1) or spark.range(1))
    monkeypatch.setattr(registry, "stage", lambda df, name: SimpleNamespace(name=name))
    monkeypatch.setattr(galaxy, "dim_status", lambda customers: customers)
    tables = registry.Tables(spark, "")
    tables.__dict__.update(customers=None, loans=None)
    seen = tables.staged_customers
    assert tables._customers is seen and derived == [1]


def test_bad_cells_need_no_lambda(spark):
    df = text(spark, "a b c", ("1", "x", "y"), ("x", "2024-01-31", None), ("", None, "z"), ("x", "y", "z"))
    found = df.select(bad_cells({"a": MONEY, "b": DAY, "c": "string"}).alias("cells"))
    assert [[tuple(c) for c in r.cells] for r in found.collect()] == [
        [("cell", "b", "x")], [("cell", "a", "x")], [], [("cell", "a", "x"), ("cell", "b", "y")]]
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.select(F.size("cells").alias("n")).agg(F.sum("n")).first()[0] == 4
