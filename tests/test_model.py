from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from bankmart import schemas as S
from bankmart.operators import dimension as D
from bankmart.plans import galaxy as G, kpi
from bankmart.sources import read_raw, stage, staging_root, write_table
from catalog.registry import Tables
from tests.frames import rows, text

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_keys_are_dense_and_ordered(spark, n):
    df = spark.range(n).select(F.pmod(F.col("id") * 7919, F.lit(max(n, 1))).cast("string").alias("a"))
    got = [(r["key"], r["a"]) for r in D.surrogate_key(df, ["a"], "key").orderBy("key").collect()]
    assert got == list(enumerate(sorted(str(i) for i in range(n)), start=1))


def test_keys_with_a_frequent_leading_value_and_null(spark):
    df = spark.range(999).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("a"), F.col("id").alias("b"))
    got = rows(D.surrogate_key(df, ["a", "b"], "key").orderBy("key"))
    assert [r[0] for r in got] == list(range(1, 1000))
    assert [r[1] for r in got] == [None] * 333 + ["hot"] * 666


def test_key_frames_do_not_change_between_reads(spark):
    keyed = D.surrogate_key(spark.range(500).select((F.rand(3) * 1e9).alias("x")), ["x"], "key")
    assert sorted(rows(keyed)) == sorted(rows(keyed))


def test_calendar(spark):
    days = D.calendar(spark)
    assert days.count() == 1461
    first = days.where("fecha = date'2024-02-29'").first()
    assert tuple(first)[1:] == (2024, 2, "febrero", "feb", "T1", "2024-02")


def test_calendar_of_no_dates_is_empty(spark):
    assert D.calendar_of(spark.createDataFrame([(None,)], "d date"), "d").count() == 0


def test_best_customer_prefers_known_attributes(spark):
    dim = spark.createDataFrame(
        [(1, "c", "Natural", "Comercio"), (2, "c", None, "Comercio"), (3, "c", "Natural", None), (4, "d", None, None)],
        "id_cliente_PK long, id_cliente string, tipo_persona string, sector_economico string",
    ).withColumns({c: F.lit("x") for c in ("segmento", "zona_geografica", "oficial_credito")})
    got = {r["id_cliente"]: r["id_cliente_PK"] for r in G.best_customer(dim).collect()}
    assert got == {"c": 1, "d": 4}


def test_latest_only_dimension_has_a_row_per_customer(spark):
    base = {c: "x" for c in S.CUSTOMER_KEYS}
    df = spark.createDataFrame(
        [("c", "A", date(2024, 1, 31), "1"), ("c", "B", date(2024, 2, 29), "1"), ("d", "C", date(2024, 1, 31), "2")],
        "id_cliente string, segmento string, fecha_corte date, id_credito string",
    ).withColumns({c: F.lit("x") for c in base if c not in ("id_cliente", "segmento")})
    assert G.dim_customer(df).count() == 3
    latest = {r["id_cliente"]: r["segmento"] for r in G.dim_customer(df, latest_only=True).collect()}
    assert latest == {"c": "B", "d": "C"}


def test_csv_keeps_empty_text_apart_from_null(spark, tmp_path):
    path = tmp_path / "customers.csv"
    names = S.RAW_COLUMNS["customers"]
    path.write_text(",".join(names) + "\n" + ",".join(['""', "\\N", "c"] + ["x"] * (len(names) - 3)) + "\n")
    row = read_raw(spark, str(path), "customers").first()
    assert (row[0], row[1], row[2]) == ("", None, "c")
    assert read_raw(spark, str(path), "customers", empty_as_null=True).first()[0] is None


def test_csv_in_another_column_order_is_refused(spark, tmp_path):
    path = tmp_path / "customers.csv"
    names = S.RAW_COLUMNS["customers"]
    path.write_text(",".join(names[::-1]) + "\n" + ",".join(["x"] * len(names)) + "\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(path), "customers").collect()


@pytest.mark.parametrize("mart, types", [
    ("mart_credits", S.LOAN_TYPES), ("mart_payments", S.PAYMENT_TYPES), ("mart_customers", S.CUSTOMER_TYPES)])
def test_types_of_the_cleaned_tables(spark, mart, types):
    found = dict(getattr(Tables(spark, SF), mart).dtypes)
    assert {c: found[c] for c in types} == types


def test_types_of_the_monthly_tables(spark):
    tables = Tables(spark, SF)
    for df in (tables.mart_income, tables.mart_balance):
        found = dict(df.dtypes)
        assert found.pop("fecha_mes") == "date" and all(k.startswith("decimal") for k in found.values())


def test_closed_domain_key_numbers_like_surrogate_key(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("a", None)], "a string, b int")
    assert sorted(rows(D.closed_domain_key(df, ["a", "b"], "key")), key=repr) == sorted(
        rows(D.surrogate_key(df, ["a", "b"], "key")), key=repr)


def test_facts_are_planned_without_running_jobs(spark):
    tables = Tables(spark, SF)
    credits, dims = tables.staged_credits, (tables.dim_customer, tables.dim_rating, tables.dim_product)
    spark.sparkContext.setJobGroup("facts", "no job is expected")
    try:
        fact = G.fact_credits(credits, *dims)
        G.star_credits(fact, *dims)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("facts")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_parquet_source_is_read_as_text(spark, tmp_path):
    names = S.RAW_COLUMNS["income"]
    df = spark.range(1).select(*[(F.col("id") + 5).alias(c) for c in names])
    df.write.parquet(str(tmp_path / "income"))
    got = read_raw(spark, str(tmp_path / "income"), "income", fmt="parquet")
    assert got.first()["utilidad_neta"] == "5" and set(dict(got.dtypes).values()) == {"string"}


def test_stage_uses_the_configured_folder(spark):
    staged = stage(text(spark, "a", ("1",)), "probe")
    assert staging_root(spark) in staged.inputFiles()[0] and rows(staged) == [("1",)]


def test_write_table_replaces_old_rows(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("string").alias("p"))
    path = str(tmp_path / "t")
    write_table(df, path, ["p"])
    assert write_table(df.where("id < 3"), path, ["p"]).count() == 3


def test_galaxy_keeps_row_counts_and_keys(spark, tmp_path):
    tables = Tables(spark, SF)
    built = G.build_galaxy(tables.raw, str(tmp_path / "galaxy"))
    assert built["fact_credits"].count() == tables.mart_credits.count()
    assert built["fact_payments"].count() == tables.payments.count()
    assert built["fact_customers"].count() == tables.mart_customers.count()
    coverage = {r["fk"]: r["n_null"] for r in D.fk_coverage(
        built["fact_credits"], ["id_cliente_PK", "id_calificacion_sk", "id_producto_PK"]).collect()}
    assert set(coverage.values()) == {0}
    star = G.star_credits(built["fact_credits"], built["dim_customer"], built["dim_rating"], built["dim_product"])
    card = kpi.kpi_scorecard(built["fact_income"], built["fact_balance"], star)
    assert card.count() == 8 and star.count() == built["fact_credits"].count()
    days = built["dim_calendar"].agg(F.count("*"), F.count_distinct("fecha"), F.count_distinct("ano")).first()
    assert days[0] == days[1] >= 365 * days[2] > 0
    due = built["fact_payments"].where("mes_vencimiento <> last_day(fecha_vencimiento_cuota)")
    assert due.count() == 0 and "mes_vencimiento" in built["fact_payments"].columns
    by_month = built["fact_credits"].where("fecha_corte = date'1998-06-30'")
    assert "PartitionFilters: [isnotnull(fecha_corte" in by_month._jdf.queryExecution().toString()
