"""Rejects of the read, versions, months, stable keys, counted rows, sketches, bucketed tables."""

import os
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from bankmart import schemas as S
from bankmart.operators import dimension as D, keys
from bankmart.plans import galaxy as G
from bankmart.sources import (
    counted, in_rounds, load_raw, publish_table, read_published, release, replace_partitions, stage, stage_rounds,
    staging_root, temporary_stages, versions, write_bucketed, write_counted, write_table,
)
from bankmart.sources.staging import CLEAN_UP
from catalog.loading import delivered
from catalog.registry import Tables
from tests.frames import rows, text

SF = "/root/testdata/sf0.001"
PAYMENT = {c: "1" for c in S.RAW_COLUMNS["payments"]} | {"fecha_pago_real": "2024-01-05", "fecha_vencimiento_cuota": "2024-01-31"}


def csv(tmp_path, *lines, header=True):
    path = tmp_path / "payments.csv"
    head = [",".join(S.RAW_COLUMNS["payments"])] * header
    path.write_text("\n".join([*head, *lines]) + "\n", encoding="utf-8")
    return str(path)


def line(**cells):
    return ",".join({**PAYMENT, **cells}.values())


# --- rejects -----------------------------------------------------------------------------

def test_short_and_long_lines_and_bad_cells(spark, tmp_path):
    short, long = ",".join(line(id_pago="b").split(",")[:6]), line(id_pago="c") + ",more"
    path = csv(tmp_path, line(id_pago="a"), short, long, line(id_pago="d", monto_pagado="12,5".replace(",", ";"), fecha_pago_real="soon"), "e",
               line(id_pago="f", canal_pago="\\N", numero_cuota='""', fecha_pago_real='""'))
    loaded = load_raw(spark, path, "payments")
    assert sorted(r.id_pago for r in loaded.good.collect()) == ["a", "d", "f"]
    assert loaded.good.columns == S.RAW_COLUMNS["payments"]
    assert sorted(rows(loaded.rejects), key=str) == sorted([
        ("b", "line", None, short), ("c", "line", None, long), ("e", "line", None, "e"),
        ("d", "cell", "monto_pagado", "12;5"), ("d", "cell", "fecha_pago_real", "soon")], key=str)
    kept = loaded.good.where("id_pago = 'f'").first()
    assert kept.canal_pago is None and kept.fecha_pago_real == ""


def test_good_rows_and_rejects_come_from_one_parse(spark, tmp_path):
    loaded = load_raw(spark, csv(tmp_path, line()), "payments")
    for df in (loaded.good, loaded.rejects):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "parquet" in plan.lower() and "csv" not in plan.lower().replace("payments.csv", "")


def test_columns_in_another_order_are_an_error(spark, tmp_path):
    path = tmp_path / "x.csv"
    names = S.RAW_COLUMNS["payments"]
    path.write_text(",".join(reversed(names)) + "\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_raw(spark, str(path), "payments")


def test_empty_file_and_own_types(spark, tmp_path):
    loaded = load_raw(spark, csv(tmp_path, line(id_pago="x"), header=False), "payments", types={"id_pago": S.WHOLE}, header=False)
    assert rows(loaded.rejects) == [("x", "cell", "id_pago", "x")]
    (tmp_path / "none.csv").write_text(",".join(S.RAW_COLUMNS["payments"]) + "\n")
    nothing = load_raw(spark, str(tmp_path / "none.csv"), "payments")
    assert nothing.good.count() == nothing.rejects.count() == 0


# --- versions ----------------------------------------------------------------------------

def test_a_build_that_dies_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_table(spark.range(10), path)
    dying = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 777, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish_table(dying, path)
    assert read_published(spark, path).count() == 10 and versions(spark, path).count() == 1
    publish_table(spark.range(3), path)
    assert read_published(spark, path).count() == 3
    assert [(r.version, r.rows) for r in versions(spark, path).collect()] == [(2, 3), (1, 10)]


def test_a_version_can_read_the_one_before_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "t")
    table = publish_table(spark.range(2), path)
    for n in range(3):
        table = publish_table(table.unionByName(spark.range(100 + n, 101 + n)), path, keep=2)
    assert sorted(r.id for r in read_published(spark, path).collect()) == [0, 1, 100, 101, 102]
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 2


def test_nothing_published(spark, tmp_path):
    assert versions(spark, str(tmp_path / "no")).count() == 0
    with pytest.raises(ValueError):
        read_published(spark, str(tmp_path / "no"))


def test_one_month_is_replaced_and_the_others_stay(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.range(90).select("id", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("m"))
    write_table(df.where("m <> '2024-02' OR id < 30"), path, ["m"])
    before = {m: sorted(os.listdir(f"{path}/m={m}")) for m in ("2024-01", "2024-02", "2024-03")}
    replace_partitions(df.where("m = '2024-02'"), path, ["m"])
    after = {m: sorted(os.listdir(f"{path}/m={m}")) for m in before}
    assert after["2024-01"] == before["2024-01"] and after["2024-03"] == before["2024-03"] and after["2024-02"] != before["2024-02"]
    whole = write_table(df, str(tmp_path / "whole"), ["m"])
    assert sorted(rows(spark.read.parquet(path))) == sorted(rows(whole))


# --- keys and counts ---------------------------------------------------------------------

def test_old_keys_stay_and_new_rows_are_numbered_on(spark):
    first = D.surrogate_key(text(spark, "a b", ("x", None), ("y", "1"), (None, "2")), ["a", "b"], "key")
    grown = D.extend_key(first, text(spark, "a b", ("y", "1"), ("x", None), ("b", "9"), ("a", "9"), (None, None)), ["a", "b"], "key")
    old, new = {r[1:]: r[0] for r in rows(first)}, {r[1:]: r[0] for r in rows(grown)}
    assert {k: new[k] for k in old} == old
    assert {k: v for k, v in new.items() if k not in old} == {(None, None): 4, ("a", "9"): 5, ("b", "9"): 6}
    assert rows(D.extend_key(first, first, ["a", "b"], "key")) and D.extend_key(first, first, ["a", "b"], "key").count() == 3


def test_extending_an_empty_dimension(spark):
    none = spark.createDataFrame([], "key long, a string")
    assert sorted(rows(D.extend_key(none, text(spark, "a", ("q",), ("p",)), ["a"], "key"))) == [(1, "p"), (2, "q")]


def test_rebuilt_galaxy_keeps_its_keys_counts_its_rows_and_cleans_up(spark, tmp_path):
    tables = Tables(spark, SF)
    root = staging_root(spark)
    raw = G.RawTables(*[stage(getattr(tables, t), f"raw-{t}") for t in ("loans", "income", "balance", "payments", "customers")])
    part = G.replace(raw, loans=raw.loans.where("id_credito NOT LIKE '%3'"))
    before = set(os.listdir(root))
    first = G.build_galaxy(part, str(tmp_path / "one"))
    second = G.build_galaxy(raw, str(tmp_path / "two"), previous=first)
    assert set(os.listdir(root)) == before
    names = S.CUSTOMER_KEYS
    old = {tuple(r[c] for c in names): r.id_cliente_PK for r in first["dim_customer"].collect()}
    new = {tuple(r[c] for c in names): r.id_cliente_PK for r in second["dim_customer"].collect()}
    assert {k: new[k] for k in old} == old and len(new) > len(old) and sorted(new.values()) == list(range(1, len(new) + 1))
    guard = {r.load: (r.n_before, r.n_after, r["diff"]) for r in second["load_guard"].collect()}
    assert guard == {
        f"fact_{t}": (second[f"fact_{t}"].count(),) * 2 + (0,) for t in ("credits", "payments", "customers", "balance")}


def test_counts_come_from_the_write(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("p"))
    for by in ([], ["p"]):
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("counted", "one write")
        try:
            table, n = write_counted(df, str(tmp_path / f"t{len(by)}"), by)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert n == 1000 == table.count()
        assert jobs is not None
    _, none = write_counted(df.where("id < 0"), str(tmp_path / "none"))
    assert none == 0


def test_counted_belongs_to_the_write(spark):
    watched, seen = counted(spark.range(12))
    stage(watched.where("id < 5"), "counted")
    assert seen.get["rows"] == 12


def test_temporary_stages_are_removed_even_after_a_failure(spark):
    root = staging_root(spark)
    before = set(os.listdir(root))
    with pytest.raises(RuntimeError), temporary_stages(spark):
        stage(spark.range(3), "gone")
        with temporary_stages(spark):
            stage(spark.range(3), "inner")
        assert len(set(os.listdir(root)) - before) == 1
        raise RuntimeError
    assert set(os.listdir(root)) == before
    kept = stage(spark.range(3), "kept")
    assert kept.count() == 3


def test_sketches_merge_within_two_percent(spark):
    df = spark.range(300_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 6).alias("m"))
    df = df.unionByName(df.where("m < 3").withColumn("m", F.col("m") + 3))
    stored = stage(keys.distinct_sketches(df, "k", ["m"]), "sketches")
    for by, want in (([], {(): 300_000}), (["m"], {(m,): 50_000 if m < 3 else 100_000 for m in range(6)})):
        found = {r[:-1]: r[-1] for r in rows(keys.distinct_estimates(stored, by))}
        assert found.keys() == want.keys() and all(abs(found[k] / want[k] - 1) < 0.02 for k in want)
    assert keys.uniqueness(df, "k", approx=True).first()["distinct"] == pytest.approx(300_000, rel=0.1)


def test_few_keys_are_counted_exactly_and_nulls_not_at_all(spark):
    df = text(spark, "k m", ("a", "1"), ("b", "1"), (None, "1"), ("a", "2"))
    assert rows(keys.distinct_estimates(keys.distinct_sketches(df, "k", ["m"]))) == [(2,)]


def test_many_keys_are_counted_exactly_in_any_union_of_slices(spark):
    df = spark.range(60_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("m"))
    df = df.unionByName(df.where("m = 0").withColumn("m", F.lit(1))).unionByName(text(spark, "k m", (None, "7")).selectExpr("k", "INT(m) AS m"))
    stored = stage(keys.distinct_sketches(df.unionByName(df), "k", ["m"]), "keys-seen")
    assert sorted(rows(keys.distinct_estimates(stored, ["m"]))) == [(0, 20_000), (1, 40_000), (2, 20_000), (7, 0)]
    halves = stored.selectExpr("m = 2 AS late", "keys_seen")
    assert sorted(rows(keys.distinct_estimates(halves, ["late"]))) == [(False, 40_000), (True, 20_000)]
    assert rows(keys.distinct_estimates(stored)) == [(60_000,)]
    assert rows(keys.distinct_estimates(stored.where("m > 9"))) == [(0,)]


def test_delivered_lines_are_removed_and_parsed_rows_are_small(spark):
    before = set(os.listdir(staging_root(spark)))
    loaded = delivered(Tables(spark, SF), "customers")
    new = set(os.listdir(staging_root(spark))) - before
    assert not [n for n in new if n.startswith("delivered")]
    assert loaded.good.inputFiles() and all(f.endswith(".zstd.parquet") for f in loaded.good.inputFiles())
    assert loaded.rejects.where("kind = 'line'").count() > 0


def test_shuffles_are_removed_when_a_table_is_written(spark):
    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").count("shuffle_")

    def settled(most):
        for _ in range(40):
            if files() <= most:
                break
            time.sleep(0.25)
        return files()

    kept = spark.conf.get(CLEAN_UP)
    n = files()
    stage(spark.range(2000).groupBy((F.col("id") % 9).alias("k")).count(), "summed")
    assert settled(n) <= n and spark.conf.get(CLEAN_UP) == kept


def test_a_table_in_rounds_is_the_table(spark, tmp_path):
    df = text(spark, "k v", *[(str(i % 11), str(i)) for i in range(300)], (None, "x"), (None, "x"))
    parts = in_rounds(df, ["k"], 4)
    for table, n in (write_counted(parts, str(tmp_path / "t"), ["k"]), (stage_rounds(parts, "parts"), 302)):
        assert n == 302 and sorted(rows(table.selectExpr("STRING(k)", "v")), key=str) == sorted(rows(df), key=str)
    again = write_table(parts[:1], str(tmp_path / "t"), ["k"])
    assert again.count() == parts[0].count() < 302
    staged = stage(df, "gone")
    release(staged)
    assert not [f for f in os.listdir(staging_root(spark)) if f.startswith("gone-")]


def test_a_galaxy_in_rounds_is_the_galaxy(spark, tmp_path):
    t = Tables(spark, SF)
    loans, payments, customers = (stage(df, "raw") for df in (t.loans, t.payments, t.customers))
    raw = replace(t.raw, loans=loans, payments=payments, customers=customers)
    whole, parts = (G.build_galaxy(raw, str(tmp_path / str(n)), rounds=n) for n in (1, 3))
    assert whole.keys() == parts.keys()
    for name in ("load_guard", "fact_credits", "fact_payments", "fact_customers", "fact_balance"):
        assert sorted(map(str, rows(whole[name]))) == sorted(map(str, rows(parts[name].select(*whole[name].columns))))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    a = write_bucketed(spark.range(400).select((F.col("id") % 50).alias("k"), "id"), "bucket_a", str(tmp_path / "a"), ["k"], 4)
    b = write_bucketed(spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "bucket_b", str(tmp_path / "b"), ["k"], 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.groupBy("k").agg(F.count("*").alias("n")).join(b, "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows(joined)) == [(k, 8, 2 * k) for k in range(50)]
        again = write_bucketed(spark.range(7).select(F.col("id").alias("k")), "bucket_b", str(tmp_path / "b"), ["k"], 4)
        assert again.count() == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE bucket_a")
        spark.sql("DROP TABLE bucket_b")
