"""Reconciliations between tables.

The big side is always aggregated before it meets the other table, so the join moves one
row per key and a heavy customer, loan or month never reaches a single task as rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bankmart.functions import as_day, as_decimal, as_money, as_rate, as_whole, month_gap, ratio
from bankmart.operators.joins import lookup
from bankmart.operators.rollup import (
    first_income, latest_sum, weighted_avg,
)


def month_sums(loans: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Sums of loan figures per cutoff date."""
    return loans.groupBy(as_day("fecha_corte").alias("fecha_mes")).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()]
    )


def cross_sum(
    monthly: DataFrame, loans: DataFrame, reported: str, detail: str, tolerance=1
) -> DataFrame:
    """Monthly figure against the sum over loans of that cutoff; no loans count as zero."""
    sums = month_sums(loans, {"detail_sum": as_money(detail)})
    left = monthly.select(
        as_day("fecha_mes").alias("fecha_mes"), as_money(reported).alias("reported")
    )
    detail_sum = F.coalesce(F.col("detail_sum"), F.lit(0))
    return (
        left.join(sums, "fecha_mes", "left")
        .select("fecha_mes", "reported", detail_sum.alias("detail_sum"),
                F.abs(F.col("reported") - detail_sum).alias("gap"))
        .where(F.col("gap") > tolerance)
    )


def cross_sum_exact(
    monthly: DataFrame, loans: DataFrame, reported: str, detail: str
) -> DataFrame:
    """Months whose figure is not exactly the sum over loans; unmatched months drop out."""
    sums = month_sums(loans, {"detail_sum": as_money(detail)})
    left = monthly.select(
        as_day("fecha_mes").alias("fecha_mes"), as_money(reported).alias("reported")
    )
    return (
        left.join(sums, "fecha_mes", "left")
        .where(F.col("reported") != F.col("detail_sum"))
        .select("fecha_mes", "reported", "detail_sum",
                (F.col("reported") - F.col("detail_sum")).alias("gap"))
    )


def attribute_mismatch(
    payments: DataFrame,
    loans: DataFrame,
    key: str = "id_credito",
    left_value: str = "cuota_pactada",
    right_value: str = "cuota_mensual",
    form: str = "summary",
) -> DataFrame:
    """Values of the same attribute that differ between two tables for the same key.

    ``form='summary'`` is linear: one row per (key, left value) with the number and range of
    the right values that contradict it. ``form='pairs'`` lists each differing pair of
    distinct values once; a hot key is spread over many tasks. A loan has one right value
    per cutoff, so the pairs grow with the number of months.
    """
    left = payments.select(key, as_money(left_value).alias(left_value)).distinct()
    right = loans.select(key, as_money(right_value).alias(right_value)).distinct()
    if form == "pairs":
        joined = lookup(left, right, [key], how="inner")
        return joined.where(F.col(right_value) != F.col(left_value)).select(
            key, right_value, left_value
        )
    per_key = right.where(F.col(right_value).isNotNull()).groupBy(key).agg(
        F.count("*").alias("n_right"),
        F.min(right_value).alias("right_min"),
        F.max(right_value).alias("right_max"),
    )
    same = right.select(key, F.col(right_value).alias(left_value), F.lit(1).alias("n_same"))
    valued = left.where(F.col(left_value).isNotNull())
    joined = lookup(valued, per_key, [key], how="inner").join(same, [key, left_value], "left")
    n_differing = F.col("n_right") - F.coalesce(F.col("n_same"), F.lit(0))
    return joined.where(n_differing > 0).select(
        key, left_value, n_differing.alias("n_differing"), "right_min", "right_max"
    )


def lookup_candidates(
    customers: DataFrame, loans: DataFrame, field: str = "oficial_credito",
    key: str = "id_cliente", same: str = "segmento",
) -> DataFrame:
    """Customers without a value, with the values their loans of the same class carry."""
    known = loans.select(
        key, F.col(field).alias("candidate"), F.col(same).alias("_class")
    ).distinct()
    gaps = customers.where(F.col(field).isNull()).select(key, same)
    return (
        gaps.join(known, key, "left")
        .where(F.col(same) == F.col("_class"))
        .select(key, same, "candidate")
    )


def latest_sum_audit(
    customers: DataFrame, loans: DataFrame, reported: str, detail: str,
    tolerance: str = "0.01",
) -> DataFrame:
    """Customer total against the sum over the loans of that customer's last cutoff."""
    sums = latest_sum(loans, detail, "detail_sum")
    left = customers.select("id_cliente", as_money(reported).alias("reported"))
    return _gap_rows(left.join(sums, "id_cliente"), tolerance)


def weighted_avg_audit(
    customers: DataFrame, loans: DataFrame, cutoff, tolerance: str = "0.01"
) -> DataFrame:
    """Customer rate against the balance-weighted rate of the loans at a fixed cutoff."""
    rates = (
        loans.where(as_day("fecha_corte") == F.lit(cutoff).cast("date"))
        .groupBy("id_cliente")
        .agg(weighted_avg(as_rate("tasa_nominal_anual_pct"), as_money("saldo_capital")).alias("detail_sum"))
    )
    left = customers.select("id_cliente", as_rate("tasa_nominal_promedio").alias("reported"))
    return _gap_rows(left.join(rates, "id_cliente"), tolerance)


def first_record_audit(
    customers: DataFrame, loans: DataFrame, tolerance: str = "0.01"
) -> DataFrame:
    """Customer income against the income of the earliest loan record."""
    left = customers.select("id_cliente", as_money("ingresos_anuales").alias("reported"))
    return _gap_rows(left.join(first_income(loans, "detail_sum"), "id_cliente"), tolerance)


def debt_to_income_audit(
    customers: DataFrame, loans: DataFrame, tolerance: str = "0.1", income_mode: str = "record"
) -> DataFrame:
    """Exposure at the last cutoff of the whole table over the customer's recent income.

    ``income_mode='record'`` uses the income of one record, ``'sum'`` the total over the
    loans of the customer's last cutoff, as the cleaning step does.
    """
    amount = as_money("ingresos_anuales")
    newest = F.max_by(amount, F.struct("id_credito"))
    by_cutoff = loans.groupBy("id_cliente", as_day("fecha_corte").alias("cutoff")).agg(
        F.sum(as_money("saldo_total_exposicion")).alias("exposure"),
        (F.sum(amount) if income_mode == "sum" else newest).alias("recent_income"),
    )
    latest = by_cutoff.groupBy("id_cliente").agg(
        F.max("cutoff").alias("cutoff"),
        F.max_by(F.struct("exposure", "recent_income"), F.struct("cutoff")).alias("_last"),
    )
    # A customer has exposure at the last cutoff of the table only if it is its own last.
    last = loans.agg(F.max(as_day("fecha_corte"))).scalar()
    current = latest.where(F.col("cutoff") == last).select("id_cliente", "_last.*")
    left = customers.select(
        "id_cliente", as_decimal("tasa_endeudamiento_sistema_pct").alias("reported")
    )
    rate = ratio("exposure", "recent_income") * 100
    return _gap_rows(left.join(current, "id_cliente").withColumn("detail_sum", rate), tolerance)


def _gap_rows(joined: DataFrame, tolerance: str) -> DataFrame:
    gap = F.col("reported") - F.col("detail_sum")
    return joined.where(F.abs(gap) > F.lit(tolerance).cast("decimal(18,4)")).select(
        "id_cliente", "reported", F.col("detail_sum").alias("recomputed"), gap.alias("gap")
    )


def preferred_facts(loans: DataFrame, count_mode: str = "cutoff") -> DataFrame:
    """Last rating, months of tenure and active loans of every customer.

    ``count_mode='cutoff'`` counts the loans of the last cutoff; ``'row1'`` counts the one
    latest row, which is always one.
    """
    by_cutoff = loans.groupBy("id_cliente", as_day("fecha_corte").alias("cutoff")).agg(
        F.max_by("calificacion_sbs", F.struct("id_credito")).alias("last_rating"),
        F.count("*").alias("active_loans"),
    )
    last = F.max_by(F.struct("last_rating", "active_loans"), F.struct("cutoff"))
    facts = by_cutoff.groupBy("id_cliente").agg(
        last.alias("_last"), month_gap(F.min("cutoff"), F.max("cutoff")).alias("tenure_months")
    )
    active = F.lit(1).cast("bigint") if count_mode == "row1" else F.col("_last.active_loans")
    return facts.select(
        "id_cliente", "_last.last_rating", "tenure_months", active.alias("active_loans")
    )


def preferred_flag_audit(
    customers: DataFrame, loans: DataFrame, count_mode: str = "cutoff"
) -> DataFrame:
    """Preferred flags that the loans contradict, in both directions, with the reason."""
    facts = preferred_facts(loans, count_mode)
    joined = customers.select(
        "id_cliente", as_whole("es_cliente_preferente").alias("reported")
    ).join(facts, "id_cliente")
    bad_rating = F.col("last_rating") != "Normal"
    short, single = F.col("tenure_months") <= 24, F.col("active_loans") <= 1
    qualifies = (F.col("last_rating") == "Normal") & (F.col("tenure_months") > 24) & (
        F.col("active_loans") > 1
    )
    reason = (
        F.when(bad_rating, F.lit("ERROR: No es calificación Normal"))
        .when(short, F.lit("ERROR: Antigüedad <= 24 meses"))
        .when(single, F.lit("ERROR: Solo tiene 1 crédito activo"))
    )
    wrong = ((F.col("reported") == 1) & (bad_rating | short | single)) | (
        (F.col("reported") == 0) & qualifies
    )
    return joined.where(wrong).select(
        "id_cliente", "reported", "last_rating", "tenure_months", "active_loans",
        reason.alias("reason"),
    )
