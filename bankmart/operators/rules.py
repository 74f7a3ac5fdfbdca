"""Row rules: a row on its own contradicts dates, bands, formulas or flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from bankmart.functions import (
    as_day, as_decimal, as_money, as_rate, as_whole, band_mismatch, col,
)
from bankmart.schemas import MONEY, RATING_BANDS

# --- fixed values: labels that the audits print -----------------------------------------
GAP_LABELS = ("CORRECTO", "ERROR_CALCULO")
RATIO_LABELS = ("BAJO (Menor al 8%)", "ALTO (Mayor al 35%)", "DENTRO DE RANGO")


def chronology_test(start: str, end: str, as_of) -> Column:
    begin, finish = as_day(start), as_day(end)
    return (finish <= begin) | (begin > F.lit(as_of).cast("date"))


def chronology(
    df: DataFrame, start: str, end: str, as_of, context: Sequence[str]
) -> DataFrame:
    """End not after start, or start after ``as_of`` (a date passed in, never today)."""
    return df.where(chronology_test(start, end, as_of)).select(*context, start, end)


def date_parts_test(date: str, year: str, month: str, mode: str = "all") -> Column:
    day = as_day(date)
    wrong_year = F.year(day) != as_whole(year)
    wrong_month = F.month(day) != as_whole(month)
    return wrong_year & wrong_month if mode == "all" else wrong_year | wrong_month


def date_parts(
    df: DataFrame, date: str, year: str, month: str, mode: str = "all"
) -> DataFrame:
    """Stored year and month that disagree with the date.

    ``mode='all'`` wants both parts wrong, ``mode='any'`` reports a single wrong part.
    """
    return df.where(date_parts_test(date, year, month, mode)).select(date, month, year)


def rating_band_rows(
    df: DataFrame,
    rating: str,
    days: str,
    context: Sequence[str] = (),
    strict: bool = False,
    open_band_floor: int | None = None,
    below_first_ok: bool = False,
) -> DataFrame:
    """Rows whose rating does not fit the days past due. ``strict`` ignores the options."""
    if strict:
        open_band_floor, below_first_ok = None, False
    test = band_mismatch(
        F.col(rating), as_whole(days), RATING_BANDS, open_band_floor, below_first_ok
    )
    return df.where(test).select(*context, rating, days)


def rating_band_counts(df: DataFrame, rating: str, days: str, **options) -> DataFrame:
    """Number of misfit rows per rating label."""
    rows = rating_band_rows(df, rating, days, **options)
    return rows.groupBy(rating).agg(F.count("*").alias("n_wrong"))


def not_greater_test(amount: str, limit: str) -> Column:
    a, b = as_money(amount), as_money(limit)
    return (a > b) & (b > 0)


def not_greater(
    df: DataFrame, amount: str, limit: str, context: Sequence[str]
) -> DataFrame:
    """Rows whose amount exceeds a positive limit."""
    return df.where(not_greater_test(amount, limit)).select(*context, limit, amount)


def total(columns: Sequence[str], kind: str = MONEY) -> Column:
    """Sum of text columns; a missing part makes the total missing, as in SQL."""
    return reduce(add, [as_decimal(c, kind) for c in columns])


def gap_audit(
    df: DataFrame,
    reported: Column,
    expected: Column,
    context: Mapping[str, Column] | Sequence[str],
    tolerance=None,
    signed: bool = False,
    absolute: bool = False,
    label_below=None,
) -> DataFrame:
    """Reported value, recomputed value and their gap.

    ``tolerance`` keeps only rows over it (``signed`` compares the signed gap); without it
    all rows are returned. ``absolute`` shows the size of the gap. ``label_below`` adds a
    status, CORRECTO under that size and ERROR_CALCULO otherwise.
    """
    keep = context.items() if isinstance(context, Mapping) else [(c, F.col(c)) for c in context]
    gap = reported - expected
    out = df.select(
        *[c.alias(name) for name, c in keep],
        reported.alias("reported"), expected.alias("recomputed"),
        (F.abs(gap) if absolute else gap).alias("gap"),
        gap.alias("_gap"),
    )
    if tolerance is not None:
        size = F.col("_gap") if signed else F.abs("_gap")
        out = out.where(size > tolerance)
    if label_below is not None:
        out = out.withColumn(
            "status",
            F.when(F.abs("_gap") < label_below, F.lit(GAP_LABELS[0])).otherwise(
                F.lit(GAP_LABELS[1])
            ),
        )
    return out.drop("_gap")


def component_sum(
    df: DataFrame,
    reported: str,
    parts: Sequence[str],
    context: Sequence[str],
    minus: Sequence[str] = (),
    tolerance=None,
    order: Sequence = (),
    absolute: bool = False,
) -> DataFrame:
    """Reported total against the sum of its parts (less the ``minus`` columns)."""
    expected = total(parts)
    if minus:
        expected = expected - total(minus)
    out = gap_audit(
        df, as_money(reported), expected, context, tolerance=tolerance, absolute=absolute
    )
    return out.orderBy(*order) if order else out


def profit_share(result: Column) -> Column:
    """Workers' share: 15% of a positive pre-tax result, otherwise nothing."""
    return F.when(result > 0, result * F.lit("0.15").cast("decimal(3,2)")).otherwise(
        F.lit(0).cast("decimal(18,4)")
    )


def deposit_levy(deposits: Column) -> Column:
    """Deposit insurance levy of a month: 0.065% of deposits, in sixths."""
    yearly = deposits * F.lit("0.00065").cast("decimal(6,5)")
    return (yearly / F.lit(6)).cast("decimal(18,4)")


def margin_audit(df: DataFrame, context: Sequence[str], tolerance=1) -> DataFrame:
    """Gross and net margin against their recomputation; either gap over the tolerance."""
    income, cost = as_money("total_ingresos"), as_money("total_gastos_financieros")
    gross, net = as_money("margen_financiero_bruto"), as_money("margen_financiero_neto")
    provisions = as_money("gasto_provisiones_periodo")
    out = df.select(
        *context,
        income.alias("income"), cost.alias("financial_cost"), gross.alias("gross_reported"),
        (income - cost).alias("gross_recomputed"),
        F.abs(gross - (income - cost)).alias("gross_gap"),
        provisions.alias("provisions"), net.alias("net_reported"),
        (gross - provisions).alias("net_recomputed"),
        F.abs(net - (gross - provisions)).alias("net_gap"),
    )
    return out.where((F.col("gross_gap") > tolerance) | (F.col("net_gap") > tolerance))


def ratio_band(
    df: DataFrame,
    part: str,
    whole: str,
    context: Sequence[str],
    low: str = "0.08",
    high: str = "0.35",
) -> DataFrame:
    """Part over whole in percent where the whole is positive, with a range label."""
    share = F.try_divide(as_money(part), as_money(whole))
    status = (
        F.when(share < F.lit(low).cast("decimal(5,4)"), F.lit(RATIO_LABELS[0]))
        .when(share > F.lit(high).cast("decimal(5,4)"), F.lit(RATIO_LABELS[1]))
        .otherwise(F.lit(RATIO_LABELS[2]))
    )
    return df.where(as_money(whole) > 0).select(
        *context, as_money(whole).alias(whole), as_money(part).alias(part),
        (share * 100).alias("share_pct"), status.alias("status"),
    )


def negative_context(
    df: DataFrame, fields: Sequence[str], context: Sequence[str]
) -> DataFrame:
    """Rows in which any of the fields is under zero, with their components."""
    return df.where(reduce(or_, [as_rate(f) < 0 for f in fields])).select(*context)


def point_lookup(
    df: DataFrame, key: str, values: Sequence[str], context: Sequence[str]
) -> DataFrame:
    return df.where(F.col(key).isin(*values)).select(*context)


def difference_exact(
    df: DataFrame, reported: str, a: str, b: str, context: Sequence[str] = ()
) -> DataFrame:
    """Rows whose reported value is not exactly ``a - b``."""
    value, expected = as_money(reported), as_money(a) - as_money(b)
    return df.where(value != expected).select(
        *context, value.alias("reported"), expected.alias("recomputed"),
        (value - expected).alias("gap"),
    )


def not_mirror_test(paid: str, due: str) -> Column:
    return (as_money(paid) < 0) & (F.abs(as_money(paid)) != as_money(due))


def negative_not_mirror(
    df: DataFrame, paid: str, due: str, context: Sequence[str]
) -> DataFrame:
    """Negative amounts that are not the mirror image of the amount due."""
    return df.where(not_mirror_test(paid, due)).select(
        as_money(paid).alias(paid), as_money(due).alias(due), *context
    )


def unpaid_part(due: str, paid: str) -> Column:
    rest = as_money(due) - as_money(paid)
    return F.when(rest < 0, F.lit(0).cast("decimal(19,2)")).otherwise(rest)


def floor_zero(
    df: DataFrame, reported: str, due: str, paid: str, context: Sequence[str]
) -> DataFrame:
    """Pending amounts that differ from the unpaid part, which is never under zero."""
    value, expected = as_money(reported), unpaid_part(due, paid)
    return df.where(value != expected).select(
        *context, value.alias("reported"), as_money(due).alias(due),
        expected.alias("recomputed"), (value - expected).alias("gap"),
    )


def flag_rederive(df: DataFrame, stored: str | None = None) -> DataFrame:
    """Frequency of the arrears flag recomputed from days and loans, or of the stored one."""
    if stored:
        value = F.col(stored)
    else:
        late = (as_whole("max_dias_atraso") > 0) & (as_whole("num_creditos_activos") > 0)
        value = F.when(late, F.lit("1")).otherwise(F.lit("0"))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("freq"))


def contradiction_test() -> Column:
    balance, flag = as_money("saldo_mora_total"), as_whole("tiene_credito_en_mora")
    unflagged = (balance > 0) & (flag == 0)
    return unflagged | ((balance == 0) & (flag == 1) & (as_whole("max_dias_atraso") > 0))


def flag_contradiction(df: DataFrame, context: Sequence[str] = ("id_cliente",)) -> DataFrame:
    """Arrears balance without the flag, or the flag and late days without a balance."""
    return df.where(contradiction_test()).select(
        *context, as_whole("tiene_credito_en_mora").alias("tiene_credito_en_mora"),
        as_whole("max_dias_atraso").alias("max_dias_atraso"),
        as_money("saldo_mora_total").alias("saldo_mora_total"),
    )


def share_in_percent(part: str, whole: str) -> Column:
    share = F.try_divide(as_money(part), F.nullif(as_money(whole), F.lit(0)))
    return F.coalesce(share * 100, F.lit(0))


def rate_recalc(
    df: DataFrame, rate: str, part: str, whole: str, context: Sequence[str] = (), tolerance=1
) -> DataFrame:
    """Reported rate against 100 * part / whole (0 without a whole); signed gap."""
    expected = share_in_percent(part, whole)
    gap = as_money(rate) - expected
    return df.where(gap > tolerance).select(
        *context, as_money(rate).alias("reported"), expected.alias("recomputed"),
        gap.alias("gap"),
    )
