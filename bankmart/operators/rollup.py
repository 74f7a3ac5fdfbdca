"""Roll-ups per key: latest, earliest, weighted, and several sums in one pass.

Latest and earliest records use ``max_by``/``min_by`` instead of a window: the aggregate
combines on the map side, so a customer with a third of all loans is never sorted in one
task. A struct of (date, tie breaker) makes the choice deterministic. Where only an amount is
wanted, date and amount are packed into one number, which a hash aggregate keeps in place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankmart.functions import as_day, as_money, as_rate, col, month_gap
from bankmart.schemas import MONEY, PERFORMING


def record_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    values: Mapping[str, Column],
    latest: bool,
) -> DataFrame:
    """One row per key: ``values`` of the record that is last (or first) in ``order``."""
    pick = F.max_by if latest else F.min_by
    named = F.struct(*[v.alias(n) for n, v in values.items()])
    rank = F.struct(*[col(o) for o in order])
    return (
        df.groupBy(*keys)
        .agg(pick(named, rank).alias("_record"))
        .select(*keys, *[F.col(f"_record.{n}").alias(n) for n in values])
    )


def latest_per_key(df, keys, order, values) -> DataFrame:
    return record_per_key(df, keys, order, values, latest=True)


def first_per_key(df, keys, order, values) -> DataFrame:
    return record_per_key(df, keys, order, values, latest=False)


# Room for the cents of a decimal(28,2) and their sign, as whole numbers in decimal digits.
_PLACES = 30


def _power(n: int) -> Column:
    return F.lit(f"1{'0' * n}").cast(f"decimal({n + 1},0)")


def pack(day: Column, amount: Column) -> Column:
    """A date and an amount (up to decimal(28,2)) as one whole number in the order of both.

    It fits the 16 bytes of a decimal that a hash aggregate updates in place, so the latest
    amount of a key needs no sort of the rows. Missing dates and amounts come first.
    """
    number = F.coalesce(F.date_diff(day, F.lit("0001-01-01").cast("date")) + 1, F.lit(0))
    cents = (amount.cast("decimal(28,2)") * 100).cast("decimal(30,0)") + _power(_PLACES - 1)
    whole = number.cast("decimal(7,0)") * _power(_PLACES)
    return (whole + F.coalesce(cents, F.lit(0).cast("decimal(30,0)"))).cast("decimal(38,0)")


def unpack_amount(packed: Column, kind: str) -> Column:
    """The amount of a packed number, NULL where it was missing."""
    cents = packed % _power(_PLACES)
    amount = (cents - _power(_PLACES - 1)).cast("decimal(30,0)") / F.lit(100).cast("decimal(3,0)")
    return F.when(cents > 0, amount).cast(kind)


def latest_amount(df: DataFrame, keys: Sequence[str], day: Column, amount: Column, kind: str) -> DataFrame:
    """Per key, the amount of the last date (of several, the largest), by hash aggregation."""
    packed = df.groupBy(*keys).agg(F.max(pack(day, amount)).alias("_packed"))
    return packed.select(*keys, unpack_amount(F.col("_packed"), kind).alias("amount"))


def weighted_avg(value: Column, weight: Column) -> Column:
    """Sum of weight times value over the sum of weights; NULL when the weights cancel."""
    return F.try_divide(F.sum(weight * value), F.sum(weight))


def loan_rollup(loans: DataFrame, performing: Sequence[str] = PERFORMING) -> DataFrame:
    """All per-(customer, cutoff) figures of the raw loan panel in one aggregation.

    It feeds the customer figures, the portfolio series and the imputations, so the panel
    is scanned and shuffled once for all of them.
    """
    # Texts are converted before the rows are sorted by key: once each, and into narrower rows.
    typed = loans.select(
        "id_cliente", as_day("fecha_corte").alias("fecha_corte"), "id_credito",
        as_money("saldo_capital").alias("balance"), as_rate("tasa_nominal_anual_pct").alias("rate"),
        as_money("provision_constituida").alias("provision"), as_money("el_expected_loss").alias("loss"),
        as_money("saldo_total_exposicion").alias("exposure"), as_money("ingresos_anuales").alias("income"),
        F.col("calificacion_sbs").alias("rating"), F.col("oficial_credito").alias("officer"),
    )
    balance = F.col("balance")
    healthy = F.col("rating").isin(*performing)
    return typed.groupBy("id_cliente", "fecha_corte").agg(
        F.sum("provision").alias("provisions"),
        F.sum("loss").alias("expected_loss"),
        F.sum("exposure").alias("exposure"),
        F.sum("income").alias("income"),
        weighted_avg(F.col("rate"), balance).alias("weighted_rate"),
        F.count("*").alias("n_loans"),
        F.max("rating").alias("rating"),
        F.sum(balance).alias("balance"),
        F.sum(F.when(healthy, balance)).alias("performing_balance"),
        F.max("officer").alias("officer"),
        F.min_by("income", F.struct("id_credito")).alias("first_loan_income"),
    )


ROLLUP_FIGURES = [
    "provisions", "expected_loss", "exposure", "income", "weighted_rate", "n_loans", "rating",
]


def latest_rollup(rolled: DataFrame) -> DataFrame:
    """Per customer: the figures of the last cutoff, tenure, officer and first income.

    (id_cliente, fecha_corte) is unique after ``loan_rollup``, so the date alone decides.
    """
    date = F.struct("fecha_corte")
    return (
        rolled.groupBy("id_cliente")
        .agg(
            F.max_by(F.struct(*ROLLUP_FIGURES), date).alias("_last"),
            F.min_by(F.struct("first_loan_income"), date).alias("_first"),
            F.min("fecha_corte").alias("first_cutoff"),
            F.max("fecha_corte").alias("last_cutoff"),
            F.max("officer").alias("loan_officer"),
        )
        .select(
            "id_cliente", "first_cutoff", "last_cutoff",
            *[F.col(f"_last.{f}").alias(f) for f in ROLLUP_FIGURES],
            month_gap("first_cutoff", "last_cutoff").alias("tenure_months"),
            "loan_officer", F.col("_first.first_loan_income").alias("first_income"),
        )
    )


def rank_cutoffs(rolled: DataFrame) -> DataFrame:
    """Rank of every cutoff within its customer, newest first, and months since the first.

    The window runs on rolled-up rows: a customer has at most one per cutoff date.
    """
    customer = Window.partitionBy("id_cliente")
    return rolled.select(
        "id_cliente", "fecha_corte",
        F.row_number().over(customer.orderBy(F.desc("fecha_corte"))).alias("ranking"),
        month_gap(F.min("fecha_corte").over(customer), F.col("fecha_corte")).alias("tenure_months"),
    )


def latest_sum(loans: DataFrame, amount: str, alias: str) -> DataFrame:
    """Per customer, the sum of one amount over the loans of the last cutoff."""
    by_cutoff = loans.groupBy("id_cliente", as_day("fecha_corte").alias("fecha_corte")).agg(
        F.sum(as_money(amount)).alias(alias)
    )
    latest = latest_amount(by_cutoff, ["id_cliente"], F.col("fecha_corte"), F.col(alias), "decimal(28,2)")
    return latest.withColumnRenamed("amount", alias)


def loan_latest_instalment(loans: DataFrame) -> DataFrame:
    """Per loan, the instalment of the last cutoff."""
    latest = latest_amount(loans, ["id_credito"], as_day("fecha_corte"), as_money("cuota_mensual"), MONEY)
    return latest.withColumnRenamed("amount", "cuota_mensual")


def first_income(loans: DataFrame, alias: str = "first_income") -> DataFrame:
    """Per customer, the income of the earliest loan record; ties go to the lowest loan id."""
    return first_per_key(
        loans,
        ["id_cliente"],
        [as_day("fecha_corte"), "id_credito"],
        {alias: as_money("ingresos_anuales")},
    )


def recent_income(loans: DataFrame, alias: str = "recent_income") -> DataFrame:
    """Per customer, the income of the last loan record; ties go to the highest loan id."""
    return latest_per_key(
        loans,
        ["id_cliente"],
        [as_day("fecha_corte"), "id_credito"],
        {alias: as_money("ingresos_anuales")},
    )
