"""KPI measures as monthly series, for the whole bank or for any slice.

A measure is a column of a monthly table: sums are taken once per (slice, month), and the
previous available month is the row before it. Blank values follow one rule: they count as
zero in a difference, unless both sides are blank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankmart.functions import col, direction, month_index, ratio, status_band
from bankmart.operators.dimension import with_calendar_parts
from bankmart.schemas import IN_ARREARS, PERFORMING

MONTH = "fecha_mes"


# --- building blocks ---------------------------------------------------------------------

def as_of(monthly: DataFrame) -> DataFrame:
    """The last month present in a monthly table."""
    return monthly.agg(F.max(MONTH).alias("as_of"))


def at_last_month(series: DataFrame, monthly: DataFrame) -> DataFrame:
    """Rows of a series at the last month of ``monthly``."""
    return series.where(F.col(MONTH) == as_of(monthly).scalar())


def _by_month(by: Sequence[str]):
    """Month order within a slice. Monthly tables have one row per slice and month."""
    return Window.partitionBy(*by).orderBy(MONTH)


def difference(value: Column | str, previous: Column | str) -> Column:
    v, p = col(value), col(previous)
    zero = F.lit(0)
    return F.when(v.isNotNull() | p.isNotNull(), F.coalesce(v, zero) - F.coalesce(p, zero))


def with_previous(
    series: DataFrame, value: str, by: Sequence[str] = (), previous_default=None
) -> DataFrame:
    """Add ``previous`` (the last available month before) and ``diff``."""
    before = F.lag(value).over(_by_month(by))
    if previous_default is not None:
        before = F.coalesce(before, F.lit(previous_default))
    return series.withColumn("previous", before).withColumn("diff", difference(value, "previous"))


def loan_sums(rating_col: str = "calificacion_sbs") -> list[Column]:
    """The loan figures every portfolio KPI is made of."""
    balance = F.col("saldo_capital")
    # A narrower product of the two probabilities keeps all decimals of the amount.
    chance = F.col("pd_probabilidad_default") * F.col("lgd_loss_given_default")
    loss = chance.try_cast("decimal(19,8)") * balance
    return [
        F.sum(balance).alias("portfolio"),
        F.sum(F.when(F.col(rating_col).isin(*IN_ARREARS), balance)).alias("in_arrears"),
        F.sum(F.when(F.col(rating_col).isin(*PERFORMING), balance)).alias("performing"),
        F.sum("provision_constituida").alias("provisions"),
        F.sum(loss).alias("expected_loss"),
    ]


def loan_months(
    credits: DataFrame,
    by: Sequence[str] = (),
    date_col: str = "fecha_corte",
    rating_col: str = "calificacion_sbs",
) -> DataFrame:
    """Monthly loan sums per slice, taken in one pass over the fact.

    ``date_col`` chooses the date role: the cutoff (default), which is a month-end as it
    stands, or another date, such as the disbursement, which counts for its month-end.
    """
    month = F.col(date_col) if date_col == "fecha_corte" else F.last_day(date_col)
    return credits.groupBy(*by, month.alias(MONTH)).agg(*loan_sums(rating_col))


SLICES = {
    "segment": "segmento", "zone": "zona_geografica", "officer": "oficial_credito",
    "product": "producto_crediticio",
}


def slice_months(
    credits: DataFrame, slices: Mapping[str, str] = SLICES, date_col: str = "fecha_corte"
) -> DataFrame:
    """Monthly loan sums of every slice and of the total, from one pass over the fact.

    Rows are (``slice``, ``slice_value``, month): the name of the slice and its value, or
    ``total`` and NULL. The loans are first summed per combination of all slices, on the map
    side; only these few rows are repeated for the grouping sets.
    """
    columns = list(slices.values())
    base = loan_months(credits, columns, date_col)
    figures = [c for c in base.columns if c not in (*columns, MONTH)]
    sets = [[MONTH], *[[MONTH, c] for c in columns]]
    named = [F.when(F.grouping(c) == 0, F.lit(name)) for name, c in slices.items()]
    # Of the slice columns all but the grouped one are NULL in a row.
    value = F.coalesce(*[F.col(c).cast("string") for c in columns])
    grouped = base.groupingSets(sets, MONTH, *columns).agg(
        F.coalesce(*named, F.lit("total")).alias("slice"), *[F.sum(f).alias(f) for f in figures]
    )
    return grouped.select("slice", value.alias("slice_value"), MONTH, *figures)


INCOME_SUMS = [
    "utilidad_neta", "margen_financiero_bruto", "gasto_provisiones_periodo", "castigos_periodo",
]
BALANCE_SUMS = [
    "total_patrimonio", "total_activos", "cartera_bruta", "cartera_vigente", "inversiones",
    "operaciones_interbancarias_activo", "tasa_mora_pct_t1", "cobertura_provision_pct_t1",
    "indice_liquidez_pct", "indice_solvencia_pct",
]


def bank_months(income: DataFrame, balance: DataFrame) -> DataFrame:
    """One row per income month, with the balance sums of the same date."""
    earned = income.groupBy(MONTH).agg(*[F.sum(c).alias(c) for c in INCOME_SUMS])
    held = balance.groupBy(MONTH).agg(*[F.sum(c).alias(c) for c in BALANCE_SUMS])
    return earned.join(held, MONTH, "left")


def productive_assets() -> Column:
    parts = ["cartera_bruta", "inversiones", "operaciones_interbancarias_activo"]
    some = F.coalesce(*parts).isNotNull()
    zero = F.lit(0)
    return F.when(some, sum((F.coalesce(F.col(p), zero) for p in parts[1:]), F.coalesce(F.col(parts[0]), zero)))


# --- profitability -----------------------------------------------------------------------

def kpi_return(months: DataFrame, on: str) -> DataFrame:
    """Net income over ``total_patrimonio`` (ROE) or ``total_activos`` (ROA)."""
    series = months.select(
        MONTH, F.col("utilidad_neta").alias("net_income"), F.col(on).alias("base"),
        ratio("utilidad_neta", on).alias("value"),
    )
    return with_previous(series, "value")


def kpi_roe(months: DataFrame) -> DataFrame:
    return kpi_return(months, "total_patrimonio")


def kpi_roa(months: DataFrame) -> DataFrame:
    return kpi_return(months, "total_activos")


def kpi_nim(months: DataFrame) -> DataFrame:
    """Gross margin over the mean productive assets of this and the previous month."""
    order = _by_month(())
    series = months.select(
        MONTH, F.col("margen_financiero_bruto").alias("margin"),
        productive_assets().alias("assets"),
    ).withColumn("assets_before", F.lag("assets").over(order))
    mean = (F.coalesce("assets", F.lit(0)) + F.coalesce("assets_before", F.lit(0))) / 2
    series = series.withColumn("assets_mean", mean)
    series = series.withColumn("value", ratio("margin", "assets_mean"))
    return with_previous(series, "value", previous_default=0.0)


# --- indices stored in the balance sheet -------------------------------------------------

def kpi_index(months: DataFrame, column: str) -> DataFrame:
    """An index in percent units that is only summed, with its previous month."""
    return with_previous(months.select(MONTH, F.col(column).alias("value")), "value")


def kpi_arrears_index(months: DataFrame) -> DataFrame:
    return kpi_index(months, "tasa_mora_pct_t1")


def kpi_coverage(months: DataFrame) -> DataFrame:
    return kpi_index(months, "cobertura_provision_pct_t1")


def kpi_liquidity(months: DataFrame) -> DataFrame:
    return kpi_index(months, "indice_liquidez_pct")


def kpi_solvency(months: DataFrame) -> DataFrame:
    return kpi_index(months, "indice_solvencia_pct")


def kpi_status(months: DataFrame) -> DataFrame:
    """Traffic light of the liquidity and solvency indices."""
    return months.select(
        MONTH,
        F.col("indice_liquidez_pct").alias("liquidity"),
        status_band("indice_liquidez_pct").alias("liquidity_status"),
        F.col("indice_solvencia_pct").alias("solvency"),
        status_band("indice_solvencia_pct").alias("solvency_status"),
    )


# --- loan portfolio ----------------------------------------------------------------------

def kpi_arrears_rate(loan_series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Arrears share of the portfolio per slice and month, with the previous month."""
    series = loan_series.select(
        *by, MONTH, "portfolio", "in_arrears", "performing",
        ratio(F.coalesce("in_arrears", F.lit(0)), F.col("portfolio")).alias("arrears_rate"),
    )
    return with_previous(series, "arrears_rate", by)


def kpi_coverage_manual(loan_series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return loan_series.select(
        *by, MONTH, "provisions", "in_arrears", ratio("provisions", "in_arrears").alias("value")
    )


def kpi_risk_coverage(loan_series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Arrears portfolio over provisions, 0 when there is nothing to divide."""
    return loan_series.select(
        *by, MONTH, "in_arrears", "provisions",
        ratio("in_arrears", "provisions", 0.0).alias("value"),
    )


def kpi_cost_of_risk(
    loan_series: DataFrame, by: Sequence[str] = (), mode: str = "month"
) -> DataFrame:
    """Provisions over the portfolio, 0 when undefined.

    ``mode='month'`` divides by the portfolio of the same month, which is what the measure
    evaluates to at one month; ``'average'`` by the mean monthly portfolio so far.
    """
    base = F.col("portfolio").cast("double")
    if mode == "average":
        base = F.avg(base).over(_by_month(by).rowsBetween(Window.unboundedPreceding, 0))
    series = loan_series.select(
        *by, MONTH, "provisions", "portfolio", ratio(F.col("provisions"), base, 0.0).alias("value")
    )
    return with_previous(series, "value", by)


def kpi_expected_loss(loan_series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return loan_series.select(*by, MONTH, "expected_loss")


def kpi_loan_counts(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct loans of a fact, per slice or in total."""
    return fact.groupBy(*by).agg(F.count_distinct("id_credito").alias("n_loans"))


def kpi_loan_balance(credits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return credits.groupBy(*by).agg(F.sum("saldo_capital").alias("portfolio"))


def kpi_portfolio_by_rating(credits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Arrears and performing portfolio over a whole selection, per slice."""
    balance = F.col("saldo_capital")
    return credits.groupBy(*by).agg(
        F.sum(F.when(F.col("calificacion_sbs").isin(*IN_ARREARS), balance)).alias("in_arrears"),
        F.sum(F.when(F.col("calificacion_sbs").isin(*PERFORMING), balance)).alias("performing"),
    )


# --- trailing twelve months --------------------------------------------------------------

def trailing(months: DataFrame, value: str, how, length: int = 12) -> DataFrame:
    """Aggregate of the calendar months in a trailing window, gaps included as gaps."""
    window = Window.orderBy("_month").rangeBetween(1 - length, 0)
    indexed = months.select(MONTH, F.col(value), month_index(MONTH).alias("_month"))
    return indexed.select(MONTH, how(F.col(value)).over(window).alias("value"))


def kpi_provisions_12m(months: DataFrame) -> DataFrame:
    return trailing(months, "gasto_provisiones_periodo", F.sum)


def kpi_portfolio_avg_12m(months: DataFrame) -> DataFrame:
    return trailing(months.withColumn("cartera_bruta", F.col("cartera_bruta").cast("double")),
                    "cartera_bruta", F.avg)


# --- portfolio charts --------------------------------------------------------------------

GRAINS = {"month": "mes_corto", "quarter": "trimestre"}


def period_totals(months: DataFrame, value: str, grain: str = "month") -> DataFrame:
    """Totals by short month name or quarter over the whole selection."""
    label = GRAINS[grain]
    return with_calendar_parts(months.select(MONTH, value), MONTH).groupBy(
        F.col(label).alias("period")
    ).agg(F.sum(value).alias("total"))


def kpi_portfolio_series(months: DataFrame, grain: str = "month") -> DataFrame:
    """Gross and performing portfolio per calendar month or quarter, with the largest month."""
    parts = with_calendar_parts(months.select(MONTH, "cartera_bruta", "cartera_vigente"), MONTH)
    keys = ["ano", "mes"] if grain == "month" else ["ano", "trimestre"]
    return parts.groupBy(*keys).agg(
        F.sum("cartera_bruta").alias("gross"),
        F.sum("cartera_vigente").alias("performing"),
        F.max("cartera_bruta").alias("gross_max"),
    )


def kpi_extremes_year(months: DataFrame, value: str) -> DataFrame:
    """Months of the current year whose value is the year's largest or smallest."""
    year = F.year(MONTH)
    current = months.agg(F.max(year)).scalar()
    rows = months.where(year == current).select(MONTH, F.col(value).alias("value"))
    whole = Window.partitionBy(F.year(MONTH))
    flagged = rows.withColumns({
        "is_max": F.col("value") == F.max("value").over(whole),
        "is_min": F.col("value") == F.min("value").over(whole),
    })
    return flagged.where(F.col("is_max") | F.col("is_min"))


def kpi_extremes_period(
    months: DataFrame, value: str, grain: str = "month", year: int | None = None
) -> DataFrame:
    """Largest and smallest period total of a selection; at most twelve or four periods."""
    chosen = months if year is None else months.where(F.year(MONTH) == year)
    totals = period_totals(chosen, value, grain)
    whole = Window.partitionBy()
    flagged = totals.select(
        "period", "total",
        (F.col("total") == F.max("total").over(whole)).alias("is_max"),
        (F.col("total") == F.min("total").over(whole)).alias("is_min"),
    )
    return flagged.where(F.col("is_max") | F.col("is_min"))


def kpi_period_param(months: DataFrame, grain: str) -> DataFrame:
    """Name of the period every month belongs to, by the chosen grain."""
    label = "nombre_mes" if grain == "month" else "trimestre"
    return with_calendar_parts(months.select(MONTH), MONTH).select(
        MONTH, F.col(label).alias("period")
    )


# --- write-offs --------------------------------------------------------------------------

def kpi_writeoffs(months: DataFrame) -> DataFrame:
    return with_previous(months.select(MONTH, F.col("castigos_periodo").alias("value")), "value")


def kpi_writeoff_reference(months: DataFrame) -> DataFrame:
    """Per year: mean month of all earlier years, and last year's month and quarter."""
    yearly = months.groupBy(F.year(MONTH).alias("ano")).agg(
        F.sum("castigos_periodo").alias("_sum"), F.count("castigos_periodo").alias("_n")
    )
    earlier = Window.orderBy("ano").rowsBetween(Window.unboundedPreceding, -1)
    last_year = Window.orderBy("ano").rangeBetween(-1, -1)
    previous = F.sum("_sum").over(last_year).cast("double")
    return yearly.select(
        "ano",
        ratio(F.sum("_sum").over(earlier), F.sum("_n").over(earlier)).alias("mean_earlier"),
        (previous / 12).alias("per_month"),
        (previous / 4).alias("per_quarter"),
    )


def kpi_writeoff_alert(months: DataFrame, grain: str = "month") -> DataFrame:
    """Period write-offs against both references of their year."""
    parts = with_calendar_parts(months.select(MONTH, "castigos_periodo"), MONTH)
    period = "mes" if grain == "month" else "trimestre"
    totals = parts.groupBy("ano", F.col(period).cast("string").alias("period")).agg(
        F.sum("castigos_periodo").alias("writeoffs")
    )
    reference = kpi_writeoff_reference(months)
    over = "per_month" if grain == "month" else "per_quarter"
    value = F.col("writeoffs").cast("double")
    return totals.join(reference, "ano").select(
        "ano", "period", "writeoffs", F.col(over).alias("reference"), "mean_earlier",
        F.coalesce(value > F.coalesce(F.col(over), F.lit(0.0)), F.lit(False)).alias("over_last_year"),
        F.coalesce(value > F.coalesce(F.col("mean_earlier"), F.lit(0.0)), F.lit(False)).alias("over_mean"),
    )


# --- scorecard ---------------------------------------------------------------------------

def kpi_general(income: DataFrame, balance: DataFrame, credits: DataFrame) -> DataFrame:
    """Every unfiltered measure over the whole selection, in one row.

    Each fact is aggregated to a single row; scalar subqueries put them side by side.
    """
    loans = credits.agg(*loan_sums())
    loan = {c: loans.select(c).scalar() for c in ("portfolio", "in_arrears", "provisions")}
    held = balance.agg(*[F.sum(c).alias(c) for c in BALANCE_SUMS])
    hold = {c: held.select(c).scalar() for c in BALANCE_SUMS}
    return income.agg(
        F.sum("utilidad_neta").alias("_net"), F.sum("castigos_periodo").alias("writeoffs"),
    ).select(
        ratio(F.col("_net"), hold["total_patrimonio"]).alias("roe"),
        ratio(F.col("_net"), hold["total_activos"]).alias("roa"),
        hold["tasa_mora_pct_t1"].alias("arrears"),
        hold["cobertura_provision_pct_t1"].alias("coverage"),
        ratio(loan["provisions"], loan["portfolio"], 0.0).alias("cost_of_risk"),
        ratio(loan["in_arrears"], loan["provisions"], 0.0).alias("risk_coverage"),
        hold["indice_liquidez_pct"].alias("liquidity"),
        hold["indice_solvencia_pct"].alias("solvency"),
        "writeoffs",
    )


# (name, whether a rise is an improvement, whether it has a traffic light)
SCORECARD = [
    ("roe", True, False), ("roa", True, False), ("nim", True, False),
    ("liquidity", True, True), ("solvency", True, True), ("arrears", False, False),
    ("coverage", True, False), ("cost_of_risk", False, False),
]


def kpi_direction(series: DataFrame, value: str, higher_is_better: bool) -> DataFrame:
    """Trend of a series and whether it is an improvement."""
    trend, good = direction("diff", higher_is_better)
    return series.select(MONTH, F.col(value).alias("value"), "previous", "diff",
                         trend.alias("trend"), good.alias("good"))


def scorecard_series(
    income: DataFrame, balance: DataFrame, credits: DataFrame, cost_mode: str = "month"
) -> DataFrame:
    """The eight headline KPIs per month in long form.

    All monthly values come from one joined table with a row per month; the KPIs are laid
    out side by side and unpivoted, so no fact is scanned once per KPI.
    """
    loans = credits.groupBy(F.col("fecha_corte").alias(MONTH)).agg(
        F.sum("saldo_capital").alias("portfolio"), F.sum("provision_constituida").alias("provisions")
    )
    months = bank_months(income, balance).join(loans, MONTH, "left")
    order = _by_month(())
    assets = F.coalesce(productive_assets(), F.lit(0))
    months = months.withColumn("_assets", assets)
    mean = (F.col("_assets") + F.coalesce(F.lag("_assets").over(order), F.lit(0))) / 2
    base = F.col("portfolio").cast("double")
    if cost_mode == "average":
        base = F.avg(base).over(order.rowsBetween(Window.unboundedPreceding, 0))
    wide = months.select(
        MONTH,
        ratio("utilidad_neta", "total_patrimonio").alias("roe"),
        ratio("utilidad_neta", "total_activos").alias("roa"),
        ratio(F.col("margen_financiero_bruto"), mean).alias("nim"),
        F.col("indice_liquidez_pct").cast("double").alias("liquidity"),
        F.col("indice_solvencia_pct").cast("double").alias("solvency"),
        F.col("tasa_mora_pct_t1").cast("double").alias("arrears"),
        F.col("cobertura_provision_pct_t1").cast("double").alias("coverage"),
        ratio(F.col("provisions"), base, 0.0).alias("cost_of_risk"),
    )
    cards = []
    for name, rising_is_good, has_status in SCORECARD:
        previous = F.lag(name).over(order)
        if name == "nim":
            previous = F.coalesce(previous, F.lit(0.0))
        diff = difference(F.col(name), previous)
        trend, good = direction(diff, rising_is_good)
        status = status_band(name) if has_status else F.lit(None).cast("string")
        cards.append(F.struct(
            F.lit(name).alias("kpi"), F.col(name).alias("value"), previous.alias("previous"),
            diff.alias("diff"), trend.alias("trend"), good.alias("good"), status.alias("status"),
        ))
    return wide.select(MONTH, F.array(*cards).alias("_cards")).select(
        MONTH, F.explode("_cards").alias("_card")
    ).select(MONTH, "_card.*")


def kpi_scorecard(
    income: DataFrame, balance: DataFrame, credits: DataFrame, as_of_month=None,
    cost_mode: str = "month",
) -> DataFrame:
    """Scorecard of one month, the last income month unless another is given.

    A card needs its month, the month before and, for the mean assets of that one, a third,
    so only their partitions of the facts are read. ``cost_mode='average'`` takes the mean
    portfolio so far and reads all months before. Rows without a month are on no card.
    """
    last = as_of(income).scalar() if as_of_month is None else F.lit(as_of_month).cast("date")
    known = income.where(F.col(MONTH) <= last).select(MONTH).distinct()
    first = known.orderBy(F.desc(MONTH)).limit(3).agg(F.min(MONTH)).scalar()

    def needed(df: DataFrame, month: str) -> DataFrame:
        upto = df.where(F.col(month) <= last)
        return upto if cost_mode == "average" else upto.where(F.col(month) >= first)

    series = scorecard_series(
        needed(income, MONTH), needed(balance, MONTH), needed(credits, "fecha_corte"), cost_mode
    )
    return series.where(F.col(MONTH) == last)
