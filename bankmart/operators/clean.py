"""Cleaning steps: exclusion policies, repairs and imputations, one function each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from bankmart.functions import (
    as_day, as_money, as_rate, as_type, as_whole, col, instalment_delay,
    normalize_sector, payment_channel, ratio, rating_from_days,
)
from bankmart.operators.joins import fair_share, hot_keys, lookup
from bankmart.operators.rollup import loan_latest_instalment
from bankmart.operators.rules import deposit_levy, profit_share
from bankmart.schemas import ASSET_PARTS, EQUITY_PARTS, EXCLUDED_DEBTS, POLICY_FLAGS
from bankmart.sources.raw import bad_cells
from bankmart.sources.staging import stage


# --- typing ------------------------------------------------------------------------------

def project_typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed projection of a raw table; text that does not convert becomes NULL."""
    return df.select(*[as_type(c, kind).alias(c) for c, kind in types.items()])


def cast_rejects(df: DataFrame, types: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """Non-empty cells that the typed projection would turn into NULL, with their keys."""
    return df.select(*keys, F.inline(bad_cells(types))).drop("kind")


# --- loan exclusions ---------------------------------------------------------------------

def exclude_chronology(loans: DataFrame) -> DataFrame:
    """Keep loans that fall due after they were paid out."""
    return loans.where(as_day("fecha_vencimiento") > as_day("fecha_desembolso"))


def exclude_policy_flags(loans: DataFrame, flags: Sequence[str] = POLICY_FLAGS) -> DataFrame:
    return loans.where(F.col("flag_error").isNull() | ~F.col("flag_error").isin(*flags))


def exclude_rate_range(loans: DataFrame, above="0", up_to="30") -> DataFrame:
    rate = as_rate("tasa_nominal_anual_pct")
    return loans.where(
        (rate > F.lit(above).cast("decimal(18,4)")) & (rate <= F.lit(up_to).cast("decimal(18,4)"))
    )


def exclude_score_range(df: DataFrame, low: int = 200, high: int = 850) -> DataFrame:
    return df.where(as_money("score_crediticio").between(low, high))


def exclude_negative_balance(loans: DataFrame) -> DataFrame:
    return loans.where(as_money("saldo_capital") >= 0)


# --- loan repairs ------------------------------------------------------------------------

def clamp_days(df: DataFrame, days: str = "dias_atraso") -> DataFrame:
    """Negative days past due become zero; missing days stay missing."""
    return df.withColumn(days, F.when(F.col(days) < 0, F.lit(0)).otherwise(F.col(days)))


def sector_labels(df: DataFrame, field: str = "sector_economico") -> DataFrame:
    return df.withColumn(field, normalize_sector(field))


# --- income statement --------------------------------------------------------------------

def abs_repair(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.abs(F.col(f)) for f in fields})


def derive_margins(df: DataFrame) -> DataFrame:
    gross = F.col("total_ingresos") - F.col("total_gastos_financieros")
    return df.withColumns({
        "margen_financiero_bruto": gross,
        "margen_financiero_neto": gross - F.col("gasto_provisiones_periodo"),
        "utilidad_neta": F.col("resultado_antes_impuestos")
        - F.col("participacion_trabajadores_15pct") - F.col("impuesto_renta_25pct"),
    })


def profit_share_column(df: DataFrame, source: str = "resultado_antes_impuestos") -> DataFrame:
    """Workers' share from the raw, still signed result."""
    return df.withColumn("participacion_trabajadores_15pct", profit_share(as_money(source)))


# --- balance sheet -----------------------------------------------------------------------

def portfolio_from_loans(loans: DataFrame, performing: Sequence[str]) -> DataFrame:
    """Gross and performing portfolio per cutoff in one aggregation."""
    balance = as_money("saldo_capital")
    return loans.groupBy(as_day("fecha_corte").alias("fecha_mes")).agg(
        F.sum(balance).alias("cartera_bruta"),
        F.sum(F.when(F.col("calificacion_sbs").isin(*performing), balance)).alias("cartera_vigente"),
    )


def rebuild_totals(df: DataFrame) -> DataFrame:
    """Equity, assets and deposit levy from their components."""
    assets = F.col("cartera_bruta") - F.col("provisiones_acumuladas")
    for part in ASSET_PARTS:
        if part != "cartera_bruta":
            assets = assets + F.col(part)
    return df.withColumns({
        "total_patrimonio": reduce(add, [F.col(c) for c in EQUITY_PARTS]),
        "total_activos": assets,
        "aporte_cosede": deposit_levy(F.col("total_obligaciones_publico")),
    })


# --- payments ----------------------------------------------------------------------------

def abs_paid(payments: DataFrame) -> DataFrame:
    return abs_repair(payments, ["monto_pagado"])


def impute_channel(payments: DataFrame) -> DataFrame:
    return payments.withColumn("canal_pago", payment_channel("canal_pago", "monto_pagado"))


def repair_delay(payments: DataFrame) -> DataFrame:
    return payments.withColumn(
        "dias_retraso_pago", instalment_delay("dias_retraso_pago", "monto_pagado")
    )


def early_payment_flag(payments: DataFrame, days: str = "dias_retraso_pago") -> DataFrame:
    """True for a paid instalment with negative delay days (before the delay is repaired)."""
    early = (F.col(days) < 0) & (F.col("monto_pagado") > 0)
    return payments.withColumn("es_pago_anticipado", F.coalesce(early, F.lit(False)))


def instalments(payments: DataFrame, loans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The latest instalments and the hot loans of all payments, written once for payments that come in parts."""
    hot = hot_keys(payments, ["id_credito"], fair_share(payments))
    return stage(loan_latest_instalment(loans), "latest_instalment", "zstd"), stage(hot, "hot_loans")


def impute_instalment(
    payments: DataFrame, loans: DataFrame, found: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Take the loan's latest instalment where it differs; NULL on either side keeps own.

    ``found`` are the ``instalments`` written before.
    """
    latest, hot = found or (loan_latest_instalment(loans), None)
    own, theirs = F.col("cuota_pactada"), F.col("cuota_mensual")
    return (
        lookup(payments, latest, ["id_credito"], hot=hot)
        .withColumn("cuota_pactada", F.when(own != theirs, theirs).otherwise(own))
        .drop("cuota_mensual")
    )


# --- customers ---------------------------------------------------------------------------

def fix_arrears_without_balance(customers: DataFrame) -> DataFrame:
    """Late days without an arrears balance: clear flag and days, and mark the row."""
    unbacked = (as_money("saldo_mora_total") == 0) & (as_whole("max_dias_atraso") > 0)

    def swap(field: str, text: str) -> Column:
        return F.when(unbacked, F.lit(text)).otherwise(F.col(field))

    return customers.withColumns({
        "tiene_credito_en_mora": swap("tiene_credito_en_mora", "0"),
        "max_dias_atraso": swap("max_dias_atraso", "0"),
        "flag_error": swap("flag_error", "MORA_SIN_SALDO"),
    })


def impute_rating(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "calificacion_consolidada",
        F.coalesce(F.col("calificacion_consolidada"), rating_from_days("max_dias_atraso")),
    )


def loan_officers(loans: DataFrame) -> DataFrame:
    return loans.groupBy("id_cliente").agg(F.max("oficial_credito").alias("loan_officer"))


def impute_officer(customers: DataFrame, loans: DataFrame) -> DataFrame:
    """Own officer, else the last one in text order among the customer's loans."""
    joined = customers.join(loan_officers(loans), "id_cliente", "left")
    officer = F.coalesce(F.col("oficial_credito"), F.col("loan_officer"))
    return joined.withColumn("oficial_credito", officer).drop("loan_officer")


def fix_company_age(df: DataFrame) -> DataFrame:
    age = F.when(F.col("tipo_persona") == "Natural", F.lit(0).cast("decimal(18,2)"))
    return df.withColumn("edad_empresa_anos", age.otherwise(F.col("edad_empresa_anos")))


def debt_to_income(exposure: Column | str, income: Column | str) -> Column:
    """Exposure in percent of income, NULL without income."""
    return ratio(exposure, income) * 100


def preferred_flag(rating: Column | str, months: Column | str, loans: Column | str) -> Column:
    """1 for a Normal rating, over 24 months of tenure and more than one loan."""
    good = (col(rating) == "Normal") & (col(months) > 24) & (col(loans) > 1)
    return F.when(good, F.lit(1)).otherwise(F.lit(0))


def abs_debt(df: DataFrame) -> DataFrame:
    return abs_repair(df, ["saldo_total_deuda", "saldo_mora_total"])


def exclude_customers(
    df: DataFrame,
    debts: Sequence[str] = EXCLUDED_DEBTS,
    max_rate: int = 100,
    low_score: int = 200,
    high_score: int = 850,
) -> DataFrame:
    """Drop customers by listed debt amounts, arrears rate and score range."""
    amounts = [F.lit(d).cast("decimal(18,2)") for d in debts]
    keep = (F.col("tasa_mora_cliente_pct") <= max_rate) & F.col("score_crediticio").between(
        low_score, high_score
    )
    if amounts:
        keep = keep & ~F.col("saldo_total_deuda").isin(*amounts)
    return df.where(keep)
