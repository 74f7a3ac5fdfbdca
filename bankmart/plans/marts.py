"""The five cleaned tables, as lazily evaluated DataFrame functions of the raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bankmart.functions import as_day, as_money, as_rate, normalize_sector, replace_if_differs
from bankmart.operators import clean
from bankmart.operators.rollup import latest_rollup, loan_rollup
from bankmart.sources import RawTables, stage
from bankmart.schemas import (
    BALANCE_AMOUNTS, CUSTOMER_TYPES, INCOME_AMOUNTS, LOAN_TYPES, MONEY, PAYMENT_TYPES,
    PERFORMING,
)

# Rebuilt from components or from loans, so not taken from the raw balance sheet.
BALANCE_REBUILT = {"cartera_bruta", "total_activos", "total_patrimonio", "aporte_cosede"}
# Derived, or left out of the cleaned income statement.
INCOME_DROPPED = {
    "margen_financiero_bruto", "margen_financiero_neto", "utilidad_neta",
    "participacion_trabajadores_15pct", "gasto_depreciacion", "gasto_amortizacion",
    "otros_gastos_operativos", "otras_perdidas_operacionales", "otros_gastos",
}

# Customer columns that are replaced by what the loans say, and where that stands.
RECOMPUTED = {
    "provision_total_cliente": "provisions", "el_total_cliente": "expected_loss",
    "tasa_nominal_promedio": "weighted_rate", "ingresos_anuales": "first_income",
}


def mart_credits(loans: DataFrame) -> DataFrame:
    """Loan panel without excluded rows, typed, with repaired days and sector."""
    kept = clean.exclude_chronology(loans)
    kept = clean.exclude_policy_flags(kept)
    kept = clean.exclude_rate_range(kept)
    kept = clean.exclude_score_range(kept)
    kept = clean.exclude_negative_balance(kept)
    typed = clean.project_typed(kept, LOAN_TYPES)
    return clean.sector_labels(clean.clamp_days(typed))


def mart_income(income: DataFrame, keep_sign: bool = False) -> DataFrame:
    """Income statement with repaired signs and recomputed share, margins and net income.

    ``keep_sign`` leaves a negative pre-tax result negative.
    """
    amounts = [c for c in INCOME_AMOUNTS if c not in INCOME_DROPPED]
    with_share = clean.profit_share_column(income)
    typed = with_share.select(
        as_day("fecha_mes").alias("fecha_mes"),
        *[as_rate(c).alias(c) for c in amounts],
        "participacion_trabajadores_15pct",
    )
    repair = ["gasto_provisiones_periodo"]
    if not keep_sign:
        repair.append("resultado_antes_impuestos")
    return clean.derive_margins(clean.abs_repair(typed, repair))


def mart_balance(
    balance: DataFrame, loans: DataFrame, rolled: DataFrame | None = None
) -> DataFrame:
    """Balance sheet with the portfolio summed from loans and totals rebuilt.

    ``loans`` is the raw panel in the default model; pass the cleaned one to build the
    portfolio from cleaned loans. ``rolled`` is an existing ``loan_rollup`` to share.
    """
    amounts = [c for c in BALANCE_AMOUNTS if c not in BALANCE_REBUILT]
    typed = balance.select(
        as_day("fecha_mes").alias("fecha_mes"), *[as_money(c).alias(c) for c in amounts]
    )
    if rolled is None:
        portfolio = clean.portfolio_from_loans(loans, PERFORMING)
    else:
        portfolio = rolled.groupBy(F.col("fecha_corte").alias("fecha_mes")).agg(
            F.sum("balance").alias("cartera_bruta"),
            F.sum("performing_balance").alias("cartera_vigente"),
        )
    return clean.rebuild_totals(typed.join(portfolio, "fecha_mes", "left"))


def mart_payments(
    payments: DataFrame, loans: DataFrame, found: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Payments with absolute amounts, imputed channel and instalment, repaired delay.

    ``found`` are the written ``clean.instalments`` for payments that come in parts.
    """
    typed = clean.abs_paid(clean.project_typed(payments, PAYMENT_TYPES))
    repaired = clean.impute_channel(clean.repair_delay(clean.early_payment_flag(typed)))
    return clean.impute_instalment(repaired, loans, found)


def mart_customers(
    customers: DataFrame,
    loans: DataFrame,
    rolled: DataFrame | None = None,
    fix_arrears: bool = True,
    **exclusions,
) -> DataFrame:
    """Customers with imputed and recomputed columns.

    ``rolled`` is an existing ``loan_rollup`` to share; both sides of the join have one
    row per customer.
    """
    raw = clean.fix_arrears_without_balance(customers) if fix_arrears else customers
    typed = clean.abs_debt(clean.project_typed(raw, CUSTOMER_TYPES))
    kept = clean.exclude_customers(typed, **exclusions)
    last = latest_rollup(loan_rollup(loans) if rolled is None else rolled).drop(
        "first_cutoff", "last_cutoff"
    )
    officer = F.coalesce(F.col("oficial_credito"), F.col("loan_officer"))
    joined = kept.join(last, "id_cliente", "left").withColumn("oficial_credito", officer)
    repaired = clean.fix_company_age(clean.impute_rating(joined))
    out = repaired.withColumns({
        "sector_economico": normalize_sector("sector_economico"),
        **{
            own: replace_if_differs(own, source, kind=CUSTOMER_TYPES[own])
            for own, source in RECOMPUTED.items()
        },
        "tasa_endeudamiento_sistema_pct": clean.debt_to_income("exposure", "income"),
        "es_cliente_preferente": clean.preferred_flag("rating", "tenure_months", "n_loans"),
    })
    return out.select(
        *CUSTOMER_TYPES, "tasa_endeudamiento_sistema_pct", "es_cliente_preferente"
    )


def build_marts(
    raw: RawTables, share: bool = True, rolled: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The five cleaned tables. ``share`` writes the loan roll-up once for those that use it, unless
    there is a written one (``rolled``).
    """
    if rolled is None:
        rolled = loan_rollup(raw.loans)
        if share:
            rolled = stage(rolled, "loan_rollup", "zstd")
    return {
        "credits": mart_credits(raw.loans),
        "income": mart_income(raw.income),
        "balance": mart_balance(raw.balance, raw.loans, rolled),
        "payments": mart_payments(raw.payments, raw.loans),
        "customers": mart_customers(raw.customers, raw.loans, rolled),
    }
