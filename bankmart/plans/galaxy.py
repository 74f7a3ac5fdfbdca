"""Dimensions and facts: several facts share the same conformed dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from bankmart.operators.clean import instalments
from bankmart.operators.dimension import (
    calendar_of, closed_domain_key, extend_key, surrogate_key, top1_per_key,
)
from bankmart.operators.joins import lookup
from bankmart.operators.keys import load_guard
from bankmart.operators.rollup import latest_per_key, loan_rollup
from bankmart.plans.marts import build_marts, mart_payments
from bankmart.schemas import CUSTOMER_KEYS, LOAN_TYPES
from bankmart.sources import RawTables, counted, in_rounds, release, stage_rounds, temporary_stages, write_counted

# --- fixed values: columns of the facts -------------------------------------------------
# Attributes a loan row reaches through its dimension keys instead.
LOAN_ATTRIBUTES = {
    "tipo_persona", "segmento", "zona_geografica", "producto_crediticio", "moneda",
    "calificacion_sbs", "tipo_garantia", "dias_atraso", "sector_economico",
}
PAYMENT_FACT = [
    "id_pago", "id_credito", "id_cliente", "id_calificacion_sk", "id_estado_PK",
    "id_cliente_PK", "fecha_pago_real", "fecha_vencimiento_cuota", "monto_capital_cuota",
    "monto_interes_cuota", "monto_pagado", "saldo_pendiente_cuota", "dias_retraso_pago",
]
CUSTOMER_FACT = [
    "id_cliente", "id_cliente_PK", "id_status_t5", "id_calificacion_sk",
    "fecha_primer_credito", "fecha_ultimo_corte", "num_creditos_activos",
    "num_creditos_sistema", "num_refinanciaciones", "score_crediticio", "max_dias_atraso",
    "tiene_credito_en_mora", "calificacion_consolidada", "provision_total_cliente",
    "el_total_cliente", "saldo_total_deuda", "saldo_mora_total", "tasa_mora_cliente_pct",
    "ingresos_anuales", "es_cliente_preferente", "edad_empresa_anos",
    "tasa_endeudamiento_sistema_pct",
]
INCOME_FACT = [
    "fecha_mes", "ing_intereses_cartera", "ing_intereses_inversiones",
    "ing_intereses_interbancarios", "ing_comisiones_ganadas", "ing_utilidades_financieras",
    "ing_servicios", "total_ingresos", "gasto_intereses_depositos",
    "gasto_intereses_obligaciones", "gasto_comisiones_pagadas", "total_gastos_financieros",
    "gasto_provisiones_periodo", "gasto_personal", "gasto_honorarios",
    "gasto_instalaciones", "gasto_publicidad", "total_gastos_operativos",
    "participacion_trabajadores_15pct", "impuesto_renta_25pct", "margen_financiero_bruto",
    "margen_financiero_neto", "utilidad_neta", "recuperaciones_periodo", "castigos_periodo",
]
BALANCE_FACT = [
    "fecha_mes", "fondos_disponibles", "operaciones_interbancarias_activo", "inversiones",
    "cartera_bruta", "cartera_vigente", "provisiones_acumuladas", "cartera_neta",
    "bienes_realizables_adjudicados", "propiedades_y_equipos", "otros_activos",
    "total_activos", "depositos_vista", "depositos_plazo", "depositos_ahorro",
    "total_obligaciones_publico", "operaciones_interbancarias_pasivo",
    "obligaciones_financieras_bde_cfn", "cuentas_por_pagar", "total_pasivos",
    "capital_social", "reserva_legal", "reserva_especial", "superavit_valuaciones",
    "utilidad_acumulada_ejercicio", "total_patrimonio", "activos_ponderados_riesgo",
    "indice_solvencia_pct", "indice_liquidez_pct", "aporte_cosede", "cartera_mora_t1",
    "tasa_mora_pct_t1", "provision_requerida_t1", "provision_constituida_t1",
    "cobertura_provision_pct_t1", "el_total_t1",
]

# Natural keys of the dimensions with a closed domain.
STATUS_FLAGS = ["es_cliente_preferente", "tiene_credito_en_mora"]
PRODUCT_PAIR = ["producto_crediticio", "tipo_garantia"]
STATE_PAIR = ["estado_pago", "canal_pago"]


# --- dimensions --------------------------------------------------------------------------

def dim_customer(credits: DataFrame, latest_only: bool = False) -> DataFrame:
    """Every attribute combination of a customer, or only that of the last cutoff."""
    if latest_only:
        attributes = [c for c in CUSTOMER_KEYS if c != "id_cliente"]
        base = latest_per_key(
            credits, ["id_cliente"], ["fecha_corte", "id_credito"],
            {c: F.col(c) for c in attributes},
        ).select(*CUSTOMER_KEYS)
    else:
        base = credits.select(*CUSTOMER_KEYS).distinct()
    return surrogate_key(base, CUSTOMER_KEYS, "id_cliente_PK")


def dim_status(customers: DataFrame) -> DataFrame:
    return closed_domain_key(customers.select(*STATUS_FLAGS).distinct(), STATUS_FLAGS, "id_status_t5")


def rating_domain(credits: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct union of the rating columns of three tables.

    Each branch is made distinct first: that lets the optimizer drop the left joins of a
    cleaned table, which cannot change the set of its ratings.
    """
    branches = [
        df.select(F.col(c).alias("calificacion")).distinct()
        for df, c in [
            (credits, "calificacion_sbs"), (customers, "calificacion_consolidada"),
            (payments, "calificacion_al_pago"),
        ]
    ]
    return branches[0].union(branches[1]).union(branches[2]).distinct()


def dim_rating(credits: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    domain = rating_domain(credits, customers, payments)
    return closed_domain_key(domain, ["calificacion"], "id_calificacion_sk")


def dim_product(credits: DataFrame) -> DataFrame:
    return closed_domain_key(credits.select(*PRODUCT_PAIR).distinct(), PRODUCT_PAIR, "id_producto_PK")


def dim_payment_state(payments: DataFrame) -> DataFrame:
    return closed_domain_key(payments.select(*STATE_PAIR).distinct(), STATE_PAIR, "id_estado_PK")


def dim_calendar(facts: Iterable[DataFrame]) -> DataFrame:
    """Calendar over the whole years of every date column of the facts."""
    ends = []
    for fact in facts:
        dates = [c for c, kind in fact.dtypes if kind == "date"]
        both = F.array(*[end(c) for c in dates for end in (F.min, F.max)])
        ends.append(fact.agg(both.alias("_ends")).select(F.explode("_ends").alias("fecha")))
    return calendar_of(reduce(DataFrame.unionAll, ends), "fecha")


# --- facts -------------------------------------------------------------------------------

def fact_credits(
    credits: DataFrame, customer: DataFrame, rating: DataFrame, product: DataFrame
) -> DataFrame:
    """Loan rows at (credit, cutoff) grain with three dimension keys.

    Only the customer dimension grows with the bank. The others have closed domains: the
    optimizer broadcasts them by the size of the written table.
    """
    rated = rating.withColumnRenamed("calificacion", "calificacion_sbs")
    keyed = lookup(credits, customer, CUSTOMER_KEYS).join(rated, "calificacion_sbs", "left")
    keyed = keyed.join(product, ["producto_crediticio", "tipo_garantia"], "left")
    columns = [c for c in LOAN_TYPES if c not in LOAN_ATTRIBUTES]
    return keyed.select(
        *columns[:3], "id_cliente_PK", "id_calificacion_sk", "id_producto_PK", *columns[3:]
    )


def best_customer(customer: DataFrame) -> DataFrame:
    """One customer-dimension row per (customer, segment, zone, officer).

    Rows with a known sector win, then a known person type, then the highest key.
    """
    keys = ["id_cliente", "segmento", "zona_geografica", "oficial_credito"]
    known = [F.col(c).isNotNull() for c in ("sector_economico", "tipo_persona", "zona_geografica")]
    return top1_per_key(customer, keys, [*known, F.col("id_cliente_PK")], "id_cliente_PK")


def fact_payments(
    payments: DataFrame, customer: DataFrame, rating: DataFrame, state: DataFrame
) -> DataFrame:
    """Payment rows with rating, state and the best matching customer key."""
    rated = rating.withColumnRenamed("calificacion", "calificacion_al_pago")
    keyed = lookup(
        payments, best_customer(customer),
        ["id_cliente", "segmento", "zona_geografica", "oficial_credito"],
    )
    keyed = keyed.join(rated, "calificacion_al_pago", "left")
    return keyed.join(state, ["estado_pago", "canal_pago"], "left").select(*PAYMENT_FACT)


def fact_customers(
    customers: DataFrame, customer: DataFrame, status: DataFrame, rating: DataFrame
) -> DataFrame:
    """Customer rows with three dimension keys. No key is hot: a customer is one row."""
    rated = rating.withColumnRenamed("calificacion", "calificacion_consolidada")
    keyed = customers.join(customer, CUSTOMER_KEYS, "left").join(status, STATUS_FLAGS, "left")
    return keyed.join(rated, "calificacion_consolidada", "left").select(*CUSTOMER_FACT)


def fact_income(income: DataFrame) -> DataFrame:
    return income.select(*INCOME_FACT)


def fact_balance(balance: DataFrame) -> DataFrame:
    return balance.select(*BALANCE_FACT)


def star_credits(
    fact: DataFrame, customer: DataFrame, rating: DataFrame, product: DataFrame
) -> DataFrame:
    """The loan fact with the attributes of its dimensions, for KPIs by any slice."""
    attributes = customer.drop("id_cliente", "oficial_credito")
    rated = rating.withColumnRenamed("calificacion", "calificacion_sbs")
    star = lookup(fact, attributes, ["id_cliente_PK"])
    return star.join(rated, "id_calificacion_sk", "left").join(product, "id_producto_PK", "left")


def build_galaxy(
    raw: RawTables, path: str, previous: Mapping[str, DataFrame] | None = None, rounds: int = 1
) -> dict[str, DataFrame]:
    """Rebuild all dimensions and facts as physical tables under ``path``.

    Cleaned tables that feed several dimensions are written once, and removed at the end.
    Dimensions are written before the facts that look them up, so their measured size decides
    the join. The calendar spans the years of all facts. Loans are partitioned by cutoff,
    payments by due month (``mes_vencimiento``).

    ``previous`` are the tables of an earlier build at another path: its dimensions keep their
    keys, and new rows are numbered on. ``load_guard`` holds the rows before and after every
    load, counted while they were written. ``rounds`` writes the tables that grow with the loans and
    payments in so many rounds, so that their shuffles take that share of the disk.
    """
    spark = raw.loans.sparkSession
    out: dict[str, DataFrame] = {}
    rows: dict[str, int] = {}

    def save(name: str, df: DataFrame | list[DataFrame], partition_by=()) -> DataFrame:
        out[name], rows[name] = write_counted(df, f"{path}/{name}", partition_by)
        return out[name]

    def cleaned(name: str, *parts: DataFrame) -> DataFrame:
        watched = [counted(part) for part in parts]
        staged = stage_rounds([df for df, _ in watched], f"mart_{name}", "zstd")
        rows[name] = sum(seen.get["rows"] for _, seen in watched)
        return staged

    def paid_marts() -> list[DataFrame]:
        if rounds < 2:
            return [marts["payments"]]
        found = instalments(raw.payments, raw.loans)
        return [mart_payments(part, raw.loans, found) for part in in_rounds(raw.payments, ["id_credito"], rounds)]

    def dimension(name: str, domain: DataFrame, key: str, order: list[str], build) -> DataFrame:
        if previous is not None:
            return save(name, extend_key(previous[name], domain, order, key))
        return save(name, build())

    with temporary_stages(spark):
        balance, n_balance = counted(raw.balance)
        rolled = stage_rounds(in_rounds(loan_rollup(raw.loans), ["fecha_corte"], rounds), "loan_rollup", "zstd")
        marts = build_marts(replace(raw, balance=balance), rolled=rolled)
        customers = cleaned("customers", marts["customers"])
        save("fact_income", fact_income(marts["income"]))
        save("fact_balance", fact_balance(marts["balance"]))
        release(rolled)
        credits = cleaned("credits", marts["credits"])
        payments = cleaned("payments", *paid_marts())
        customer = dimension("dim_customer", credits.select(*CUSTOMER_KEYS).distinct(), "id_cliente_PK",
                             CUSTOMER_KEYS, lambda: dim_customer(credits))
        status = dimension("dim_status", customers.select(*STATUS_FLAGS).distinct(), "id_status_t5",
                           STATUS_FLAGS, lambda: dim_status(customers))
        rating = dimension("dim_rating", rating_domain(credits, customers, payments), "id_calificacion_sk",
                           ["calificacion"], lambda: dim_rating(credits, customers, payments))
        product = dimension("dim_product", credits.select(*PRODUCT_PAIR).distinct(), "id_producto_PK",
                            PRODUCT_PAIR, lambda: dim_product(credits))
        state = dimension("dim_payment_state", payments.select(*STATE_PAIR).distinct(), "id_estado_PK",
                          STATE_PAIR, lambda: dim_payment_state(payments))
        months = in_rounds(credits, ["fecha_corte"], rounds)
        save("fact_credits", [fact_credits(part, customer, rating, product) for part in months], ["fecha_corte"])
        release(credits)
        due = F.last_day("fecha_vencimiento_cuota")
        months = in_rounds(payments, [due], rounds)
        paid = [fact_payments(part, customer, rating, state).withColumn("mes_vencimiento", due) for part in months]
        save("fact_payments", paid, ["mes_vencimiento"])
        save("fact_customers", fact_customers(customers, customer, status, rating))
        save("dim_calendar", dim_calendar([df for name, df in out.items() if name.startswith("fact_")]))
    rows["balance"] = n_balance.get["rows"]
    out["load_guard"] = load_guard(
        spark, {f"fact_{t}": (rows[t], rows[f"fact_{t}"]) for t in ("credits", "payments", "customers", "balance")}
    )
    return out
