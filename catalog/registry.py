"""Registration of queries with the reference SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from bankmart.operators.rollup import loan_rollup
from bankmart.plans import galaxy, kpi, marts
from bankmart.schemas import CUSTOMER_KEYS
from bankmart.sources import RawTables, stage
from catalog.fixtures import DEAL, DEAL_ORDERS, GIVEN, SPARK_FIXTURES

#: Lines that one task sums at a time where there are many: under 400 MB of hash tables and sorts.
LINES_AT_ONCE = 250_000
#: Lines from which large tables are written in rounds, one for so many lines, and the most rounds.
ROUND_LINES, MOST_ROUNDS = 1_000_000, 3

# How a result column is written on both sides, so that the two engines' own types for
# decimals, dates and booleans do not enter the comparison.
FORMS = {
    "s": "CAST({c} AS STRING)",
    "m": "ROUND(CAST({c} AS DOUBLE), 2) + 0.0",
    "q": "ROUND(CAST({c} AS DOUBLE), 4) + 0.0",
    "r": "ROUND(CAST({c} AS DOUBLE), 6) + 0.0",
    "n": "CAST({c} AS BIGINT)",
}


class Tables:
    """Inputs of a query: the given tables, the raw layer, and what is built from it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._written: dict[str, DataFrame] = {}
        # The virtual machine never compiles a method over 8000 bytes, and fifty cast columns are
        # more in one stage: such a stage is better run operator by operator, in small methods.
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", 8000)

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _fixture(self, name: str) -> DataFrame:
        if name in self._written:
            return self._written[name]
        sql = SPARK_FIXTURES[name]
        needs = set(re.findall(r"\{(\w+)\}", sql))
        frames = {n: self.given(n) if n in GIVEN else self._fixture(n) for n in needs}
        if name == "loan_panel":
            for hint in (DEAL, DEAL_ORDERS):
                sql = sql.replace(hint, hint.replace("(", f"({self._line_parts}"))
        return self.spark.sql(sql, **frames)

    @cached_property
    def _lines(self) -> int:
        return self.given("lineitem").count()

    @property
    def rounds(self) -> int:
        """Rounds in which a large table is written, so that its shuffles do not fill the disk."""
        return max(1, min(MOST_ROUNDS, self._lines // ROUND_LINES))

    @cached_property
    def _line_parts(self) -> str:
        """Number of partitions for many lines, whose rows shrink too well for partitions cut by bytes."""
        parts = -(-self._lines // LINES_AT_ONCE)
        cores = self.spark.sparkContext.defaultParallelism
        return f"{max(parts, 2 * cores)}, " if parts > cores else ""

    @cached_property
    def loans(self) -> DataFrame:
        return self._fixture("loans")

    @cached_property
    def income(self) -> DataFrame:
        return self._fixture("income").drop("m")

    @cached_property
    def balance(self) -> DataFrame:
        return self._fixture("balance").drop("m")

    @cached_property
    def payments(self) -> DataFrame:
        return self._fixture("payments")

    @cached_property
    def customers(self) -> DataFrame:
        return self._fixture("customers")

    @cached_property
    def raw(self) -> RawTables:
        # Both statements are made of the month sums, a row each: the lines are read once for them.
        self._written["month_sums"] = stage(self._fixture("month_sums"), "month_sums")
        return RawTables(self.loans, self.income, self.balance, self.payments, self.customers)

    @cached_property
    def rolled(self) -> DataFrame:
        return loan_rollup(self.loans)

    @cached_property
    def mart_credits(self) -> DataFrame:
        return marts.mart_credits(self.loans)

    @cached_property
    def mart_income(self) -> DataFrame:
        return marts.mart_income(self.income)

    @cached_property
    def mart_balance(self) -> DataFrame:
        return marts.mart_balance(self.balance, self.loans)

    @cached_property
    def mart_payments(self) -> DataFrame:
        return marts.mart_payments(self.payments, self.loans)

    @cached_property
    def mart_customers(self) -> DataFrame:
        return marts.mart_customers(self.customers, self.loans)

    @cached_property
    def staged_credits(self) -> DataFrame:
        """The cleaned loans, written once for the dimensions and facts that read them."""
        return stage(self.mart_credits, "mart_credits")

    @cached_property
    def _credits(self) -> DataFrame:
        """Cleaned loans for the dimensions: the written ones, or else what dimensions read of them."""
        if "staged_credits" in self.__dict__:
            return self.staged_credits
        names = dict.fromkeys([*CUSTOMER_KEYS, "calificacion_sbs", *galaxy.PRODUCT_PAIR])
        return stage(self.mart_credits.select(*names), "credit_attributes")

    @cached_property
    def staged_payments(self) -> DataFrame:
        return stage(self.mart_payments, "mart_payments")

    @cached_property
    def staged_customers(self) -> DataFrame:
        return stage(self.mart_customers, "mart_customers")

    @property
    def _customers(self) -> DataFrame:
        return self.__dict__.get("staged_customers", self.mart_customers)

    # Dimensions are written tables, as in the built model: joins go by their measured size.

    @cached_property
    def dim_customer(self) -> DataFrame:
        return stage(galaxy.dim_customer(self._credits), "dim_customer")

    @cached_property
    def dim_rating(self) -> DataFrame:
        # Payments are read where they have been written; otherwise the optimizer derives their
        # ratings without the joins of the cleaned table.
        payments = self.__dict__.get("staged_payments", self.mart_payments)
        return stage(galaxy.dim_rating(self._credits, self._customers, payments), "dim_rating")

    @cached_property
    def dim_product(self) -> DataFrame:
        return stage(galaxy.dim_product(self._credits), "dim_product")

    @cached_property
    def dim_status(self) -> DataFrame:
        return stage(galaxy.dim_status(self._customers), "dim_status")

    @cached_property
    def dim_state(self) -> DataFrame:
        return stage(galaxy.dim_payment_state(self.staged_payments), "dim_payment_state")

    @cached_property
    def months(self) -> DataFrame:
        return kpi.bank_months(self.mart_income, self.mart_balance)

    @cached_property
    def loan_months(self) -> DataFrame:
        return kpi.loan_months(self.mart_credits)


@dataclass(frozen=True)
class Query:
    name: str
    columns: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def projection(self) -> list[str]:
        pairs = [c.split(":") for c in self.columns.split()]
        return [f"{FORMS[form].format(c=name)} AS {name}" for name, form in pairs]


QUERIES: dict[str, Query] = {}


def query(
    name: str, columns: str, run: Callable[[Tables], DataFrame], sql: str | None = None
) -> None:
    """Register a query. ``columns`` lists its result as ``name:form`` pairs."""
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = Query(name, columns, run, sql)


def spark_query(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.run(Tables(spark, sf_dir)).selectExpr(*q.projection())

    run.__name__ = q.name
    return run


def reference_sql(q: Query, tables: dict[str, str]) -> str:
    """Complete SQL: the tables the text refers to, in order of need, then the query."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in re.findall(r"\{(\w+)\}", sql):
            if name in tables and name not in order:
                need(tables[name])
                order.append(name)

    need(q.sql)
    names = {n: n for n in GIVEN} | {n: f"t_{n}" for n in tables}
    ctes = [f"t_{n} AS ({tables[n].format(**names)})" for n in order]
    head = f"WITH {', '.join(ctes)} " if ctes else ""
    return f"{head}SELECT {', '.join(q.projection())} FROM ({q.sql.format(**names)}) result"
