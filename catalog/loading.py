"""Loads: rejects of the read, versions, single months, stable keys, counted rows, sketches, layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from bankmart import schemas as S
from bankmart.operators import dimension as D, keys
from bankmart.plans import galaxy as G
from bankmart.sources import (
    Loaded, delete_folder, load_raw, publish_table, replace_partitions, shuffles_removed, stage, staging_root,
    write_bucketed, write_table,
)
from catalog.registry import query
from catalog.shapes import d2


def place(t, name: str) -> str:
    return f"{staging_root(t.spark)}/{name}-{uuid.uuid4().hex}"


# --- rejects -----------------------------------------------------------------------------
# Lines that the source system cut off, and lines with a cell too many.
BROKEN = {
    "loans": ("id_credito LIKE '%13'", "id_credito LIKE '%57'"),
    "income": ("fecha_mes LIKE '%-03-31'", "fecha_mes LIKE '%-04-30'"),
    "balance": ("fecha_mes LIKE '%-06-30'", "fecha_mes LIKE '%-10-31'"),
    "payments": ("id_pago LIKE '%13-1'", "id_pago LIKE '%57-2'"),
    "customers": ("id_cliente LIKE '%21'", "id_cliente LIKE '%58'"),
}
TO_CSV = {"nullValue": "\\N", "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Quickly compressed: smaller files would cost more time than they save.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
SQL_TYPES = {S.FLAG: "DECIMAL(18,2)", S.DAY: "DATE", S.WHOLE: "INT"}


def delivered(t, table: str) -> Loaded:
    """The raw table as delivered CSV lines, some of them broken, read and split.

    They are delivered as gzip files, which take a quarter of the room, and removed when they have been read.
    """
    columns, (short, long) = S.RAW_COLUMNS[table], BROKEN[table]
    whole = F.to_csv(F.struct(*columns), TO_CSV)
    line = F.when(F.expr(short), F.to_csv(F.struct(*columns[:-2]), TO_CSV)).when(
        F.expr(long), F.concat(whole, F.lit(",extra"))).otherwise(whole)
    path = place(t, f"delivered-{table}")
    with shuffles_removed(t.spark):
        getattr(t, table).select(line.alias("value")).write.options(**GZIP).text(path)
    loaded = load_raw(t.spark, path, table, header=False)
    delete_folder(t.spark, path)
    return loaded


def rejects_sql(table: str) -> str:
    columns, (short, long) = S.RAW_COLUMNS[table], BROKEN[table]
    names = ", ".join(S.RAW_KEYS[table])

    def line(cells):
        return " || ',' || ".join(f"CASE WHEN {c} IS NULL THEN '\\N' WHEN {c} = '' THEN '\"\"' ELSE {c} END" for c in cells)

    parts = [
        f"SELECT {names}, 'cell' AS kind, '{c}' AS field, {c} AS dirty_value FROM {{{table}}} WHERE NOT ({short}) AND NOT ({long}) "
        f"AND {c} <> '' AND TRY_CAST({c} AS {SQL_TYPES.get(kind, kind)}) IS NULL"
        for c, kind in S.RAW_TYPES[table].items() if kind != S.TEXT
    ]
    parts.append(f"SELECT {names}, 'line', NULL, {line(columns[:-2])} FROM {{{table}}} WHERE {short}")
    parts.append(f"SELECT {names}, 'line', NULL, {line(columns)} || ',extra' FROM {{{table}}} WHERE {long} AND NOT ({short})")
    return " UNION ALL ".join(parts)


for table in BROKEN:
    query(f"cast_rejects_{table}", " ".join(f"{k}:s" for k in S.RAW_KEYS[table]) + " kind:s field:s dirty_value:s",
          lambda t, table=table: delivered(t, table).rejects, rejects_sql(table))
    query(f"load_raw_{table}", " ".join(f"{c}:s" for c in S.RAW_COLUMNS[table]),
          lambda t, table=table: delivered(t, table).good,
          f"SELECT {', '.join(S.RAW_COLUMNS[table])} FROM {{{table}}} WHERE NOT ({BROKEN[table][0]}) AND NOT ({BROKEN[table][1]})")

# --- versions and single months ----------------------------------------------------------

SOME = "id_pago LIKE '%3'"


def published(t) -> DataFrame:
    """Two versions: the second is built from the first one and the rows that it lacked."""
    path, rows = place(t, "published"), t.payments.select("id_pago", "estado_pago", "monto_pagado")
    first = publish_table(rows.where(f"NOT ({SOME})"), path)
    second = publish_table(first.unionByName(rows.where(SOME)), path)
    return second.groupBy("estado_pago").agg(
        F.count("*").alias("n"), F.sum(F.col("monto_pagado").try_cast(S.MONEY)).alias("paid"))


query("publish_table", "estado_pago:s n:n paid:m", published,
      f"SELECT estado_pago, count(*) AS n, sum({d2('monto_pagado')}) AS paid FROM {{payments}} GROUP BY estado_pago")

LATE = "fecha_corte = DATE '1997-06-30'"


def late_month(t) -> DataFrame:
    """A month arrives in part, then whole: it is replaced, the other months stay."""
    path = place(t, "months")
    loans = stage(t.mart_credits.select("id_credito", "saldo_capital", "fecha_corte"), "month-source")
    write_table(loans.where(f"NOT ({LATE}) OR id_credito LIKE '%1'"), path, ["fecha_corte"])
    return replace_partitions(loans.where(LATE), path, ["fecha_corte"]).groupBy("fecha_corte").agg(
        F.count("*").alias("n"), F.sum("saldo_capital").alias("portfolio"))


query("replace_month", "fecha_corte:s n:n portfolio:m", late_month,
      "SELECT fecha_corte, count(*) AS n, sum(saldo_capital) AS portfolio FROM {mart_credits} GROUP BY fecha_corte")

# --- keys and counts ---------------------------------------------------------------------

EARLY = "fecha_corte <= DATE '1996-12-31'"


def extended(t) -> DataFrame:
    """The customer dimension of the early months, then extended by all later ones."""
    first = stage(G.dim_customer(t.staged_credits.where(EARLY)), "dim_customer_early")
    return D.extend_key(first, t.staged_credits.select(*S.CUSTOMER_KEYS).distinct(), S.CUSTOMER_KEYS, "id_cliente_PK")


NAMES = ", ".join(S.CUSTOMER_KEYS)
ORDER = ", ".join(f"{c} NULLS FIRST" for c in S.CUSTOMER_KEYS)
query("surrogate_key_extended", "id_cliente_PK:n " + " ".join(f"{c}:s" for c in S.CUSTOMER_KEYS), extended,
      f"SELECT row_number() OVER (ORDER BY late, {ORDER}) AS id_cliente_PK, {NAMES} FROM (SELECT {NAMES}, "
      f"min(CASE WHEN {EARLY} THEN 0 ELSE 1 END) AS late FROM {{mart_credits}} GROUP BY ALL) d")


def guards(t) -> DataFrame:
    return G.build_galaxy(t.raw, place(t, "galaxy"), rounds=t.rounds)["load_guard"]


query("load_guard", "load:s n_before:n n_after:n diff:n", guards,
      " UNION ALL ".join(
          f"SELECT 'fact_{name}' AS load, b AS n_before, a AS n_after, a - b AS diff FROM (SELECT "
          f"(SELECT count(*) FROM {{{before}}}) AS b, (SELECT count(*) FROM {{{after}}}) AS a) x"
          for name, before, after in (
              ("credits", "mart_credits", "fact_credits"), ("payments", "mart_payments", "fact_payments"),
              ("customers", "mart_customers", "fact_customers"), ("balance", "balance", "mart_balance"))))


def customers_seen(t) -> DataFrame:
    """The customers with loans, per cutoff and segment, as a stored table."""
    return stage(keys.distinct_sketches(t.mart_credits, "id_cliente", ["fecha_corte", "segmento"]), "customers-seen")


for name, columns, by, sql in [
    ("month", "fecha_corte:s ", "fecha_corte", "fecha_corte"),
    ("quarter", "quarter:s ", "trunc(fecha_corte, 'quarter') AS quarter", "CAST(date_trunc('quarter', fecha_corte) AS DATE) AS quarter"),
    ("segment", "segmento:s ", "segmento", "segmento"),
    ("all", "", "", ""),
]:
    names = [c.split(":")[0] for c in columns.split()]
    query(f"distinct_customers_{name}", f"{columns}n_keys:n",
          lambda t, by=by, names=names: keys.distinct_estimates(
              customers_seen(t).selectExpr(*[by] * bool(by), "keys_seen"), names),
          f"SELECT {sql + ', ' if sql else ''}count(DISTINCT id_cliente) AS n_keys FROM {{mart_credits}}{' GROUP BY ALL' if sql else ''}")

# --- co-located facts --------------------------------------------------------------------


def colocated(t, buckets: int = 8) -> DataFrame:
    """Loans and payments hashed by loan: neither is shuffled to be summed or joined."""
    parts = {}
    for name, df in (("loans", t.mart_credits.select("id_credito", "saldo_capital")),
                     ("payments", t.mart_payments.select("id_credito", "monto_pagado"))):
        path = place(t, f"bucketed-{name}")
        parts[name] = write_bucketed(df, f"{name}_{uuid.uuid4().hex}", path, ["id_credito"], buckets)
    owed = parts["loans"].groupBy("id_credito").agg(F.sum("saldo_capital").alias("owed"), F.count("*").alias("cutoffs"))
    paid = parts["payments"].groupBy("id_credito").agg(F.sum("monto_pagado").alias("paid"))
    return owed.join(paid, "id_credito", "left")


query("write_bucketed", "id_credito:s owed:m cutoffs:n paid:m", colocated,
      "SELECT l.id_credito, owed, cutoffs, paid FROM (SELECT id_credito, sum(saldo_capital) AS owed, count(*) AS cutoffs FROM {mart_credits} "
      "GROUP BY 1) l LEFT JOIN (SELECT id_credito, sum(monto_pagado) AS paid FROM {mart_payments} GROUP BY 1) p ON l.id_credito = p.id_credito")
