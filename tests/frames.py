"""Small hand-written frames."""

from pyspark.sql import functions as F


def text(spark, columns, *rows):
    """All-text frame; ``columns`` is a space-separated list."""
    names = columns.split()
    schema = ", ".join(f"{c} string" for c in names)
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def loans(spark, *rows, **defaults):
    """Raw loan rows from dicts, missing columns taken from ``defaults`` or NULL."""
    from bankmart.schemas import RAW_COLUMNS

    names = RAW_COLUMNS["loans"]
    base = {
        "fecha_desembolso": "2023-01-15", "fecha_vencimiento": "2026-01-15",
        "fecha_corte": "2024-01-31", "tasa_nominal_anual_pct": "12", "score_crediticio": "700",
        "saldo_capital": "100", **defaults,
    }
    data = [tuple({**base, **r}.get(c) for c in names) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in names))


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(spark, value, expr, kind="string"):
    """Value of an expression over column ``v`` holding one value."""
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expr(F.col("v")).alias("x")).first()["x"]
