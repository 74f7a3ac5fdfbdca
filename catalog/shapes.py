"""Reference SQL of the shapes that recur over several tables."""

from __future__ import annotations

from collections.abc import Sequence

D2, D4 = "DECIMAL(18,2)", "DECIMAL(18,4)"


def d2(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(18,2))"


def d4(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(18,4))"


def day(c: str) -> str:
    return f"TRY_CAST({c} AS DATE)"


def whole(c: str) -> str:
    return f"TRY_CAST({c} AS INT)"


def invalid(table: str, fields: Sequence[str], step: str, kind: str = D4, words: str = "") -> str:
    skip = f" AND v NOT IN ({words})" if words else ""
    cells = " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS v FROM {{{table}}}" for f in fields)
    return (
        f"SELECT '{step}' AS step, field, v AS dirty_value, count(*) AS freq FROM ({cells}) c "
        f"WHERE TRY_CAST(v AS {kind}) IS NULL AND v IS NOT NULL AND v <> ''{skip} GROUP BY field, v"
    )


def negative(table: str, fields: Sequence[str], kinds: dict[str, str], kind: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{f}' AS field FROM {{{table}}} WHERE TRY_CAST({f} AS {kinds.get(f, kind)}) < 0"
        for f in fields
    )
    return f"SELECT 'negatives' AS step, field, count(*) AS freq FROM ({cells}) c GROUP BY field"


def missing(table: str, fields: Sequence[str]) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) FILTER (WHERE {f} IS NULL OR {f} = '') AS nulls, "
        f"count(*) AS total FROM {{{table}}}"
        for f in fields
    )
    # Half-up rounding to two decimals in whole numbers.
    pct = "((nulls * 20000 + total) // (2 * total)) / 100.0"
    return f"SELECT 'missing' AS step, field, nulls, total AS rows, {pct} AS pct FROM ({counts}) c"


def freq(table: str, field: str, where: str = "TRUE") -> str:
    return f"SELECT {field} AS value, count(*) AS freq FROM {{{table}}} WHERE {where} GROUP BY {field}"


def plus(columns: Sequence[str]) -> str:
    return " + ".join(d2(c) for c in columns)
