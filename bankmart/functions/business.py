"""Banking rules as reusable column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from bankmart.functions.casts import col
from bankmart.schemas import RATING_BANDS, SECTOR_DEFAULT, SECTOR_RULES


def normalize_sector(
    c: Column | str,
    rules: Sequence[tuple[str, str]] = SECTOR_RULES,
    default: str = SECTOR_DEFAULT,
) -> Column:
    """First rule whose fragment occurs in the text wins; case is ignored."""
    text = F.lower(col(c))
    hits = [F.when(text.contains(part), F.lit(label)) for part, label in rules]
    return F.coalesce(*hits, F.lit(default))


def rating_from_days(days: Column | str, bands=RATING_BANDS) -> Column:
    """Rating label of a days-past-due count; NULL days give NULL.

    Days under the first band (negative counts) take the first label with an upper
    bound over them that is not an exact match band, as an ordered ``<=`` chain does.
    """
    d = col(days)
    first_label, first_day, _ = bands[0]
    out = F.when(d == first_day, F.lit(first_label))
    for label, low, high in bands[1:]:
        out = out.when(d >= low if high is None else d <= high, F.lit(label))
    return out


def band_mismatch(
    label: Column | str,
    days: Column | str,
    bands=RATING_BANDS,
    open_band_floor: int | None = None,
    below_first_ok: bool = False,
) -> Column:
    """True when a rating label contradicts the days past due.

    ``open_band_floor`` is the smallest count the last, open band accepts (default: the
    band's own first day). ``below_first_ok`` accepts negative counts in the first band.
    """
    wrong = []
    for i, (name, low, high) in enumerate(bands):
        if high is None:
            outside = col(days) < (low if open_band_floor is None else open_band_floor)
        elif i == 0 and below_first_ok:
            outside = col(days) > high
        else:
            outside = ~col(days).between(low, high)
        wrong.append((col(label) == name) & outside)
    return reduce(or_, wrong)


def payment_channel(channel: Column | str, paid: Column | str) -> Column:
    """Missing channel: unidentified when money came in, not applicable otherwise."""
    missing = F.when(col(paid) > 0, F.lit("No Identificado")).when(
        col(paid) <= 0, F.lit("No Aplica (Sin Pago)")
    )
    return F.coalesce(col(channel), missing)


def instalment_delay(days: Column | str, paid: Column | str, unpaid_days: int = 180) -> Column:
    """Negative delays become 0, or ``unpaid_days`` when nothing was paid."""
    repaired = F.when(col(paid) == 0, F.lit(unpaid_days)).otherwise(F.lit(0))
    return F.when(col(days) < 0, repaired).otherwise(col(days))


def replace_if_differs(
    own: Column | str, source: Column | str, tolerance: str = "0.01", kind: str | None = None
) -> Column:
    """Take the source value when both exist and lie further apart than the tolerance.

    ``kind`` is the declared type of the column: the source is compared as it is and rounded
    to that type where it is taken, so sums and weighted means do not widen the column.
    """
    limit = F.lit(tolerance).cast("decimal(18,4)")
    taken = col(source) if kind is None else col(source).try_cast(kind)
    return F.when(F.abs(col(own) - col(source)) > limit, taken).otherwise(col(own))


def status_band(value: Column | str, low=14, alert=23, high=35) -> Column:
    """Traffic light of a regulatory index in percent units."""
    v = col(value)
    return (
        F.when(v < low, F.lit("low"))
        .when(v < alert, F.lit("alert"))
        .when(v <= high, F.lit("optimal"))
        .when(v > high, F.lit("high"))
    )


def direction(diff: Column | str, higher_is_better: bool = True) -> tuple[Column, Column]:
    """(sign of the change, whether it is an improvement); no change is not one."""
    d = col(diff)
    trend = F.when(d > 0, F.lit("up")).otherwise(F.lit("down"))
    better = d > 0 if higher_is_better else d < 0
    return trend, F.coalesce(better, F.lit(False))
