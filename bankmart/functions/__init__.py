from .casts import (
    as_boolean, as_day, as_decimal, as_double, as_money, as_rate, as_type, as_whole,
    blank, blank_to_null, col, month_gap, month_index, ratio,
)
from .business import (
    band_mismatch, direction, instalment_delay, normalize_sector, payment_channel,
    rating_from_days, replace_if_differs, status_band,
)

__all__ = [name for name in dir() if not name.startswith("_")]
