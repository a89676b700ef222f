from tallyhouse.functions.predicates import day_window, like_any, like_text, optional_filter, valid_at
from tallyhouse.functions.scalars import (
    as_number, as_text, day, decode, days_between, first_known, iif, moment, strip_breaks,
)

__all__ = [
    "as_number", "as_text", "day", "day_window", "days_between", "decode", "first_known", "iif", "like_any",
    "like_text", "moment", "optional_filter", "strip_breaks", "valid_at",
]
