from tierforge.functions.casts import (
    MONEY,
    TIMESTAMP_FORMAT,
    blank_as_null,
    blank_as_value,
    is_missing,
    to_timestamp,
    to_type,
    was_rounded,
)
from tierforge.functions.dates import calendar_days, label_on_time, month_text, true_or_false
from tierforge.functions.text import any_text, clean_text, map_codes

__all__ = [
    "MONEY",
    "TIMESTAMP_FORMAT",
    "any_text",
    "blank_as_null",
    "blank_as_value",
    "calendar_days",
    "clean_text",
    "is_missing",
    "label_on_time",
    "map_codes",
    "month_text",
    "to_timestamp",
    "to_type",
    "true_or_false",
    "was_rounded",
]
