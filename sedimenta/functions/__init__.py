from sedimenta.functions.columns import (
    all_present,
    any_differs,
    any_missing,
    conform,
    date_key,
    decode_operation,
    moment,
    month_key,
    row_hash,
    with_audit,
)
from sedimenta.functions.strings import cast_timestamps, clean_strings

__all__ = [
    "all_present",
    "any_differs",
    "any_missing",
    "cast_timestamps",
    "clean_strings",
    "conform",
    "date_key",
    "decode_operation",
    "moment",
    "month_key",
    "row_hash",
    "with_audit",
]
