"""Column-expression builders (JVM-side, codegen-friendly; no Python UDFs)."""

from quayside.functions.text import (
    blank_to_null, contains_digit, date_text, datetime_text, key_part, match_key,
    strip_leading_zeros,
)
from quayside.functions.ids import to_id, id_col, serial_number
from quayside.functions.calendar import (
    elapsed_days, fishing_year, fishing_year_by_calendar, lookback, midpoint,
)
from quayside.functions.codes import decode, in_list
from quayside.functions.provenance import first_candidate

__all__ = [
    "blank_to_null", "contains_digit", "date_text", "datetime_text", "key_part",
    "match_key", "strip_leading_zeros", "to_id", "id_col", "serial_number",
    "elapsed_days", "fishing_year", "fishing_year_by_calendar", "lookback",
    "midpoint", "decode", "in_list", "first_candidate",
]
