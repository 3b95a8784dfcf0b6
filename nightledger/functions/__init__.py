"""Column-level helpers (scalar expressions)."""

from .scalar import (  # noqa: F401
    all_changed, any_changed, changed, concat_skip_nulls, date_to_label,
    full_name, hour_start, label_to_date, minute_field, next_label,
    parse_decimal_comma, parse_timestamp, seconds_between, strip_whitespace,
)
