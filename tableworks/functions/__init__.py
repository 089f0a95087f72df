"""Text and date column transforms (Catalyst expressions, no Python per row)."""

from tableworks.functions.columns import (
    make_date,
    normalize_text,
    normalize_text_col,
    register_functions,
    to_date,
    week_of_year,
    weekday_name,
    with_date_parts,
    ymd,
)

__all__ = [
    "make_date",
    "normalize_text",
    "normalize_text_col",
    "register_functions",
    "to_date",
    "week_of_year",
    "weekday_name",
    "with_date_parts",
    "ymd",
]
