"""Column transforms for text and dates, built from Catalyst expressions only.

Nothing here runs Python per row: the transforms stay inside whole-stage
codegen and keep filters pushable.  ``register_functions`` makes the same
transforms callable from SQL text as SQL functions (``CREATE TEMPORARY
FUNCTION ... RETURN``), which Spark inlines into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes are Unicode
# white space plus the four separators U+001C..U+001F.  Java's ``\s`` under
# ``(?U)`` is Unicode white space, so the separators are added by hand.
_BLANK = r"[\s\x{1C}-\x{1F}]"
_TRIM_PATTERN = rf"(?U)^{_BLANK}+|{_BLANK}+$"

# Date patterns of the reference's date helpers.
YMD_FORMAT = "yyyy-MM-dd"  # strftime %Y-%m-%d
WEEKDAY_FORMAT = "EEEE"  # English full day name, Monday .. Sunday


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text_col(c: str | Column) -> Column:
    """Lower-case and strip leading/trailing white space; NULL stays NULL."""
    return F.regexp_replace(F.lower(_c(c)), _TRIM_PATTERN, "")


def normalize_text(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with each of ``cols`` normalised in place."""
    return df.withColumns({c: normalize_text_col(c) for c in cols})


def make_date(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """Date from year, month and day (NULL for an invalid date under non-ANSI)."""
    return F.make_date(_c(year), _c(month), _c(day))


def to_date(c: str | Column, fmt: str | None = None) -> Column:
    """Date of a string, date or timestamp column."""
    return F.to_date(_c(c), fmt) if fmt else F.to_date(_c(c))


def ymd(c: str | Column) -> Column:
    return F.date_format(_c(c), YMD_FORMAT)


def weekday_name(c: str | Column) -> Column:
    return F.date_format(_c(c), WEEKDAY_FORMAT)


def week_of_year(c: str | Column) -> Column:
    """Week of the year with weeks starting on Sunday, 0..53 (``strftime('%U')``).

    Days before the year's first Sunday are week 0.  Not the ISO week.
    """
    d = F.to_date(_c(c))
    day0 = F.dayofyear(d) - 1  # 0-based day of the year
    sunday0 = F.dayofweek(d) - 1  # 0 = Sunday
    return F.floor((day0 + 7 - sunday0) / 7).cast("int")


def with_date_parts(df: DataFrame, date_col: str, prefix: str = "") -> DataFrame:
    """Adds ``ymd``, ``weekday_name`` and ``week_of_year`` columns for ``date_col``."""
    return df.withColumns(
        {
            f"{prefix}ymd": ymd(date_col),
            f"{prefix}weekday_name": weekday_name(date_col),
            f"{prefix}week_of_year": week_of_year(date_col),
        }
    )


def register_functions(spark: SparkSession) -> None:
    """SQL functions ``normalize_string``, ``date_default``, ``ymd``,
    ``weekday_name`` and ``week_of_year`` for the session."""
    pattern = _TRIM_PATTERN.replace("\\", "\\\\")
    statements = [
        "CREATE OR REPLACE TEMPORARY FUNCTION normalize_string(s STRING) RETURNS STRING "
        f"RETURN regexp_replace(lower(s), '{pattern}', '')",
        "CREATE OR REPLACE TEMPORARY FUNCTION date_default(y INT, m INT, d INT) RETURNS DATE "
        "RETURN make_date(y, m, d)",
        "CREATE OR REPLACE TEMPORARY FUNCTION ymd(d DATE) RETURNS STRING "
        f"RETURN date_format(d, '{YMD_FORMAT}')",
        "CREATE OR REPLACE TEMPORARY FUNCTION weekday_name(d DATE) RETURNS STRING "
        f"RETURN date_format(d, '{WEEKDAY_FORMAT}')",
        "CREATE OR REPLACE TEMPORARY FUNCTION week_of_year(d DATE) RETURNS INT "
        "RETURN CAST(floor((dayofyear(d) - 1 + 7 - (dayofweek(d) - 1)) / 7) AS INT)",
    ]
    for stmt in statements:
        spark.sql(stmt)
