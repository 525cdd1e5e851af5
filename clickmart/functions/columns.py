"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_code(ts: ColumnOrName) -> Column:
    """MMDD day code of a date/timestamp, kept as a 4-character string."""
    return F.date_format(_c(ts), "MMdd")


def count_distinct_with_null(c: ColumnOrName) -> Column:
    """Distinct values where NULL counts as one more value.

    Equals grouping by (keys, c) and then counting the groups, which is
    how the feature job counted items, categories and days (T4). A struct
    holding a NULL is itself not NULL, so ``count(DISTINCT struct(c))``
    keeps the NULL group and stays a pure distinct aggregate (no extra
    non-distinct flag, which would make Spark carry it through the
    distinct-aggregate expansion).
    """
    return F.count_distinct(F.struct(_c(c)))


def domain_size(c: ColumnOrName) -> Column:
    """Distinct values of a column with a small domain, NULL counted as one more.

    The same number as ``count_distinct_with_null``, from a set per group
    that is merged like a sum: rows are neither multiplied nor shuffled
    again for it. A set holds at most the domain (days of a year,
    categories), so this is not for ids of users or items.
    """
    return F.size(F.collect_set(_c(c))) + F.max(_c(c).isNull().cast("int"))


def count_where(cond: Column) -> Column:
    """Rows where ``cond`` is true (NULL counts as false)."""
    return F.count_if(cond)


def not_equal_null_safe(c: ColumnOrName, value) -> Column:
    """``c != value`` where a NULL ``c`` counts as different."""
    return ~_c(c).eqNullSafe(F.lit(value))


def percent_of_total(n: ColumnOrName, total: Column) -> Column:
    """100 * n / total as a double; NULL when the total is 0."""
    return F.try_divide(_c(n).cast("double"), total.cast("double")) * F.lit(100.0)


def format_percent(x: ColumnOrName, decimals: int = 5) -> Column:
    """Grouped fixed-point text, as ``format_number`` prints it."""
    return F.format_number(_c(x), decimals)


def format_percent_sign(x: ColumnOrName, decimals: int = 1) -> Column:
    """``12.3%`` style text (Java ``%.1f`` rounding)."""
    return F.format_string(f"%.{decimals}f%%", _c(x))


def double_text(c: ColumnOrName) -> Column:
    """A number printed as a double (``6`` -> ``6.0``), as LibSVM text has it."""
    return _c(c).cast("double").cast("string")
