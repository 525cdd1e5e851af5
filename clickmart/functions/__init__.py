"""Reusable built-in column expressions."""

from .columns import (
    count_distinct_with_null,
    count_where,
    domain_size,
    day_code,
    double_text,
    format_percent,
    format_percent_sign,
    not_equal_null_safe,
    percent_of_total,
)

__all__ = [
    "count_distinct_with_null",
    "count_where",
    "domain_size",
    "day_code",
    "double_text",
    "format_percent",
    "format_percent_sign",
    "not_equal_null_safe",
    "percent_of_total",
]
