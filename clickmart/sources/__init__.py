"""Inputs: typed CSV / text / LibSVM readers and the test-table views."""

from .fixtures import register_views, scoring_pairs, train_pairs, user_info, user_log
from .readers import (
    bad_values,
    line_fault,
    quarantine,
    read_csv,
    read_libsvm,
    read_lines,
    read_log,
    read_pairs,
    read_submissions,
    read_table,
    read_tagged,
    read_users,
    require_unique,
    split_fields,
    tagged_source,
    typed,
)

__all__ = [
    "bad_values",
    "line_fault",
    "quarantine",
    "read_csv",
    "read_libsvm",
    "read_lines",
    "read_log",
    "read_pairs",
    "read_submissions",
    "read_table",
    "read_tagged",
    "read_users",
    "register_views",
    "require_unique",
    "scoring_pairs",
    "split_fields",
    "tagged_source",
    "train_pairs",
    "typed",
    "user_info",
    "user_log",
]
