"""Outputs: tables, LibSVM, text reports, submissions, staging."""

from .writers import libsvm_lines, stage, write, write_libsvm, write_lines, write_submission, write_submissions

__all__ = ["libsvm_lines", "stage", "write", "write_libsvm", "write_lines", "write_submission", "write_submissions"]
