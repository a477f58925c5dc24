"""Importing this module registers every query."""

from . import change_queries, enrollment_queries, exam_queries, file_queries, report_queries  # noqa: F401
from .registry import QUERIES

__all__ = ["QUERIES"]
