"""Routing of typed commands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def returns_rows(command: Column) -> Column:
    """True where a command text is treated as a row-returning query."""
    lowered = F.lower(command)
    return lowered.contains("select") & ~lowered.contains("count")
