"""Comma-separated code lists held in one text field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def codes(c: Column) -> Column:
    """Trimmed, non-blank codes; repeats kept; an empty array for NULL."""
    items = F.split(F.coalesce(c, F.lit("")), ",")
    return F.filter(F.transform(items, lambda item: F.trim(item)), lambda item: F.length(item) > 0)


def code_count(c: Column) -> Column:
    """Number of non-blank codes, repeats counted."""
    items = F.split(F.coalesce(c, F.lit("")), ",")
    return F.size(F.filter(items, lambda item: F.length(F.trim(item)) > 0))
