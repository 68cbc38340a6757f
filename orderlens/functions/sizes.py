"""Ordinal clothing sizes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order of the sizes. FREE and anything else has no rank.
SIZE_RANK = {
    "XS": 0,
    "S": 1,
    "M": 2,
    "L": 3,
    "XL": 4,
    "XXL": 5,
    "3XL": 6,
    "4XL": 7,
    "5XL": 8,
    "6XL": 9,
}


def size_rank(size: Column) -> Column:
    """Rank of a normalised size, NULL when it has none."""
    ranks = F.create_map(*[F.lit(item) for item in chain(*SIZE_RANK.items())])
    return F.try_element_at(ranks, size)


def at_least_size(size: Column, smallest: str) -> Column:
    """True for normalised sizes ranked at or above `smallest`; never NULL."""
    wanted = [name for name, rank in SIZE_RANK.items() if rank >= SIZE_RANK[smallest]]
    return F.coalesce(size.isin(wanted), F.lit(False))
