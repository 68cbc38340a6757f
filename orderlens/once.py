"""Columns that are computed exactly once per row, and stages that run once per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """A projection through a generator.

    The optimiser copies a plain alias into every filter and expression that reads
    it, which evaluates costly parsing several times over. A generator's output is
    a column like that of a scan. The price is that unused columns are computed
    too, so this is for frames whose readers use all of them.
    """
    record = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(F.inline(F.array(record)))


def with_column_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds one column the same way."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def same_for_all(number: str) -> Column:
    """A key that all rows share, from a whole number that each has; what is summed by it meets them in an ordinary join."""
    return F.col(number) - F.col(number)


def keep_whole(df: DataFrame) -> DataFrame:
    """The same frame, safe from column pruning.

    A frame used twice with different columns is pruned into two different plans
    and computed twice. Kept whole, both uses are one plan, and Spark reuses its
    shuffle.
    """
    return select_once(df, {name: F.col(name) for name in df.columns})
