"""Helpers for operators made of built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Space and 0x09 to 0x0D, as a pattern class and as a string.
BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once, however often the body or its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` in order."""
    return F.array_remove(F.split(text, f"{BLANK}+"), "")


#: Text of a table up to which it is sent to every task.
SMALL_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, rows: int, most: int = SMALL_BYTES) -> DataFrame:
    """A hint where rows and their text were counted and are few; otherwise Spark's own choice. `df` should be landed."""
    text = F.sum(F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns])))
    n, size = df.agg(F.count(F.lit(1)), text).first()
    return F.broadcast(df) if n <= rows and (size or 0) <= most else df


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equal keys, nulls equal to nulls; the right side's keys go."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    out = left.join(right, condition, how)
    return out.drop(*[f"__{k}" for k in keys]) if how != "left_anti" else out
