"""A left join by key that no frequent key holds up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key on more than one in so many rows is frequent; there are fewer such keys than this.
SHARE = 1000


def look_up(rows: DataFrame, key: str, row: str, table: DataFrame, total: int) -> DataFrame:
    """The rows with the table's other columns, null where it lacks the key.

    `table` has each key once with `n`, the number of rows that have it; `total` is the number of rows, and `row` names a
    column that differs from row to row. Fewer than SHARE frequent keys are broadcast. Their rows, and those without a
    key, then join under a key of their own, so the shuffle spreads them.
    """
    told = [c for c in table.columns if c not in (key, "n")]
    often = F.col("n") > F.lit(total / SHARE)
    half = lambda name, part: part.select(
        F.col(key).cast("string").alias(f"__{name}"), F.lit(True).alias(f"__{name}_found"), *[F.col(c).alias(f"__{name}_{c}") for c in told]
    )
    out = rows.join(F.broadcast(half("often", table.where(often))), F.col(key).cast("string") == F.col("__often"), "left")
    settled = F.col("__often_found").isNotNull() | F.col(key).isNull()
    alone = F.when(settled, F.concat(F.lit("\0"), F.col(row).cast("string"))).otherwise(F.col(key).cast("string"))
    out = out.withColumn("__alone", alone).join(half("seldom", table.where(~often)), F.col("__alone") == F.col("__seldom"), "left")
    return out.select(*rows.columns, *[F.coalesce(f"__often_{c}", f"__seldom_{c}").alias(c) for c in told])
