"""How many SKUs a style offers, for styles sold in a large size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_of
from ..functions.text import is_present


def usable_styles(rows: DataFrame) -> DataFrame:
    """Rows with state, style, SKU and a valid date; bought or not."""
    present = is_present(F.col("state")) & is_present(F.col("style")) & is_present(F.col("sku"))
    return rows.filter(present & F.col("order_date").isNotNull())


def style_variety(rows: DataFrame) -> DataFrame:
    """month, state, style, variety (distinct SKUs), where any row was a large size.

    Reduced to one row per SKU before the style totals, so that a busy style is
    spread over its SKUs and no set of SKUs is held in memory.
    """
    style = ("month_start", "state", "style")
    per_sku = (
        usable_styles(rows)
        .groupBy(F.trunc("order_date", "month").alias("month_start"), "state", "style", "sku")
        .agg(F.bool_or("is_large").alias("is_large"))
    )
    per_style = per_sku.groupBy(*style).agg(
        F.count(F.lit(1)).alias("variety"), F.bool_or("is_large").alias("is_large")
    )
    return per_style.filter("is_large").select(
        month_of(F.col("month_start")).alias("month"), "state", "style", "variety"
    )


def median_variety(styles: DataFrame) -> DataFrame:
    """month, state, median, style_count; the mean of the middle two for even counts.

    The median buffer holds counts per distinct variety and is merged map-side.
    """
    return styles.groupBy("month", "state").agg(
        F.median("variety").alias("median"), F.count(F.lit(1)).alias("style_count")
    )
