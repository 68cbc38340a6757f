"""The 24-column order-line record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# Header names by position. `unused_NN` stands for columns nothing reads.
COLUMNS = (
    "index",
    "Order ID",
    "Date",
    "Status",
    "Fulfilment",
    "unused_05",
    "ship-service-level",
    "Style",
    "SKU",
    "unused_09",
    "Size",
    "unused_11",
    "Courier Status",
    "Qty",
    "unused_14",
    "Amount",
    "ship-city",
    "ship-state",
    "unused_18",
    "unused_19",
    "promotion-ids",
    "unused_21",
    "unused_22",
    "unused_23",
)

# How a header line starts, and the columns each job needs.
HEADER_PREFIX = "index,Order ID,Date,"
COUNT_COLUMNS = ("Status", "Qty", "ship-state")
WINDOW_COLUMNS = ("Date", "Status", "Size", "Qty", "Amount", "ship-state")
STYLE_COLUMNS = ("Date", "Style", "SKU", "Size", "ship-state")
CANCELLATION_COLUMNS = (
    "index",
    "Date",
    "Status",
    "Fulfilment",
    "ship-service-level",
    "Courier Status",
    "Amount",
    "ship-city",
    "ship-state",
    "promotion-ids",
)
SPREAD_COLUMNS = ("index", "Date", "SKU", "Amount", "promotion-ids")


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The frame itself, or an error that lists every missing column."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"the frame lacks {missing}")
    return df


def require_width(df: DataFrame, width: int = len(COLUMNS)) -> DataFrame:
    """The frame itself, or an error when it does not have exactly `width` columns."""
    if len(df.columns) != width:
        raise ValueError(f"{len(df.columns)} columns in place of {width}")
    return df
