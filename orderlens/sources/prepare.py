"""Working schemas: raw text columns to the typed columns each job reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    at_least_size,
    checked_money,
    code_count,
    key_text,
    label_text,
    money,
    month_of,
    parse_date,
    parse_date_clamped,
    parse_id,
    parse_int,
    trimmed,
)
from ..functions.doubles import finite_double
from ..functions.numbers import SCALE
from ..functions.text import is_present
from ..once import select_once, with_column_once


def _amount(scale: int | None, checked: bool) -> Column:
    if scale is None:
        return finite_double(F.col("Amount")).alias("amount")
    return (checked_money if checked else money)(F.col("Amount"), scale).alias("amount")


def window_rows(raw: DataFrame, keep: tuple[str, ...] = (), scale: int = SCALE, checked: bool = False) -> DataFrame:
    """state, size, status, qty, order_date, amount, after any columns to keep as they are.

    Here and below: amounts have `scale` decimals; `checked` ones that cannot be kept as they are raise when they are read.
    """
    return raw.select(
        *keep,
        key_text(F.col("ship-state")).alias("state"),
        key_text(F.col("Size")).alias("size"),
        label_text(F.col("Status")).alias("status"),
        parse_int(F.col("Qty")).alias("qty"),
        parse_date_clamped(F.col("Date")).alias("order_date"),
        _amount(scale, checked),
    )


def style_rows(
    raw: DataFrame, smallest: str = "XXL", keep: tuple[str, ...] = ()
) -> DataFrame:
    """order_date, state, style, sku, is_large, after any columns to keep as they are."""
    columns = {
        "order_date": parse_date_clamped(F.col("Date")),
        "state": key_text(F.col("ship-state")),
        "style": key_text(F.col("Style")),
        "sku": key_text(F.col("SKU")),
        "is_large": at_least_size(key_text(F.col("Size")), smallest),
    }
    return select_once(raw, {name: F.col(name) for name in keep} | columns)


def cancellation_rows(raw: DataFrame, scale: int | None = SCALE, checked: bool = False) -> DataFrame:
    """row_id, order_date, five category columns, city, state, amount, promotion list.

    Without a scale, amounts are the doubles that the text says.
    """
    return raw.select(
        parse_id(F.col("index")).alias("row_id"),
        parse_date(F.col("Date")).alias("order_date"),
        label_text(F.col("Status")).alias("status"),
        label_text(F.col("Fulfilment")).alias("fulfilment"),
        label_text(F.col("ship-service-level")).alias("service_level"),
        label_text(F.col("Courier Status")).alias("courier_status"),
        label_text(F.col("ship-city")).alias("city"),
        label_text(F.col("ship-state")).alias("state"),
        _amount(scale, checked),
        F.col("promotion-ids").alias("promotion_ids_raw"),
    )


def spread_rows(raw: DataFrame, scale: int = SCALE, checked: bool = False) -> DataFrame:
    """row_id, sku, month, amount, promotion_count; rows lacking id, date or SKU dropped."""
    # The date decides on the row and gives the month; it is parsed once for both.
    dated = with_column_once(raw, "order_date", parse_date(F.col("Date")))
    return (
        dated.filter(F.col("order_date").isNotNull())
        .select(
            parse_id(F.col("index")).alias("row_id"),
            trimmed(F.col("SKU")).alias("sku"),
            month_of(F.col("order_date")).alias("month"),
            _amount(scale, checked),
            code_count(F.col("promotion-ids")).alias("promotion_count"),
        )
        .filter(F.col("row_id").isNotNull() & is_present(F.col("sku")))
    )
