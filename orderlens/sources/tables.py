"""The benchmark star schema seen as raw order lines.

Both frames follow the 24-column contract and hold text only, dirty in the ways
real exports are: padding, mixed case, blanks, malformed dates and numbers.
Lines come from `lineitem`, orders (with promotion lists) from `orders`.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..once import select_once
from .contract import COLUMNS

# Size labels by quantity modulo 11.
SIZE_LABELS = ("XS", "S", "M", "L", "XL", "XXL", "3XL", "4XL", "5XL", "6XL", "FREE")

# The columns that the two record kinds fill.
LINE_COLUMNS = (
    "index",
    "Order ID",
    "Date",
    "Status",
    "Style",
    "SKU",
    "Size",
    "Qty",
    "Amount",
    "ship-city",
    "ship-state",
    "promotion-ids",
)
ORDER_COLUMNS = (
    "index",
    "Order ID",
    "Date",
    "Status",
    "Fulfilment",
    "ship-service-level",
    "SKU",
    "Courier Status",
    "Qty",
    "Amount",
    "ship-city",
    "ship-state",
    "promotion-ids",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_record(df: DataFrame, needed: Collection[str]) -> DataFrame:
    """24 text columns; only the needed ones hold values."""
    empty = F.lit(None).cast("string")
    return df.select(
        *[F.col(f"`{name}`") if name in needed else empty.alias(name) for name in COLUMNS]
    )


def _export_date(column: str) -> Column:
    """MM-dd-yy text, 20 years on: the tables start in 1995, two-digit years in 2000."""
    return F.date_format(F.add_months(column, 240), "MM-dd-yy")


def raw_lines(
    spark: SparkSession, sf_dir: str, needed: Collection[str] = LINE_COLUMNS
) -> DataFrame:
    """One record per lineitem row; the state is the supplier's nation.

    Suppliers are few next to their lines, so the lines need no shuffle while
    the supplier side stays under the broadcast threshold.
    """
    lines = table(spark, sf_dir, "lineitem")
    if "ship-state" in needed:
        lines = lines.join(
            table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"),
        ).join(
            table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
            F.col("s_nationkey") == F.col("n_nationkey"),
        )
    number, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    labels = F.array(*[F.lit(label) for label in SIZE_LABELS])
    label = F.element_at(labels, quantity % 11 + 1)
    part = F.col("l_partkey").cast("string")
    shipped = _export_date("l_shipdate")
    values = {
        "index": F.when((number == 7) & (quantity == 50), "n/a").when(
            (number == 7) & (quantity == 49), F.lit(None)
        ).otherwise(F.col("l_orderkey").cast("string")),
        "Order ID": F.concat(F.lit("O-"), F.col("l_orderkey").cast("string")),
        "Date": F.when((number == 6) & (quantity == 49), "13-45-22")
        .when((number == 5) & (quantity >= 46), F.concat(F.lit("02-30-"), shipped.substr(7, 2)))
        .otherwise(shipped),
        "Status": F.when(F.col("l_linestatus") != "F", "Pending")
        .when(number == 3, " shipped - delivered to buyer\t")
        .otherwise("Shipped"),
        "Style": F.when(F.col("l_partkey") % 211 == 0, " ").otherwise(
            F.concat(
                F.when(number == 2, "ST-").otherwise("st-"),
                (F.col("l_partkey") % 12).cast("string"),
            )
        ),
        "SKU": F.concat(F.when(number % 2 == 1, "SK").otherwise(" sk"), part),
        "Size": F.when(quantity == 50, " ")
        .when(number == 5, F.lower(label))
        .otherwise(label),
        "Qty": F.when((number == 1) & (quantity == 1), "abc")
        .when((number == 1) & (quantity == 2), "")
        .when((number == 1) & (quantity == 3), "0")
        .when(number == 4, F.concat(F.lit(" "), quantity.cast("string")))
        .otherwise(quantity.cast("string")),
        "Amount": F.when(number == 7, "").otherwise(F.col("l_extendedprice").cast("string")),
        "ship-state": F.when(F.col("l_suppkey") % 97 == 0, "   ")
        .when(number % 2 == 0, F.concat(F.lit("\t"), F.lower("n_name"), F.lit(" ")))
        .otherwise(F.col("n_name")),
        "ship-city": F.when(number == 2, '5" gate, west side'),
        "promotion-ids": F.when(number == 2, F.concat(F.lit("P1 ,P"), part)),
    }
    # As plain expressions these would be copied into every cleaning step and filter.
    return _as_record(select_once(lines, {name: values[name] for name in needed}), needed)


def _promotion_list() -> Column:
    """Up to six codes near the customer key, ' ,' between them; repeats and blanks occur."""
    key = F.col("o_orderkey")

    def code(step: int) -> Column:
        return F.concat(F.lit("P"), (F.col("o_custkey") + step).cast("string"))

    listed = F.concat_ws(
        " ,",
        *[F.when(key % 7 >= i, code(i * i)) for i in range(1, 7)],
        F.when(key % 11 == 0, code(1)),
        F.when(key % 13 == 0, F.lit(", ,")),
    )
    return (
        F.when(key % 49 == 0, F.lit(None))
        .when(key % 49 == 7, ",,")
        .when(key % 7 != 0, listed)
        .otherwise("  ")
    )


def raw_orders(
    spark: SparkSession, sf_dir: str, needed: Collection[str] = ORDER_COLUMNS
) -> DataFrame:
    """One record per order; city and state are the customer's."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    if "ship-state" in needed or "ship-city" in needed:
        orders = orders.join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"),
        ).join(
            table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
    status = F.col("o_orderstatus")
    values = {
        "index": key.cast("string"),
        "Order ID": F.concat(F.lit("O-"), key.cast("string")),
        "Date": F.when(key % 101 == 0, "02-30-22").otherwise(_export_date("o_orderdate")),
        "Status": F.when(status == "F", "Cancelled - by buyer")
        .when(status == "O", "Shipped")
        .otherwise("Pending"),
        "Fulfilment": F.when(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), " Merchant"
        ).otherwise("Own"),
        "ship-service-level": F.when(
            F.col("o_orderpriority") == "5-LOW", "Expedited"
        ).otherwise("standard "),
        "SKU": F.when(key % 53 == 0, " ").otherwise(
            F.concat(F.lit(" Sku-"), (F.col("o_custkey") % 20).cast("string"))
        ),
        "Courier Status": F.when(status == "O", "shipped ").otherwise("Not Shipped"),
        "Qty": F.lit("1"),
        "Amount": F.when(key % 37 == 0, "")
        .when(key % 41 == 0, "abc")
        .otherwise(F.col("o_totalprice").cast("string")),
        "ship-city": F.when((F.col("c_mktsegment") == "BUILDING") & (key % 5 == 0), F.lit(None))
        .when(key % 19 == 0, "  ")
        .when(key % 2 == 0, F.concat("n_name", F.lit(" "), F.lower("c_mktsegment")))
        .otherwise(F.concat("n_name", F.lit(" "), "c_mktsegment", F.lit("  "))),
        "ship-state": F.when(key % 23 != 0, F.concat(F.lit(" "), F.lower("n_name"))),
        "promotion-ids": _promotion_list(),
    }
    return _as_record(orders.select(*[values[name].alias(name) for name in needed]), needed)
