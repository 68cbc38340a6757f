"""What share of a city's cancelled standard orders had good promotions and a low price?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import code_count
from ..functions.numbers import SCALE
from ..once import keep_whole
from ..operators import promotions as promo
from ..operators.quality import beside_ids, guarded, require_amounts, require_unique, unique_fault
from ..sources import cancellation_rows, require_columns
from ..sources.contract import CANCELLATION_COLUMNS
from .checks import IN_PLAN

KEEP = ("row_id", "city", "state", "amount")
PLACE = ("city", "state")


def listed_codes(orders: DataFrame, min_promotions: int = promo.MIN_PROMOTIONS) -> DataFrame:
    """The codes of all dated orders, from one reading and one shuffle, with the part of its code each row belongs to.

    Orders that can still qualify (`is_candidate`: cancelled, priced, in a state, with a long enough list) keep a row for
    each of their codes. All other uses of a code are summed in every task to one row. Both have first_date, last_date
    and the number of `uses`.
    """
    candidate = F.coalesce(
        promo.is_cancelled_standard()
        & F.col("amount").isNotNull()
        & F.col("state").isNotNull()
        & (code_count(F.col("promotion_ids_raw")) >= min_promotions),
        F.lit(False),
    )
    codes = promo.explode_promotions(
        orders.withColumn("is_candidate", candidate), (*KEEP, "is_candidate")
    )
    carried = [F.when(F.col("is_candidate"), F.col(name)).alias(name) for name in KEEP]
    uses = keep_whole(
        codes.select("promo", "order_date", "is_candidate", *carried)
        .groupBy("promo", "is_candidate", *KEEP)
        .agg(
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
            F.count(F.lit(1)).alias("uses"),
        )
    )
    candidates = uses.filter("is_candidate").groupBy("promo").agg(F.count(F.lit(1)).alias("uses"))
    return promo.with_salt(uses, promo.with_salts(candidates))


def code_periods(codes: DataFrame) -> DataFrame:
    """promo, first_date, last_date, active_days, salts."""
    return (
        codes.groupBy("promo")
        .agg(
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
            F.max("salts").alias("salts"),
        )
        .withColumn("active_days", F.datediff("last_date", "first_date"))
    )


def qualified_orders(
    codes: DataFrame,
    averages: DataFrame,
    min_days: int = promo.MIN_DAYS,
    min_promotions: int = promo.MIN_PROMOTIONS,
) -> DataFrame:
    """row_id, city of the cancelled standard orders that qualify, from the listed codes and the averages."""
    valid = code_periods(codes).filter(F.col("active_days") >= min_days)
    counts = (
        codes.filter("is_candidate")
        .join(promo.salted(valid), ["promo", "salt"], "inner")
        .groupBy(*KEEP)
        .agg(F.sum("uses").alias("valid_promotion_count"))
    )
    return (
        counts.filter(F.col("valid_promotion_count") >= min_promotions)
        .join(averages, "state", "inner")
        .filter(promo.is_below_average())
        .select("row_id", "city")
    )


def _shares(orders: DataFrame, sums: DataFrame, min_days: int, min_promotions: int) -> DataFrame:
    """The answer from typed orders and their sums per place."""
    base = sums.filter(F.col("cancelled") > 0).select("city", "cancelled", F.lit(0).alias("qualified"))
    codes = listed_codes(orders, min_promotions)
    averages = promo.state_averages(orders) if promo.has_doubles(orders) else promo.averages_of(sums)
    found = qualified_orders(codes, averages, min_days, min_promotions)
    found = found.select("city", F.lit(0).alias("cancelled"), F.lit(1).alias("qualified"))
    return promo.city_shares(base.unionByName(found))


def qualified_shares(
    orders: DataFrame, min_days: int = promo.MIN_DAYS, min_promotions: int = promo.MIN_PROMOTIONS
) -> DataFrame:
    """city, cancelled_standard_count, qualified_order_count, percentage from typed orders.

    Two passes over the orders: the sums per place, and the listed codes. Amounts that are doubles take one more, for averages.
    """
    return _shares(orders, keep_whole(promo.place_sums(orders)), min_days, min_promotions)


def qualified_by_city(
    raw: DataFrame,
    min_days: int = promo.MIN_DAYS,
    min_promotions: int = promo.MIN_PROMOTIONS,
    check: bool | str = True,
    scale: int | None = SCALE,
) -> DataFrame:
    """The same from raw text columns.

    `check` looks for all columns, for missing or repeated row ids and for amounts that `scale` decimals cannot keep as they
    are: True before anything else, in jobs of their own; `IN_PLAN` while the result is read, the ids in the same pass and
    shuffle as the sums per place, the amounts where they are used. Without a `scale`, amounts are doubles of any size and
    number of decimals, nothing of them is lost or refused, and their sums are exact.
    """
    orders = cancellation_rows(require_columns(raw, CANCELLATION_COLUMNS), scale, check == IN_PLAN)
    if check == IN_PLAN:
        sums, words = beside_ids(orders, PLACE, promo.place_measures(scale is not None))
        return guarded(_shares(orders, sums, min_days, min_promotions), unique_fault(words))
    if check:
        if scale is not None:
            require_amounts(raw, scale)
        require_unique(orders)
    return qualified_shares(orders, min_days, min_promotions)
