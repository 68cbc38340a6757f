"""Promotion codes on orders, state averages, and cancelled orders by city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.doubles import exact_sums
from ..functions.text import is_present
from ..once import keep_whole, same_for_all

MIN_DAYS = 2
MIN_PROMOTIONS = 3
# Parts into which all uses of codes are dealt; a code gets so many of them as its share of the uses asks for.
PARTS = 1000


def explode_promotions(orders: DataFrame, keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """One row per promotion code of a dated order; repeats within an order kept."""
    # A missing list explodes to nothing. A filter on the date would parse it once more.
    listed = F.when(F.col("order_date").isNotNull(), F.split(F.col("promotion_ids_raw"), ","))
    codes = orders.select(*keep, "order_date", F.explode(listed).alias("code"))
    return codes.select(*keep, "order_date", F.trim("code").alias("promo")).filter(
        F.length("promo") > 0
    )


def promotion_periods(exploded: DataFrame, salted: bool = False) -> DataFrame:
    """promo, first_date, last_date, active_days; with the number of salts if asked."""
    uses = [F.count(F.lit(1)).alias("uses")] if salted else []
    periods = (
        exploded.groupBy("promo")
        .agg(F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"), *uses)
        .withColumn("active_days", F.datediff("last_date", "first_date"))
    )
    return with_salts(periods).drop("uses") if salted else periods


def valid_promotions(
    exploded: DataFrame, min_days: int = MIN_DAYS, salted: bool = False
) -> DataFrame:
    """Promotions whose first and last use lie at least `min_days` apart."""
    return promotion_periods(exploded, salted).filter(F.col("active_days") >= min_days)


def with_salts(codes: DataFrame, parts: int = PARTS) -> DataFrame:
    """Adds `salts` to codes with their number of `uses`: 1 for a code on up to 1 / parts of them, more in proportion.

    All codes together have at most `parts` salts more than there are codes.
    """
    codes = keep_whole(codes.withColumn("every", same_for_all("uses")))
    # One row, which each code meets.
    total = codes.groupBy("every").agg(F.sum("uses").alias("all_uses"))
    counted = codes.join(F.broadcast(total), "every")
    salts = F.greatest(F.ceil(F.col("uses") * parts / F.col("all_uses")), F.lit(1)).cast("int")
    return counted.withColumn("salts", salts).drop("all_uses", "every")


def salt_of(row_id: Column, salts: Column) -> Column:
    return F.pmod(F.xxhash64(row_id), salts).cast("int")


def with_salt(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Adds `salts` of its code and `salt`, the part of it to which a row belongs, by its id. `codes` has promo and salts.

    Codes with more than one salt are fewer than PARTS, since each stands for more than 1 / PARTS of the uses.
    """
    often = codes.filter(F.col("salts") > 1).select("promo", "salts")
    dealt = rows.join(F.broadcast(often), "promo", "left")
    salts = F.coalesce("salts", F.lit(1))
    return dealt.select(*rows.columns, salts.alias("salts"), salt_of(F.col("row_id"), salts).alias("salt"))


def salted(valid: DataFrame) -> DataFrame:
    """promo and salt: every code once for each of its `salts`."""
    return valid.select("promo", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))


def valid_counts(
    exploded: DataFrame, valid: DataFrame, keep: tuple[str, ...] = ("row_id",)
) -> DataFrame:
    """Valid codes per order, repeats counted; orders without any are absent.

    Where `valid` says how many salts each code has, the orders of a code are dealt into so many parts by their
    id, so a code on every order is not one task's work. Without, that is left to the adaptive
    planner, which splits hot partitions. It broadcasts the valid codes when they are few.
    """
    if "salts" in valid.columns:
        found = with_salt(exploded, valid).join(salted(valid), ["promo", "salt"], "inner")
    else:
        found = exploded.join(valid.select("promo"), "promo", "inner")
    return found.groupBy(*keep).agg(F.count(F.lit(1)).alias("valid_promotion_count"))


def with_valid_counts(orders: DataFrame, counts: DataFrame) -> DataFrame:
    """Every order with its number of valid codes, 0 where it has none."""
    return orders.join(
        counts.select("row_id", "valid_promotion_count"), "row_id", "left"
    ).withColumn(
        "valid_promotion_count", F.coalesce(F.col("valid_promotion_count"), F.lit(0).cast("bigint"))
    )


def _is_averaged() -> Column:
    """Merchant-fulfilled, shipped, priced and in a state."""
    return (
        (F.col("fulfilment") == "MERCHANT")
        & (F.col("courier_status") == "SHIPPED")
        & is_present(F.col("state"))
        & F.col("amount").isNotNull()
    )


def is_cancelled_standard() -> Column:
    return F.col("status").contains("CANCELLED") & (F.col("service_level") == "STANDARD")


def cancelled_standard(orders: DataFrame) -> DataFrame:
    return orders.filter(is_cancelled_standard())


def place_measures(totals: bool = True) -> dict[str, Column]:
    """What the averages, the base counts and the profile need from all orders; without `totals`, counts alone."""
    averaged, cancelled = _is_averaged(), is_cancelled_standard()
    priced_total = {"priced_total": F.sum(F.when(averaged, F.col("amount")))} if totals else {}
    return priced_total | {
        "priced": F.count_if(averaged),
        "cancelled": F.count_if(cancelled),
        "listed": F.count_if(cancelled & is_present(F.trim("promotion_ids_raw"))),
    }


def has_doubles(orders: DataFrame) -> bool:
    """Whether amounts are doubles, whose plain sums would depend on the order of rows."""
    return orders.schema["amount"].dataType.typeName() == "double"


def place_sums(orders: DataFrame) -> DataFrame:
    """The measures per (city, state); of doubles no totals."""
    measures = place_measures(not has_doubles(orders))
    return orders.groupBy("city", "state").agg(*[v.alias(name) for name, v in measures.items()])


def averages_of(sums: DataFrame) -> DataFrame:
    """state, state_average_amount from the sums per place."""
    # Exact total first: an average that shifted with row order could flip a `<` test.
    average = F.sum("priced_total").cast("double") / F.sum("priced")
    priced = sums.filter(F.col("priced") > 0)
    return priced.groupBy("state").agg(average.alias("state_average_amount"))


def state_averages(orders: DataFrame) -> DataFrame:
    """state, state_average_amount over merchant-fulfilled, shipped, priced orders.

    Totals are exact: of decimals by their type, of doubles by their powers of two.
    """
    priced = orders.filter(_is_averaged())
    if not has_doubles(orders):
        return averages_of(place_sums(priced))
    totals = exact_sums(priced, ["state"], "amount")
    return totals.select("state", (F.col("total") / F.col("n")).alias("state_average_amount"))


def with_state_average(orders: DataFrame, averages: DataFrame) -> DataFrame:
    """Left lookup; a NULL state matches nothing and keeps its row.

    The adaptive planner broadcasts the averages once it has seen how few they are.
    """
    return orders.join(averages, "state", "left")


def is_below_average() -> Column:
    """Priced below the state's average; false, never NULL, where either is unknown."""
    below = F.col("amount").cast("double") < F.col("state_average_amount")
    return F.coalesce(below, F.lit(False))


def classify(orders: DataFrame, min_promotions: int = MIN_PROMOTIONS) -> DataFrame:
    """Adds is_qualified to orders that carry their valid count and state average."""
    enough = F.col("valid_promotion_count") >= min_promotions
    return orders.withColumn("is_qualified", enough & is_below_average())


def city_shares(flagged: DataFrame) -> DataFrame:
    """Per city (NULL is a city of its own): rows, qualified rows and their percentage.

    Expects city, and in `cancelled` and `qualified` how many of each a row stands for.
    """
    base = F.sum("cancelled").cast("bigint")
    qualified = F.sum("qualified").cast("bigint")
    share = qualified.cast("double") * 100.0 / base.cast("double")
    return flagged.groupBy("city").agg(
        base.alias("cancelled_standard_count"),
        qualified.alias("qualified_order_count"),
        F.round(share, 6).alias("percentage"),
    )
