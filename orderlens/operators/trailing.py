"""Trailing windows whose length depends on how busy the key is.

The result for day d looks at the L days before d. L is short for states with
many bought rows and long for the others. Days without orders still get a
result, up to L days after the last order.

Rows are first summed per (state, size, day). That grid is bounded by its keys,
not by the data, so a state holding a third of all rows costs no more than any
other. Windows are running sums of what enters and leaves them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import SQUARE_SUMS, following_days, square_sums, with_variances
from ..functions.numbers import SCALE
from ..functions.text import is_present

CUTOFF = 10_000
SHORT_DAYS = 5
LONG_DAYS = 10
STATE_DAY = ("state", "window_date")
SUMS = ("n", "amount_n", *SQUARE_SUMS)


def is_bought(status: Column, qty: Column) -> Column:
    return F.coalesce(status.contains("SHIPPED") & (qty > 0), F.lit(False))


def bought(rows: DataFrame) -> DataFrame:
    """Bought rows that name a state."""
    return rows.filter(is_bought(F.col("status"), F.col("qty")) & is_present(F.col("state")))


def bought_counts(rows: DataFrame) -> DataFrame:
    """state, n: bought rows, whether or not their date and size are usable."""
    return bought(rows).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def window_lengths(
    counts: DataFrame, cutoff: int = CUTOFF, short: int = SHORT_DAYS, long: int = LONG_DAYS
) -> DataFrame:
    """state, n, window_days."""
    days = F.when(F.col("n") > cutoff, F.lit(short)).otherwise(F.lit(long))
    return counts.withColumn("window_days", days)


def daily_stats(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """The grid: bought rows summed per (state, size, order_date).

    Blank sizes and unusable dates stay as groups of their own: they count when
    the window length is chosen and drop out afterwards.
    """
    amount = F.col("amount")
    return (
        bought(rows)
        .groupBy("state", "size", "order_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(amount).alias("amount_n"),
            *[value.alias(name) for name, value in square_sums(amount, scale).items()],
        )
    )


def grid_counts(daily: DataFrame) -> DataFrame:
    """state, n as bought_counts gives them, taken from the grid instead of the rows."""
    return daily.groupBy("state").agg(F.sum("n").alias("n"))


def with_lengths(daily: DataFrame, lengths: DataFrame) -> DataFrame:
    """Look up each state's window length; states the lookup lacks drop out.

    No broadcast hint: the adaptive planner broadcasts the lookup once it has
    seen that it is small, and joins by shuffle otherwise.
    """
    return daily.join(lengths.select("state", "window_days"), "state", "inner")


def window_steps(daily: DataFrame) -> DataFrame:
    """What each row of the grid adds to its windows: all it has on the day after, and the same taken off when they are over."""
    usable = daily.filter(is_present(F.col("size")) & F.col("order_date").isNotNull())
    return usable.select(
        "state",
        "size",
        "window_days",
        F.inline(
            F.array(
                F.struct(F.date_add("order_date", 1).alias("day"), *[F.col(c).alias(c) for c in SUMS]),
                F.struct(
                    F.date_add("order_date", F.col("window_days") + 1).alias("day"),
                    *[(-F.col(c)).alias(c) for c in SUMS],
                ),
            )
        ),
    )


def trailing_totals(daily: DataFrame) -> DataFrame:
    """One row per (state, window_date, size) from a grid that carries window_days: frequency, amount_count and square sums.

    Steps are summed up per (state, size), so two rows a grid row are shuffled, whatever the window's length. A
    day on which nothing changes is made from the step before it.
    """
    running = Window.partitionBy("state", "size").orderBy("day")
    changes = (
        # One shuffle by (state, size) serves the sums of a day and the running sums.
        window_steps(daily)
        .repartition("state", "size")
        .groupBy("state", "size", "day")
        .agg(*[F.sum(c).alias(c) for c in SUMS], F.max("window_days").alias("window_days"))
        .select(
            "state",
            "size",
            "day",
            F.lead("day").over(running).alias("next_day"),
            *[F.sum(c).over(running).alias(c) for c in SUMS],
            "window_days",
        )
    )
    days = following_days(F.date_sub("day", 1), F.datediff("next_day", "day"))
    return changes.filter(F.col("n") > 0).select(
        "state",
        F.explode(days).alias("window_date"),
        "size",
        F.col("n").alias("frequency"),
        F.col("amount_n").alias("amount_count"),
        *SQUARE_SUMS,
        "window_days",
    )


def with_variance(totals: DataFrame, scale: int = SCALE) -> DataFrame:
    """state, window_date, size, frequency, variance, amount_count, window_days.

    `variance` is +infinity where no amount is known, so it loses every tie.
    """
    varied = with_variances(totals, {"variance": ("amount_count", {name: name for name in SQUARE_SUMS})}, scale)
    variance = F.coalesce(F.col("variance"), F.lit(float("inf"))).alias("variance")
    return varied.select(*STATE_DAY, "size", "frequency", variance, "amount_count", "window_days")


def trailing_stats(daily: DataFrame, scale: int = SCALE) -> DataFrame:
    """Totals with the variance of every size."""
    return with_variance(trailing_totals(daily), scale)


def _at_the_top(totals: DataFrame) -> DataFrame:
    """The sizes with the greatest frequency of each (state, window_date)."""
    order = Window.partitionBy(*STATE_DAY).orderBy(F.desc("frequency"))
    return totals.withColumn("place", F.rank().over(order)).filter(F.col("place") == 1).drop("place")


def winners(totals: DataFrame, scale: int = SCALE) -> DataFrame:
    """The best size per (state, window_date): most frequent, then steadiest, then by name.

    The variance is worked out for the sizes that share the top frequency only. The second ranking
    is over the same keys and order as the first, so it needs no shuffle.
    """
    order = Window.partitionBy(*STATE_DAY).orderBy("variance", "size")
    ranked = with_variance(_at_the_top(totals), scale).withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") == 1).drop("place")


def tie_groups(totals: DataFrame) -> DataFrame:
    """state, window_date, tied_sizes where two or more sizes share the top frequency."""
    tied = _at_the_top(totals).groupBy(*STATE_DAY).agg(F.count(F.lit(1)).alias("tied_sizes"))
    return tied.filter(F.col("tied_sizes") >= 2)
