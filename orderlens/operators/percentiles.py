"""Upper-percentile thresholds of promotion counts, and the spread of order value above them.

Everything after the first shuffle works on a histogram: one row per (sku, month,
promotion_count) with the number of orders and the exact sums of their amounts.
A (sku, month) group has as many rows there as it has different promotion counts,
however many orders it holds, so ranking a hot group is cheap and nothing is
joined back to the orders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import SQUARE_SUMS, square_sums, with_variances
from ..functions.numbers import SCALE

FRACTIONS = {"p90": 0.90, "p80": 0.80}
ACCURACY = 10_000
TOLERANCE = 1e-9
GROUP = ("sku", "month")
BIN = (*GROUP, "promotion_count")


def histogram_measures(scale: int = SCALE) -> dict[str, Column]:
    """n, amount_n and the square sums of orders."""
    amount = F.col("amount")
    return {"n": F.count(F.lit(1)), "amount_n": F.count(amount)} | square_sums(amount, scale)


def promotion_histogram(orders: DataFrame, scale: int = SCALE) -> DataFrame:
    """sku, month, promotion_count, n, amount_n and the square sums."""
    measures = histogram_measures(scale).items()
    return orders.groupBy(*BIN).agg(*[value.alias(name) for name, value in measures])


def _running(histogram: DataFrame) -> DataFrame:
    """Adds group_order_count and last_rank, the rank of the last order with the row's promotion count."""
    group = Window.partitionBy(*GROUP)
    running = group.orderBy("promotion_count").rowsBetween(Window.unboundedPreceding, 0)
    return histogram.withColumn("group_order_count", F.sum("n").over(group)).withColumn(
        "last_rank", F.sum("n").over(running)
    )


def _value_at(rank: Column) -> Column:
    """The promotion count of the order at a 1-based rank of the group."""
    reached = F.when(F.col("last_rank") >= rank, F.col("promotion_count"))
    return F.min(reached).over(Window.partitionBy(*GROUP)).cast("double")


def _occurring(fraction: float) -> Column:
    """The value at rank ceil(fraction * n), which occurs in the data."""
    return _value_at(F.greatest(F.ceil(F.col("group_order_count").cast("double") * fraction), F.lit(1)))


def _interpolated(fraction: float) -> Column:
    position = (F.col("group_order_count").cast("double") - 1.0) * F.lit(fraction)
    lower = _value_at(F.floor(position) + 1)
    upper = _value_at(F.ceil(position) + 1)
    return lower + (position - F.floor(position)) * (upper - lower)


METHODS = {"approx": _occurring, "exact": _interpolated}


def with_thresholds(
    histogram: DataFrame,
    methods: Sequence[str] = tuple(METHODS),
    fractions: Mapping[str, float] = FRACTIONS,
) -> DataFrame:
    """Adds group_order_count and each method's thresholds to every histogram row."""
    thresholds = [
        METHODS[method](fraction).alias(f"{name}_{method}_threshold")
        for method in methods
        for name, fraction in fractions.items()
    ]
    return _running(histogram).select(*histogram.columns, "group_order_count", *thresholds)


def _per_group(ranked: DataFrame, columns: Sequence[str]) -> DataFrame:
    return ranked.groupBy(*GROUP).agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])


def approx_thresholds(
    orders: DataFrame, fractions: Mapping[str, float] = FRACTIONS
) -> DataFrame:
    """sku, month and thresholds that are values of the data, from the histogram's ranks without any rank error."""
    ranked = with_thresholds(promotion_histogram(orders), ("approx",), fractions)
    return _per_group(ranked, [f"{name}_approx_threshold" for name in fractions])


def sketched_thresholds(
    orders: DataFrame, fractions: Mapping[str, float] = FRACTIONS, accuracy: int = ACCURACY
) -> DataFrame:
    """The same by a quantile sketch over the rows; rank error at most n / accuracy.

    One bounded sketch per group and task is shuffled, never the rows. Tasks with more groups than
    Spark's fallback threshold sort their rows, so `approx_thresholds` is the cheaper way.
    """
    # All fractions in one call share one sketch.
    wanted = F.array(*[F.lit(fraction) for fraction in fractions.values()])
    sketched = orders.groupBy(*GROUP).agg(
        F.percentile_approx("promotion_count", wanted, accuracy).alias("values")
    )
    return sketched.select(
        *GROUP,
        *[
            F.col("values")[place].cast("double").alias(f"{name}_approx_threshold")
            for place, name in enumerate(fractions)
        ],
    )


def exact_thresholds(
    orders: DataFrame, fractions: Mapping[str, float] = FRACTIONS
) -> DataFrame:
    """sku, month, group_order_count and linearly interpolated thresholds."""
    ranked = with_thresholds(promotion_histogram(orders), ("exact",), fractions)
    return _per_group(ranked, ["group_order_count", *[f"{name}_exact_threshold" for name in fractions]])


def attach_thresholds(histogram: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Thresholds joined to the histogram on (sku, month)."""
    return histogram.join(thresholds, list(GROUP), "inner")


def tail_spread(
    histogram: DataFrame,
    methods: Sequence[str],
    fractions: Mapping[str, float] = FRACTIONS,
    scale: int = SCALE,
) -> DataFrame:
    """Per (sku, month) and method: threshold, orders at or above it, and the stddev of their amounts.

    The stddev is 0.0 for fewer than two such orders, and where no amount is known.
    """
    summary = [F.sum("n").alias("group_order_count")]
    columns, variances = [*GROUP, "group_order_count"], {}
    for method in methods:
        for name in fractions:
            threshold = f"{name}_{method}_threshold"
            in_tail = F.col("promotion_count") >= F.col(threshold)

            def tail_sum(column: str, in_tail: Column = in_tail) -> Column:
                return F.sum(F.when(in_tail, F.col(column)))

            qualifying = f"{name}_{method}_qualifying_count"
            summary += [
                F.first(threshold, ignorenulls=True).alias(threshold),
                F.coalesce(tail_sum("n"), F.lit(0).cast("bigint")).alias(qualifying),
                tail_sum("amount_n").alias(f"{threshold}_n"),
                *[tail_sum(part).alias(f"{threshold}_{part}") for part in SQUARE_SUMS],
            ]
            variance = f"{name}_{method}_variance"
            variances[variance] = (f"{threshold}_n", {part: f"{threshold}_{part}" for part in SQUARE_SUMS})
            stddev = F.when(F.col(qualifying) < 2, 0.0).otherwise(F.coalesce(F.sqrt(variance), F.lit(0.0)))
            columns += [threshold, qualifying, stddev.alias(f"{name}_{method}_stddev")]
    return with_variances(histogram.groupBy(*GROUP).agg(*summary), variances, scale).select(*columns)


def approx_summary(
    orders: DataFrame, fractions: Mapping[str, float] = FRACTIONS, scale: int = SCALE
) -> DataFrame:
    ranked = with_thresholds(promotion_histogram(orders, scale), ("approx",), fractions)
    return tail_spread(ranked, ("approx",), fractions, scale)


def sketched_summary(
    orders: DataFrame, fractions: Mapping[str, float] = FRACTIONS, accuracy: int = ACCURACY
) -> DataFrame:
    """The approximate summary with thresholds from the sketch; reads the orders twice."""
    thresholds = sketched_thresholds(orders, fractions, accuracy)
    attached = attach_thresholds(promotion_histogram(orders), thresholds)
    return tail_spread(attached, ("approx",), fractions)


def exact_summary(
    orders: DataFrame, fractions: Mapping[str, float] = FRACTIONS, scale: int = SCALE
) -> DataFrame:
    ranked = with_thresholds(promotion_histogram(orders, scale), ("exact",), fractions)
    return tail_spread(ranked, ("exact",), fractions, scale)


def both_summaries(
    orders: DataFrame, fractions: Mapping[str, float] = FRACTIONS, scale: int = SCALE
) -> DataFrame:
    """Both methods side by side with their differences, from one histogram."""
    return summaries_of(promotion_histogram(orders, scale), fractions, scale)


def summaries_of(
    histogram: DataFrame, fractions: Mapping[str, float] = FRACTIONS, scale: int = SCALE
) -> DataFrame:
    """The same from the histogram."""
    ranked = with_thresholds(histogram, tuple(METHODS), fractions)
    return with_differences(tail_spread(ranked, tuple(METHODS), fractions, scale), fractions)


def compare_methods(
    approx: DataFrame, exact: DataFrame, fractions: Mapping[str, float] = FRACTIONS
) -> DataFrame:
    """Both summaries side by side, with absolute differences.

    Both sets of qualifying orders are upper tails of one ordering, so the size
    of their difference is the difference of their sizes.
    """
    return with_differences(
        approx.join(exact.drop("group_order_count"), list(GROUP), "inner"), fractions
    )


def with_differences(
    joined: DataFrame, fractions: Mapping[str, float] = FRACTIONS
) -> DataFrame:
    """The columns of both methods, ordered, with their absolute differences."""
    measures = {
        "threshold": "threshold_abs_diff",
        "qualifying_count": "qualifying_set_diff_count",
        "stddev": "stddev_abs_diff",
    }
    sides = [
        F.col(f"{name}_{method}_{measure}")
        for name in fractions
        for measure in measures
        for method in ("approx", "exact")
    ]
    differences = [
        F.abs(F.col(f"{name}_exact_{measure}") - F.col(f"{name}_approx_{measure}")).alias(
            f"{name}_{label}"
        )
        for measure, label in measures.items()
        for name in fractions
    ]
    return joined.select(*GROUP, "group_order_count", *sides, *differences)


def difference_report(
    comparison: DataFrame,
    fractions: Mapping[str, float] = FRACTIONS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per measure and fraction: groups that differ, all groups, share in percent."""
    limits = {
        "threshold_abs_diff": tolerance,
        "qualifying_set_diff_count": 0,
        "stddev_abs_diff": tolerance,
    }
    names = [f"{name}_{label}" for label in limits for name in fractions]
    counted = comparison.agg(
        F.count(F.lit(1)).alias("group_count"),
        *[
            F.count_if(F.col(f"{name}_{label}") > limit).alias(f"{name}_{label}")
            for label, limit in limits.items()
            for name in fractions
        ],
    )
    measures = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.col(name).alias("differing_groups"))
            for name in names
        ]
    )
    share = F.col("differing_groups").cast("double") * 100.0 / F.col("group_count")
    return counted.select("group_count", F.inline(measures)).select(
        "measure",
        "differing_groups",
        "group_count",
        F.when(F.col("group_count") > 0, share).otherwise(F.lit(0.0)).alias("share"),
    )


def group_lookup(comparison: DataFrame, sku: str, month: str) -> DataFrame:
    """The comparison of one (sku, month)."""
    return comparison.filter((F.col("sku") == sku) & (F.col("month") == month))
