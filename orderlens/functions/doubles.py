"""Sums of doubles that are exact, and so the same in any order and under any partitioning.

A finite double is a whole number times a power of two. Its pieces are the slot of that power (16 powers to a slot)
and the whole number moved up to the slot's lowest power, which has 22 digits at most. Pieces of one slot add up
exactly as decimals, for up to 10^15 of them. The slots of a group, 129 at most, are put together with carries and
rounded to a double once, to the nearest, from all digits. Nothing depends on the amounts' size or decimals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Powers of two to a slot, and what a carry into the next slot is worth.
POWERS = 16
BASE = 1 << POWERS
# The lowest power of two that a double has.
LOWEST = -1074
# Slots above a group's highest that its carries can reach, and slots that hold more than a double's 53 bits.
CARRIES, HEAD = 9, 5


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def finite_double(c: Column) -> Column:
    """Text amount as a double; blank, malformed and non-finite become NULL."""
    value = c.try_cast("double")
    return F.when(is_finite(value), value)


def _times_power(x: Column, power: Column) -> Column:
    """x * 2^power, in two steps, since 2^power itself may be no double. Powers of two are exact."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _power(x: Column) -> Column:
    """A power of two that divides x. The logarithm may be off by one next to a power, so one more is taken off."""
    return F.greatest(F.floor(F.log2(F.abs(x))) - 53, F.lit(LOWEST)) - LOWEST


def slot(x: Column) -> Column:
    """Slot of a finite double; NULL for zero, which adds nothing, and for all else."""
    return F.when(is_finite(x) & (x != 0), F.floor(_power(x) / POWERS).cast("int"))


def piece(x: Column) -> Column:
    """The whole number for which x is piece * 2^(POWERS * slot + LOWEST)."""
    power = _power(x)
    whole = _times_power(x, -(power + LOWEST)).cast("bigint")
    moved = whole.cast("decimal(18,0)") * F.pow(F.lit(2.0), F.pmod(power, F.lit(POWERS))).cast("decimal(5,0)")
    return F.when(slot(x).isNotNull(), moved.cast("decimal(28,0)"))


def _wide(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _limb(value: Column) -> Column:
    return F.pmod(value, _wide(F.lit(BASE))).cast("bigint")


def _over(value: Column) -> Column:
    """What goes into the next slot."""
    return _wide((value - _limb(value)) / F.lit(BASE))


def _carried(totals: Column) -> Column:
    """What is left above the highest slot: 0, or -1 where the whole is negative."""
    return F.aggregate(totals, _wide(F.lit(0)), lambda carry, t: _over(_wide(carry + t)))


def _limbs(totals: Column) -> Column:
    """The whole in digits of BASE, the lowest first."""
    start = F.struct(_wide(F.lit(0)).alias("carry"), F.array().cast("array<bigint>").alias("limbs"))

    def step(state: Column, t: Column) -> Column:
        value = _wide(state["carry"] + t)
        return F.struct(_over(value).alias("carry"), F.concat(state["limbs"], F.array(_limb(value))).alias("limbs"))

    return F.aggregate(totals, start, step, lambda state: state["limbs"])


def rounded(slots: DataFrame, keys: Sequence[str], entries: str) -> DataFrame:
    """keys, `total` from arrays of (slot, piece sum): one projection a step, so that each is worked out once."""
    low = F.array_min(F.transform(F.col(entries), lambda e: e["slot"]))
    high = F.array_max(F.transform(F.col(entries), lambda e: e["slot"]))
    frame = slots.select("*", low.alias("__low"), high.alias("__high"), F.map_from_entries(F.col(entries)).alias("__by_slot"))

    def at(s: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("__by_slot"), s), _wide(F.lit(0)))

    # A group without entries has a null here, and no total but zero.
    places = F.sequence(F.col("__low"), F.col("__high") + CARRIES)
    frame = frame.withColumn("__totals", F.transform(places, at))
    frame = frame.withColumn("__sign", F.when(_carried(F.col("__totals")) < 0, -1).otherwise(1))
    frame = frame.withColumn("__limbs", _limbs(F.transform("__totals", lambda t: _wide(t * F.col("__sign")))))
    frame = frame.withColumn("__top", F.array_max(F.transform("__limbs", lambda x, i: F.when(x > 0, i))))
    head = _wide(F.lit(0))
    for k in range(HEAD):
        head = _wide(head * BASE + F.coalesce(F.get("__limbs", F.col("__top") - k), F.lit(0)))
    # One more bit says whether anything stands below, so that halves are told from what is more than a half.
    below = F.exists(F.slice("__limbs", 1, F.greatest(F.col("__top") - HEAD + 1, F.lit(0))), lambda x: x > 0)
    frame = frame.withColumn("__head", _wide(head * 2 + F.when(below, 1).otherwise(0)))
    power = (F.col("__low") + F.col("__top") - (HEAD - 1)) * POWERS + LOWEST - 1
    size = _times_power(F.col("__head").cast("double"), power) * F.col("__sign")
    return frame.withColumn("total", F.when(F.col("__top").isNull(), 0.0).otherwise(size)).select(*keys, *_rest(slots, keys, entries), "total")


def _rest(slots: DataFrame, keys: Sequence[str], entries: str) -> list[str]:
    return [c for c in slots.columns if c not in (*keys, entries)]


def exact_sums(rows: DataFrame, keys: Sequence[str], value: str, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """keys, further `counts` (boolean columns, counted), n and total: the sum of a column of doubles per group, rounded once.

    NULLs are left out; n counts the others. A group with non-finite values has their sum, infinite or NaN, and one of NULLs
    alone has no total. Zeros of either sign add up to 0.0. A total beyond all doubles is infinite. One shuffle by the keys
    and slot after map-side sums, so a hot key is a row a task and slot, and one by the keys. Keys and counts bear other names than n and total.
    """
    counts = dict(counts or {})
    x = F.col(value)
    split = rows.select(
        *keys, *[c.alias(name) for name, c in counts.items()], x.alias("__x"), slot(x).alias("__slot"), piece(x).alias("__piece")
    )
    sums = split.groupBy(*keys, "__slot").agg(
        *[F.count_if(F.col(name)).alias(name) for name in counts],
        F.count("__x").alias("n"),
        F.sum(F.when(~is_finite(F.col("__x")), F.col("__x"))).alias("__odd"),
        F.sum("__piece").cast("decimal(38,0)").alias("__sum"),
    )
    entry = F.when(F.col("__slot").isNotNull(), F.struct(F.col("__slot").alias("slot"), F.col("__sum").alias("sum")))
    slots = sums.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in counts],
        F.sum("n").alias("n"),
        F.sum("__odd").alias("__odd"),
        F.collect_list(entry).alias("__entries"),
    )
    whole = rounded(slots, keys, "__entries")
    total = F.when(F.col("n") > 0, F.coalesce("__odd", "total"))
    return whole.select(*keys, *counts, "n", total.alias("total"))
