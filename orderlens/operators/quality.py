"""Row-id checks, reject ledgers and sanity profiles.

Ledgers are grouped counts, not accumulators: a retried task counts once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money_fault
from ..functions.numbers import SCALE, TOO_LARGE, too_fine
from ..functions.text import is_present
from ..once import keep_whole, same_for_all
from .percentiles import GROUP
from .promotions import averages_of
from .trailing import is_bought

LARGE_GROUP = 1_000


def id_word(id_: Column) -> Column:
    """The 64 ids that an id stands among."""
    return F.shiftright(id_.cast("bigint"), 6)


def id_sums(id_: Column) -> dict[str, Column]:
    """Per word of 64 ids: how often they occur, and a bit for each that does.

    Both are summed in every task before they move, so ids that lie close together are shuffled as one row of
    24 bytes for up to 64 of them; ids far apart as one row each, as a plain group by id would.
    """
    place = F.pmod(id_.cast("bigint"), F.lit(64)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return {"id_rows": F.count(F.lit(1)), "id_bits": F.bit_or(bit)}


def id_words(rows: DataFrame, column: str = "row_id") -> DataFrame:
    """id_word, id_rows, id_bits; a null word for rows without id."""
    sums = id_sums(F.col(column))
    return rows.groupBy(id_word(F.col(column)).alias("id_word")).agg(*[value.alias(name) for name, value in sums.items()])


def _repeats() -> Column:
    """How many rows of a word of ids are not the first of their id."""
    return F.col("id_rows") - F.bit_count("id_bits")


def id_faults(words: DataFrame) -> DataFrame:
    """One row: rows without an id, and rows that repeat the id of another."""
    return words.agg(*_fault_counts())


def _fault_counts() -> list[Column]:
    missing = F.col("id_word").isNull()
    nothing = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.sum(F.when(missing, F.col("id_rows"))), nothing).alias("null_ids"),
        F.coalesce(F.sum(F.when(~missing, _repeats())), nothing).alias("repeats"),
    ]


def id_report(rows: DataFrame, column: str = "row_id") -> DataFrame:
    """One row: rows without an id, ids used more than once.

    The words of ids tell which of them hold repeated ids; only rows of those are counted id by id.
    """
    words = keep_whole(id_words(rows, column))
    doubtful = words.where(F.col("id_word").isNotNull() & (_repeats() > 0)).select("id_word")
    ids = rows.select(F.col(column).alias("id"), id_word(F.col(column)).alias("id_word"))
    uses = ids.join(doubtful, "id_word", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("uses"))
    repeated = uses.agg(F.count_if(F.col("uses") > 1).alias("duplicate_ids"))
    nothing = F.lit(0).cast("bigint")
    both = id_faults(words).select("null_ids", nothing.alias("duplicate_ids"))
    both = both.unionByName(repeated.select(nothing.alias("null_ids"), "duplicate_ids"))
    return both.agg(F.sum("null_ids").alias("null_ids"), F.sum("duplicate_ids").alias("duplicate_ids"))


def require_unique(rows: DataFrame, column: str = "row_id", allow_null: bool = False) -> DataFrame:
    """The rows themselves, or an error. Runs one aggregation, and another one only to say how many ids are repeated."""
    faults = id_faults(id_words(rows, column)).first()
    if faults["null_ids"] and not allow_null:
        raise ValueError(f"{column}: {faults['null_ids']} null or non-numeric ids")
    if faults["repeats"]:
        repeated = id_report(rows, column).first()["duplicate_ids"]
        raise ValueError(f"{column}: {repeated} ids occur more than once")
    return rows


def unique_fault(words: DataFrame, column: str = "row_id") -> DataFrame:
    """One row with `fault`, for `guarded`: what is wrong with the ids, or null. No row without ids."""
    said = lambda n, what: F.concat(F.lit(f"{column}: "), n.cast("string"), F.lit(what))
    fault = F.when(F.col("null_ids") > 0, said(F.col("null_ids"), " null or non-numeric ids")).when(
        F.col("repeats") > 0, said(F.col("repeats"), " rows repeat an id")
    )
    counts = words.groupBy(same_for_all("id_rows").alias("every")).agg(*_fault_counts())
    return counts.select(fault.alias("fault"))


def empty_fault(lookup: DataFrame, name: str = "lookup") -> DataFrame:
    """One row with `fault`, for `guarded`: that the lookup has no rows, or null."""
    # A row of no weight is there in any case.
    none = lookup.sparkSession.range(1).select(F.col("id").alias("n"))
    rows = lookup.select(F.lit(1).cast("bigint").alias("n")).unionByName(none)
    counted = rows.groupBy(same_for_all("n").alias("every")).agg(F.sum("n").alias("n"))
    return counted.select(F.when(F.col("n") == 0, F.lit(f"The {name} table is empty")).alias("fault"))


def beside_ids(
    rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], column: str = "row_id"
) -> tuple[DataFrame, DataFrame]:
    """The measures per key and the words of ids, from one reading and one shuffle of the rows.

    Every row counts for its keys and for its id's word, in one aggregate. (Grouping sets would do the same, but Spark does
    not see that two uses of them are the same plan.)
    """
    sums = id_sums(F.col(column))
    none = [F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in keys]
    places = F.array(
        F.struct(*keys, F.lit(None).cast("bigint").alias("id_word"), F.lit(True).alias("is_key")),
        F.struct(*none, id_word(F.col(column)).alias("id_word"), F.lit(False).alias("is_key")),
    )
    rest = [c for c in rows.columns if c not in keys]
    both = rows.select(*rest, F.inline(places)).groupBy(*keys, "id_word", "is_key")
    both = keep_whole(both.agg(*[value.alias(name) for name, value in {**measures, **sums}.items()]))
    return both.filter("is_key").select(*keys, *measures), both.filter("NOT is_key").select("id_word", *sums)


def guarded(result: DataFrame, *faults: DataFrame) -> DataFrame:
    """The result, which fails with the fault's text when it is read and one of the one-row frames has a fault.

    The faults are a part of the plan that adds no rows, so building it runs no job, and aggregates that they share
    with the result run once. A reader that stops after a few rows of the result may not reach them.
    """
    for fault in faults:
        refused = F.when(F.col("fault").isNotNull(), F.raise_error(F.col("fault")).cast("boolean")).otherwise(F.lit(False))
        none = fault.filter(refused).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema])
        result = result.unionByName(none)
    return result


def amount_report(raw: DataFrame, scale: int = SCALE) -> DataFrame:
    """reason, n: what becomes of the amounts. `out_of_range` ones are lost, `rounded` ones are changed."""
    return ledger(raw, F.coalesce(money_fault(F.col("Amount"), scale), F.lit("kept")))


def require_amounts(raw: DataFrame, scale: int = SCALE) -> DataFrame:
    """The rows themselves, or an error if an amount cannot be kept as it is. Reads the amounts once."""
    fault = money_fault(F.col("Amount"), scale)
    some = lambda kind: F.first(F.when(fault == kind, F.col("Amount")), ignorenulls=True)
    lost = raw.agg(some("out_of_range").alias("large"), some("rounded").alias("fine")).first()
    for amount, why in ((lost["large"], TOO_LARGE), (lost["fine"], too_fine(scale))):
        if amount is not None:
            raise ValueError(f"Amount {amount!r} {why}")
    return raw


def require_nonempty(lookup: DataFrame, name: str = "lookup") -> DataFrame:
    """The lookup itself, or an error when it has no rows. Reads at most one row."""
    if lookup.isEmpty():
        raise ValueError(f"The {name} table is empty")
    return lookup


def ledger(rows: DataFrame, reason: Column) -> DataFrame:
    """reason, n."""
    return rows.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def count_reason() -> Column:
    """Fate of a line in the per-state count; expects fault, state, status and qty."""
    return (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(~is_present(F.col("state")), "missing_state")
        .when(F.col("qty").isNull(), "invalid_qty")
        .when(is_bought(F.col("status"), F.col("qty")), "bought")
        .otherwise("not_bought")
    )


def window_reason() -> Column:
    """Fate of a line in the trailing window, the lookup aside."""
    return (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(~is_present(F.col("state")), "missing_state")
        .when(~is_bought(F.col("status"), F.col("qty")), "not_bought")
        .when(~is_present(F.col("size")), "missing_size")
        .when(F.col("order_date").isNull(), "invalid_date")
        .otherwise("source")
    )


def variety_reason() -> Column:
    """Fate of a line in the style count; expects fault, the three keys and order_date."""
    missing_key = ~(
        is_present(F.col("state")) & is_present(F.col("style")) & is_present(F.col("sku"))
    )
    return (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(missing_key, "missing_key")
        .when(F.col("order_date").isNull(), "invalid_date")
        .otherwise("valid")
    )


def window_fates(rows: DataFrame) -> DataFrame:
    """state, reason, n, no_amount: the ledger before the lookup, one row per state and reason."""
    return rows.groupBy("state", window_reason().alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("amount").isNull()).alias("no_amount")
    )


def bought_fates(fates: DataFrame) -> DataFrame:
    """state, n: the bought rows per state, whatever became of them afterwards."""
    bought = fates.filter(F.col("reason").isin("source", "missing_size", "invalid_date"))
    return bought.groupBy("state").agg(F.sum("n").alias("n"))


def window_ledger(fates: DataFrame, lengths: DataFrame) -> DataFrame:
    """Ledger of the trailing window, with the rows each reason sends on.

    The lookup is joined to the counts per (state, reason), not to the lines.
    """
    known = fates.join(lengths.select("state", "window_days"), "state", "left")
    has_state = is_present(F.col("state")) & F.col("window_days").isNull()
    reason = F.when(has_state, "state_not_in_lookup").otherwise(F.col("reason"))
    is_source = F.col("reason") == "source"
    emitted = F.when(is_source, F.col("n") * F.col("window_days")).otherwise(0)
    return (
        known.withColumn("reason", reason)
        .groupBy("reason")
        .agg(
            F.sum("n").alias("n"),
            F.sum(emitted).alias("emitted_rows"),
            F.sum(F.when(is_source, F.col("no_amount")).otherwise(0)).alias("rows_without_amount"),
        )
    )


def variety_ledger(rows: DataFrame) -> DataFrame:
    """Ledger of the style count, with the number of qualified styles as a last reason."""
    reason = variety_reason()
    # Both answers come from one aggregate; keys of other lines than valid ones do not matter.
    valid = lambda c: F.when(reason == "valid", c)
    keys = {name: valid(F.col(name)) for name in ("state", "style", "sku")}
    per_sku = keep_whole(
        rows.groupBy(
            reason.alias("reason"),
            valid(F.trunc("order_date", "month")).alias("month_start"),
            *[key.alias(name) for name, key in keys.items()],
        ).agg(F.count(F.lit(1)).alias("n"), F.bool_or("is_large").alias("is_large"))
    )
    fates = per_sku.groupBy("reason").agg(F.sum("n").alias("n"))
    styles = (
        per_sku.filter(F.col("reason") == "valid")
        .groupBy("month_start", "state", "style")
        .agg(F.bool_or("is_large").alias("is_large"))
        .agg(F.count_if("is_large").alias("n"))
    )
    return fates.unionByName(styles.select(F.lit("qualified_styles").alias("reason"), "n"))


def _as_metrics(one_row: DataFrame) -> DataFrame:
    """metric, value rows from the columns of a one-row frame."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("bigint").alias("value"))
            for name in one_row.columns
        ]
    )
    return one_row.select(F.inline(pairs))


def promotion_profile(
    sums: DataFrame, periods: DataFrame, qualified: DataFrame, min_days: int
) -> DataFrame:
    """Seven sanity counts as (metric, value), from the sums per place, the code periods and the qualified orders."""
    codes = periods.agg(
        F.count(F.lit(1)).alias("promotion_codes"),
        F.count_if(F.col("active_days") >= min_days).alias("valid_promotion_codes"),
    )
    states = averages_of(sums).agg(F.count(F.lit(1)).alias("state_averages"))
    by_city = (
        sums.filter(F.col("cancelled") > 0)
        .groupBy("city")
        .agg(F.sum("cancelled").alias("n"), F.sum("listed").alias("listed"))
    )
    nothing = F.lit(0).cast("bigint")
    cities = by_city.agg(
        F.count(F.lit(1)).alias("cancelled_cities"),
        F.coalesce(F.sum("n"), nothing).alias("cancelled_standard_rows"),
        F.coalesce(F.sum("listed"), nothing).alias("cancelled_with_promotions"),
    )
    found = qualified.agg(F.count(F.lit(1)).alias("qualified_rows"))
    parts = [_as_metrics(part) for part in (codes, states, cities, found)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def group_profile(orders: DataFrame, large: int = LARGE_GROUP) -> DataFrame:
    """One row about the (sku, month) groups: how many, how large, which promotion counts."""
    groups = orders.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("promotion_count").alias("low"),
        F.max("promotion_count").alias("high"),
    )
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("order_rows"),
        F.count(F.lit(1)).alias("group_count"),
        F.max("n").alias("largest_group"),
        F.count_if(F.col("n") > large).alias("large_groups"),
        F.min("low").alias("min_promotion_count"),
        F.max("high").alias("max_promotion_count"),
    )
