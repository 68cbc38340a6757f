"""One query per operator or composed question, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    code_count,
    codes,
    key_text,
    label_text,
    month_of,
    parse_date,
    parse_date_clamped,
    parse_double,
    parse_id,
    parse_int,
    size_rank,
    trimmed,
)
from ..once import keep_whole, with_column_once
from ..operators import percentiles, promotions, quality, trailing, variety
from ..plans import IN_PLAN, best_sizes, median_by_month_state, promotion_spread, qualified_by_city
from ..plans.cancellations import code_periods, listed_codes, qualified_orders
from ..plans.look_back import size_stats, size_totals
from ..sources import (
    cancellation_rows,
    classify_lines,
    parse_lines,
    read_partitions,
    read_permissive,
    read_strict,
    require_columns,
    require_width,
    spread_rows,
    style_rows,
    window_rows,
    write_parquet,
    write_partitions,
    write_text,
)
from ..sources.contract import (
    CANCELLATION_COLUMNS,
    COLUMNS,
    COUNT_COLUMNS,
    HEADER_PREFIX,
    SPREAD_COLUMNS,
    STYLE_COLUMNS,
    WINDOW_COLUMNS,
)
from ..sources.sinks import land, work_folder
from ..sources.tables import raw_lines, raw_orders

# The test tables are smaller and longer-lived than a season of real orders.
CUTOFF = 1_200
MIN_DAYS = 2_200
TAX = 1.0825


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_lines(spark, sf_dir, WINDOW_COLUMNS)


def _styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_lines(spark, sf_dir, STYLE_COLUMNS)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cancellation_rows(raw_orders(spark, sf_dir, CANCELLATION_COLUMNS))


def _promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cancellation_rows(raw_orders(spark, sf_dir, ("index", "Date", "promotion-ids")))


def _spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_rows(raw_orders(spark, sf_dir, SPREAD_COLUMNS))


def _as_double(rows: DataFrame) -> DataFrame:
    """Amounts as doubles, the type every reader of the results agrees on."""
    return rows.withColumn("amount", F.col("amount").cast("double"))


def bought_by_state(spark, sf_dir):
    return trailing.bought_counts(window_rows(raw_lines(spark, sf_dir, COUNT_COLUMNS)))


def window_length_by_state(spark, sf_dir):
    return trailing.window_lengths(bought_by_state(spark, sf_dir), CUTOFF)


def trailing_size_stats(spark, sf_dir):
    return size_stats(_lines(spark, sf_dir), CUTOFF, check=IN_PLAN)


def trailing_winners(spark, sf_dir):
    return best_sizes(_lines(spark, sf_dir), CUTOFF, check=IN_PLAN)


def trailing_winners_default(spark, sf_dir):
    """With the question's own cutoff, which both window lengths meet from sf0.1 on."""
    return best_sizes(_lines(spark, sf_dir), check=IN_PLAN)


def tied_top_sizes(spark, sf_dir):
    ties = trailing.tie_groups(size_totals(_lines(spark, sf_dir), CUTOFF, check=IN_PLAN))
    return ties.groupBy("tied_sizes").agg(F.count(F.lit(1)).alias("tie_groups"))


def style_varieties(spark, sf_dir):
    return variety.style_variety(style_rows(_styles(spark, sf_dir)))


def median_varieties(spark, sf_dir):
    return median_by_month_state(_styles(spark, sf_dir))


def promotion_periods(spark, sf_dir):
    exploded = promotions.explode_promotions(_promoted(spark, sf_dir))
    return promotions.valid_promotions(exploded, MIN_DAYS)


def valid_promotions_per_order(spark, sf_dir):
    orders = _promoted(spark, sf_dir)
    exploded = promotions.explode_promotions(orders)
    valid = promotions.valid_promotions(exploded, MIN_DAYS, salted=True)
    counted = promotions.with_valid_counts(orders, promotions.valid_counts(exploded, valid))
    return counted.select("row_id", "valid_promotion_count")


def average_by_state(spark, sf_dir):
    return promotions.state_averages(_orders(spark, sf_dir))


def _any_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders whose amounts, with a tax, have more decimals than cents."""
    taxed = parse_double(F.col("Amount")) * F.lit(TAX)
    raw = raw_orders(spark, sf_dir, CANCELLATION_COLUMNS)
    return raw.withColumn("Amount", F.coalesce(taxed.cast("string"), F.col("Amount")))


def average_of_any_amounts(spark, sf_dir):
    return promotions.state_averages(cancellation_rows(_any_amounts(spark, sf_dir), scale=None))


def cancellations_of_any_amounts(spark, sf_dir):
    return qualified_by_city(_any_amounts(spark, sf_dir), MIN_DAYS, check=IN_PLAN, scale=None)


def classified_cancellations(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    exploded = promotions.explode_promotions(orders)
    valid = promotions.valid_promotions(exploded, MIN_DAYS, salted=True)
    base = promotions.cancelled_standard(orders)
    counted = promotions.with_valid_counts(base, promotions.valid_counts(exploded, valid))
    averaged = promotions.with_state_average(counted, promotions.state_averages(orders))
    return promotions.classify(averaged).select(
        "row_id", "city", "state", "valid_promotion_count", "state_average_amount", "is_qualified"
    )


def cancellations_by_city(spark, sf_dir):
    return qualified_by_city(raw_orders(spark, sf_dir, CANCELLATION_COLUMNS), MIN_DAYS, check=IN_PLAN)


def first_cities(spark, sf_dir):
    city = F.coalesce(F.col("city"), F.lit(""))
    # A blank and a missing city share the sort text; the flag orders the two.
    ordered = cancellations_by_city(spark, sf_dir).orderBy(city, F.col("city").isNull())
    return ordered.limit(30)


def promotion_profile(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    sums, codes = keep_whole(promotions.place_sums(orders)), listed_codes(orders)
    qualified = qualified_orders(codes, promotions.averages_of(sums), MIN_DAYS)
    return quality.promotion_profile(sums, code_periods(codes), qualified, MIN_DAYS)


def promotions_per_order(spark, sf_dir):
    return _as_double(_spread(spark, sf_dir))


def approx_thresholds(spark, sf_dir):
    return percentiles.approx_thresholds(_spread(spark, sf_dir))


def exact_thresholds(spark, sf_dir):
    return percentiles.exact_thresholds(_spread(spark, sf_dir))


def approx_spread(spark, sf_dir):
    return percentiles.approx_summary(_spread(spark, sf_dir))


def sketched_thresholds(spark, sf_dir):
    return percentiles.sketched_thresholds(_spread(spark, sf_dir))


def exact_spread(spark, sf_dir):
    return percentiles.exact_summary(_spread(spark, sf_dir))


def spread_comparison(spark, sf_dir):
    return promotion_spread(raw_orders(spark, sf_dir, SPREAD_COLUMNS), check=IN_PLAN)


def first_comparisons(spark, sf_dir):
    return spread_comparison(spark, sf_dir).orderBy(*percentiles.GROUP).limit(30)


def one_comparison(spark, sf_dir):
    return percentiles.group_lookup(spread_comparison(spark, sf_dir), "Sku-7", "2016-04")


def difference_report(spark, sf_dir):
    return percentiles.difference_report(spread_comparison(spark, sf_dir))


def group_profile(spark, sf_dir):
    return quality.group_profile(_spread(spark, sf_dir))


def id_report_lines(spark, sf_dir):
    ids = raw_lines(spark, sf_dir, ("index",)).select(parse_id(F.col("index")).alias("row_id"))
    return quality.id_report(ids)


def id_report_orders(spark, sf_dir):
    return quality.id_report(_promoted(spark, sf_dir))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines as CSV text in column `value`, with faults of every kind among them."""
    raw = raw_lines(spark, sf_dir)
    options = {
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    record = F.to_csv(F.struct(*[F.col(f"`{name}`") for name in COLUMNS]), options)
    quantity = F.trim("Qty").try_cast("int")
    lines = with_column_once(raw, "line", record).select(
        "line", F.when(F.col("Order ID").endswith("11"), quantity).alias("kind")
    )
    line, kind = F.col("line"), F.col("kind")
    text = (
        F.when(kind == 10, F.concat(F.lit(HEADER_PREFIX), line))
        .when(kind == 11, "")
        .when(kind == 12, F.concat(F.lit('"'), line))
        .when(kind == 13, F.concat(F.lit('"a"b,'), line))
        .when(kind == 14, F.concat(line, F.lit(",extra")))
        .when(kind == 15, F.lit("1,short,row"))
        .when(kind == 16, F.concat(F.lit('"one, two",'), line))
        .otherwise(line)
    )
    return lines.select(text.alias("value"))


def _checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(classify_lines(csv_lines(spark, sf_dir)))


def line_faults(spark, sf_dir):
    fault = F.coalesce(F.col("fault"), F.lit("usable"))
    return quality.ledger(classify_lines(csv_lines(spark, sf_dir)), fault)


def count_ledger(spark, sf_dir):
    rows = window_rows(_checked_lines(spark, sf_dir), keep=("fault",))
    return quality.ledger(rows, quality.count_reason())


def window_ledger(spark, sf_dir):
    rows = window_rows(_checked_lines(spark, sf_dir), keep=("fault",))
    fates = keep_whole(quality.window_fates(rows))
    lengths = trailing.window_lengths(quality.bought_fates(fates), CUTOFF)
    # A lookup of the busy states alone, so that the lines of the others show as misses.
    return quality.window_ledger(fates, lengths.filter(F.col("n") > CUTOFF))


def amount_ledger(spark, sf_dir):
    return quality.amount_report(raw_lines(spark, sf_dir, ("Amount",)))


def variety_ledger(spark, sf_dir):
    return quality.variety_ledger(style_rows(_checked_lines(spark, sf_dir), keep=("fault",)))


def cleaned_lines(spark, sf_dir):
    """Every cleaning expression on every dirty line."""
    raw = raw_lines(spark, sf_dir)
    day = parse_date_clamped(F.col("Date"))
    size = key_text(F.col("Size"))
    return raw.select(
        F.col("`Order ID`").alias("order_id"),
        parse_id(F.col("index")).alias("row_id"),
        key_text(F.col("ship-state")).alias("state_key"),
        label_text(F.col("ship-state")).alias("state_label"),
        trimmed(F.col("SKU")).alias("sku"),
        key_text(F.col("Status")).contains("SHIPPED").alias("is_shipped"),
        size.alias("size"),
        size_rank(size).alias("size_rank"),
        parse_int(F.col("Qty")).alias("qty"),
        parse_double(F.col("Amount")).alias("amount"),
        day.alias("clamped_date"),
        parse_date(F.col("Date")).alias("order_date"),
        month_of(day).alias("month"),
    )


def promotion_codes(spark, sf_dir):
    """The list functions on every order: the codes again as text, and their number."""
    raw = raw_orders(spark, sf_dir, ("index", "promotion-ids"))
    listed = F.col("promotion-ids")
    return raw.select(
        parse_id(F.col("index")).alias("row_id"),
        F.array_join(codes(listed), "|").alias("codes"),
        code_count(listed).alias("promotion_count"),
    )


def csv_round_trip(spark, sf_dir):
    """Orders out as headered CSV, in again leniently, checked, typed and landed as Parquet."""
    raw = raw_orders(spark, sf_dir)
    text = f"{work_folder(spark, 'csv_round_trip')}/csv"
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.mode("overwrite").options(header=True, escape='"', **spaces).csv(text)
    again = require_width(read_permissive(spark, text))
    require_columns(again, [*CANCELLATION_COLUMNS, *SPREAD_COLUMNS])
    return _as_double(land(spread_rows(again), f"{work_folder(spark, 'csv_round_trip')}/parquet"))


def strict_round_trip(spark, sf_dir):
    """Faulty lines out as text, in again strictly, and the bought rows counted."""
    text = f"{work_folder(spark, 'strict_round_trip')}/lines"
    csv_lines(spark, sf_dir).write.mode("overwrite").text(text)
    good, _ = read_strict(spark, text)
    return trailing.bought_counts(window_rows(good))


def quarantined_lines(spark, sf_dir):
    """The quarantine of the same read."""
    text = f"{work_folder(spark, 'quarantined_lines')}/lines"
    csv_lines(spark, sf_dir).write.mode("overwrite").text(text)
    _, rejected = read_strict(spark, text)
    return quality.ledger(rejected, F.col("fault"))


def text_sink(spark, sf_dir):
    """Median varieties through the headerless text sink."""
    path = f"{work_folder(spark, 'text_sink')}/text"
    write_text(median_varieties(spark, sf_dir), path, order_by=("month", "state"))
    schema = "month STRING, state STRING, median DOUBLE, style_count BIGINT"
    return spark.read.schema(schema).csv(path)


def winners_text_sink(spark, sf_dir):
    """Trailing winners through the same sink; an unknown variance is written as Infinity."""
    path = f"{work_folder(spark, 'winners_text_sink')}/text"
    write_text(trailing_winners(spark, sf_dir), path, order_by=trailing.STATE_DAY)
    schema = (
        "state STRING, window_date DATE, size STRING, frequency BIGINT, variance DOUBLE,"
        " amount_count BIGINT, window_days INT"
    )
    return spark.read.schema(schema).csv(path)


def parquet_sink(spark, sf_dir):
    """City shares through the Parquet sink."""
    path = f"{work_folder(spark, 'parquet_sink')}/parquet"
    write_parquet(cancellations_by_city(spark, sf_dir), path)
    return spark.read.parquet(path)


def rewritten_month(spark, sf_dir):
    """Orders stored by month, of which the first month is written anew with doubled amounts: per month the orders, their
    total, and whether the month still has the files it had."""
    path = f"{work_folder(spark, 'months')}/parquet"
    rows = _spread(spark, sf_dir)
    write_partitions(rows, path, ["month"], order_by=["sku", "row_id"])
    stored = read_partitions(spark, path, rows.schema)
    files = lambda df: df.select("month", F.col("_metadata.file_path").alias("file")).distinct()
    before = land(files(stored), f"{work_folder(spark, 'month_files')}/parquet")
    first = stored.agg(F.min("month").alias("month"))
    doubled = F.col("amount") * 2
    changed = stored.join(F.broadcast(first), "month").withColumn("amount", doubled.cast(rows.schema["amount"].dataType))
    changed = land(changed.select(*rows.columns), f"{work_folder(spark, 'first_month')}/parquet")
    write_partitions(changed, path, ["month"], order_by=["sku", "row_id"])
    stored = read_partitions(spark, path, rows.schema)
    now = files(stored).withColumn("now", F.lit(1)).join(before.withColumn("then", F.lit(1)), ["month", "file"], "full")
    kept = now.groupBy("month").agg(F.count_if(F.col("now").isNull() | F.col("then").isNull()).alias("changed"))
    totals = stored.groupBy("month").agg(F.count(F.lit(1)).alias("orders"), F.sum("amount").cast("double").alias("total"))
    return totals.join(kept, "month").select("month", "orders", "total", (F.col("changed") == 0).alias("files_kept"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "q01_bought_by_state": bought_by_state,
        "q02_window_length_by_state": window_length_by_state,
        "q03_trailing_size_stats": trailing_size_stats,
        "q04_trailing_winners": trailing_winners,
        "q04_trailing_winners_default": trailing_winners_default,
        "q05_tied_top_sizes": tied_top_sizes,
        "q06_style_varieties": style_varieties,
        "q07_median_varieties": median_varieties,
        "q08_promotion_periods": promotion_periods,
        "q09_valid_promotions_per_order": valid_promotions_per_order,
        "q10_average_by_state": average_by_state,
        "q10_average_of_any_amounts": average_of_any_amounts,
        "q11_cancellations_by_city": cancellations_by_city,
        "q11_cancellations_of_any_amounts": cancellations_of_any_amounts,
        "q11_classified_cancellations": classified_cancellations,
        "q11_first_cities": first_cities,
        "q12_promotion_profile": promotion_profile,
        "q13_promotions_per_order": promotions_per_order,
        "q14_approx_thresholds": approx_thresholds,
        "q14_sketched_thresholds": sketched_thresholds,
        "q15_exact_thresholds": exact_thresholds,
        "q16_approx_spread": approx_spread,
        "q17_exact_spread": exact_spread,
        "q18_spread_comparison": spread_comparison,
        "q18_first_comparisons": first_comparisons,
        "q18_one_comparison": one_comparison,
        "q19_difference_report": difference_report,
        "q20_group_profile": group_profile,
        "q21_id_report_lines": id_report_lines,
        "q21_id_report_orders": id_report_orders,
        "q22_line_faults": line_faults,
        "q22_count_ledger": count_ledger,
        "q22_window_ledger": window_ledger,
        "q22_amount_ledger": amount_ledger,
        "q22_variety_ledger": variety_ledger,
        "q23_cleaned_lines": cleaned_lines,
        "q23_promotion_codes": promotion_codes,
        "q24_csv_round_trip": csv_round_trip,
        "q24_strict_round_trip": strict_round_trip,
        "q24_quarantined_lines": quarantined_lines,
        "q24_text_sink": text_sink,
        "q24_winners_text_sink": winners_text_sink,
        "q24_parquet_sink": parquet_sink,
        "q24_rewritten_month": rewritten_month,
    }
