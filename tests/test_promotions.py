import random
from collections import defaultdict
from datetime import date, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderlens.operators import promotions as promo
from orderlens.operators.quality import promotion_profile
from orderlens.plans import (
    best_sizes,
    median_by_month_state,
    promotion_spread,
    qualified_by_city,
)
from orderlens.plans.cancellations import (
    code_periods,
    listed_codes,
    qualified_orders,
    qualified_shares,
)
from orderlens.sources import cancellation_rows

DAY = date(2022, 4, 1)


def order(
    index, codes=None, day=DAY, city="c", state="s", amount="5", status="Cancelled",
    service="Standard", fulfilment="Merchant", courier="Shipped",
):
    return {
        "index": str(index), "promotion-ids": codes, "ship-city": city, "ship-state": state,
        "Date": day if isinstance(day, str) else day.strftime("%m-%d-%y"), "Amount": amount,
        "Status": status, "ship-service-level": service, "Fulfilment": fulfilment,
        "Courier Status": courier,
    }


def test_codes_are_trimmed_case_sensitive_and_repeats_count(raw):
    orders = cancellation_rows(
        raw([order(1, " A ,a, A,,"), order(2, None), order(3, "B", day="02-30-22")])
    )
    found = promo.explode_promotions(orders).select("row_id", "promo").collect()
    assert sorted(map(tuple, found)) == [(1, "A"), (1, "A"), (1, "a")]


def test_a_promotion_is_valid_from_two_days_on(raw):
    rows = [order(1, "A,B"), order(2, "A", DAY + timedelta(1)), order(3, "B", DAY + timedelta(2))]
    exploded = promo.explode_promotions(cancellation_rows(raw(rows)))
    valid = promo.valid_promotions(exploded).collect()
    assert [tuple(r) for r in valid] == [("B", DAY, DAY + timedelta(2), 2)]


def test_orders_without_valid_codes_count_zero(raw):
    orders = cancellation_rows(raw([order(1, "A,A,X"), order(2, "X"), order(3), order(4, "A", "x")]))
    valid = orders.sparkSession.createDataFrame([("A",)], "promo string")
    counts = promo.valid_counts(promo.explode_promotions(orders), valid)
    got = promo.with_valid_counts(orders, counts).select("row_id", "valid_promotion_count")
    assert sorted(map(tuple, got.collect())) == [(1, 2), (2, 0), (3, 0), (4, 0)]


def test_averages_use_equality_for_the_courier_and_need_state_and_amount(raw):
    rows = [
        order(1, amount="1"), order(2, amount="2"), order(3, amount="90", courier="Shipped late"),
        order(4, amount="90", fulfilment="Own"), order(5, amount=""), order(6, state="  "),
        order(7, state=None), order(8, state="t", amount="4", courier=" shipped "),
    ]
    averages = promo.state_averages(cancellation_rows(raw(rows))).collect()
    assert sorted(map(tuple, averages)) == [("S", 1.5), ("T", 4.0)]


LONG = [order(900, "A,B,C", status="Shipped", amount="10"),
        order(901, "A,B,C", DAY + timedelta(2), status="Shipped", amount="10")]


@pytest.mark.parametrize(
    "changes, qualified",
    [
        ({}, 1),
        ({"codes": "A,A,B"}, 1),
        ({"codes": "A,B"}, 0),
        ({"codes": "A,B,X"}, 0),
        ({"amount": "10"}, 0),
        ({"amount": ""}, 0),
        ({"state": "unknown"}, 0),
        ({"state": None}, 0),
        ({"day": "13-01-22"}, 0),
    ],
)
def test_what_qualifies(raw, changes, qualified):
    row = order(1, **{"codes": "A,B,C", "amount": "1", "courier": "None", **changes})
    result = qualified_by_city(raw([*LONG, row])).collect()
    assert [tuple(r) for r in result] == [("C", 1, qualified, 100.0 * qualified)]


def test_missing_and_blank_cities_are_groups_of_their_own(raw):
    rows = [order(1, city=None), order(2, city="  "), order(3, city=" c "), order(4, city="C"),
            order(5, status="Pending"), order(6, service="Expedited")]
    result = {r["city"]: r["cancelled_standard_count"] for r in qualified_by_city(raw(rows)).collect()}
    assert result == {None: 1, "": 1, "C": 2}


def random_orders(seed, n=500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        codes = [rng.choice(["H"] if hot else [f"P{k}" for k in range(30)]) for _ in range(rng.randrange(6))]
        rows.append(
            order(
                i,
                " ,".join(codes) if codes else None,
                day=DAY + timedelta(rng.randrange(40)) if rng.random() < 0.95 else "x",
                city="hot" if hot else rng.choice(["a", "b", None, " "]),
                state="hot" if hot else rng.choice(["s", "t", None]),
                amount=rng.choice(["", "1.10", "2.20", "30.30", "4"]),
                status=rng.choice(["Cancelled", "Shipped", "cancelled by buyer"]),
                service=rng.choice(["Standard", "standard ", "Expedited"]),
                fulfilment=rng.choice(["Merchant", "Own"]),
                courier=rng.choice(["Shipped", "Lost"]),
            )
        )
    return rows


def brute_force(rows, min_days):
    uses = defaultdict(list)

    def codes(r):
        return [c.strip() for c in (r["promotion-ids"] or "").split(",") if c.strip()]

    for r in rows:
        if r["Date"] != "x":
            m, d, y = map(int, r["Date"].split("-"))
            for code in codes(r):
                uses[code].append(date(2000 + y, m, d))
    valid = {c for c, days in uses.items() if (max(days) - min(days)).days >= min_days}
    amounts = defaultdict(list)
    for r in rows:
        state = r["ship-state"]
        if r["Fulfilment"] == "Merchant" and r["Courier Status"] == "Shipped" and state and r["Amount"]:
            amounts[state].append(Fraction(r["Amount"]))
    average = {s: sum(a) / len(a) for s, a in amounts.items()}
    result = defaultdict(lambda: [0, 0])
    for r in rows:
        if "cancelled" not in r["Status"].lower() or r["ship-service-level"].strip().lower() != "standard":
            continue
        city = None if r["ship-city"] is None else r["ship-city"].strip().upper()
        result[city][0] += 1
        n = sum(c in valid for c in codes(r)) if r["Date"] != "x" else 0
        mean = average.get(r["ship-state"])
        if n >= 3 and r["Amount"] and mean is not None and Fraction(r["Amount"]) < mean:
            result[city][1] += 1
    return {c: (n, q, pytest.approx(100 * q / n, abs=1e-6)) for c, (n, q) in result.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_hot_keys(raw, seed):
    rows = random_orders(seed)
    result = {r[0]: tuple(r[1:]) for r in qualified_by_city(raw(rows), min_days=38).collect()}
    assert result == brute_force(rows, 38)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_plan_equals_the_operators_one_by_one(spark, raw, threshold):
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        orders = cancellation_rows(raw(random_orders(3)))
        exploded = promo.explode_promotions(orders)
        valid = promo.valid_promotions(exploded, 38)
        counted = promo.with_valid_counts(orders, promo.valid_counts(exploded, valid))
        averaged = promo.with_state_average(counted, promo.state_averages(orders))
        flagged = promo.classify(promo.cancelled_standard(averaged)).withColumn("cancelled", F.lit(1))
        stepwise = promo.city_shares(flagged.withColumn("qualified", F.col("is_qualified").cast("int")))
        direct = qualified_shares(orders, 38)
        assert sorted(map(str, stepwise.collect())) == sorted(map(str, direct.collect()))
        sums, codes = promo.place_sums(orders), listed_codes(orders)
        found = qualified_orders(codes, promo.averages_of(sums), 38)
        profile = promotion_profile(sums, code_periods(codes), found, 38)
        metrics = {r["metric"]: r["value"] for r in profile.collect()}
        base = promo.cancelled_standard(orders)
        assert metrics["promotion_codes"] == exploded.select("promo").distinct().count()
        assert metrics["valid_promotion_codes"] == valid.count()
        assert metrics["cancelled_standard_rows"] == base.count()
        assert metrics["cancelled_cities"] == base.select("city").distinct().count()
        assert metrics["qualified_rows"] == flagged.filter("is_qualified").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


def test_a_code_on_every_order_is_not_one_task_s_work(spark, raw):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        orders = cancellation_rows(raw([order(i, "HOT", DAY + timedelta(i % 9)) for i in range(400)]))
        codes = listed_codes(orders, 1)
        valid = code_periods(codes).filter("active_days >= 2")
        joined = codes.join(promo.salted(valid), ["promo", "salt"])
        shares = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in shares) == 400 and max(r["count"] for r in shares) < 250
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [promo" in plan and "salt" in plan.split("SortMergeJoin")[1][:60]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_orders_are_read_twice(spark, raw, tmp_path):
    path = str(tmp_path / "orders")
    raw(random_orders(4)).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        orders = cancellation_rows(spark.read.parquet(path))
        plan = qualified_shares(orders, 38)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") == 2 and "ReusedExchange" in plan


def test_plans_check_their_input(raw):
    with pytest.raises(ValueError, match="1 null or non-numeric"):
        qualified_by_city(raw([order(1), order("x")]))
    with pytest.raises(ValueError, match="1 ids occur more than once"):
        qualified_by_city(raw([order(1), order(1)]))
    with pytest.raises(ValueError, match="Amount '1e17'"):
        qualified_by_city(raw([order(1, amount="1e17")]))
    with pytest.raises(ValueError, match="Amount '1e17'"):
        best_sizes(raw([order(1, amount="1e17")]))
    with pytest.raises(ValueError, match="window length table is empty"):
        best_sizes(raw([order(1)]))
    for plan in (best_sizes, qualified_by_city, median_by_month_state):
        with pytest.raises(ValueError, match="lacks"):
            plan(raw([order(1)]).drop("ship-state"))
    with pytest.raises(ValueError, match="23 columns in place of 24"):
        promotion_spread(raw([order(1)]).drop("SKU"))
    assert qualified_by_city(raw([order(1), order(2)])).count() == 1
    assert qualified_by_city(raw([order(1), order(1)]), check=False).count() == 1
    sold = [{**order(i), "SKU": "k"} for i in (1, 1, "x")]
    with pytest.raises(ValueError, match="1 ids occur more than once"):
        promotion_spread(raw(sold))
