import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from orderlens.operators import percentiles
from orderlens.operators.quality import group_profile

SCHEMA = "row_id bigint, sku string, month string, amount decimal(18,2), promotion_count int"


@pytest.fixture
def orders(spark):
    def build(groups):
        rows = []
        for (sku, month), members in groups.items():
            for count, amount in members:
                rows.append((len(rows), sku, month, None if amount is None else Decimal(amount), count))
        return spark.createDataFrame(rows, SCHEMA)

    return build


def exact(values, fraction):
    position = (len(values) - 1) * fraction
    ranked = sorted(map(float, values))
    low, high = ranked[math.floor(position)], ranked[math.ceil(position)]
    return low + (position - math.floor(position)) * (high - low)


def nearest(values, fraction):
    return float(sorted(values)[math.ceil(len(values) * fraction) - 1])


def tail(members, threshold):
    chosen = [amount for count, amount in members if count >= threshold]
    known = [float(a) for a in chosen if a is not None]
    if len(chosen) < 2 or not known:
        return len(chosen), 0.0
    mean = sum(known) / len(known)
    spread = math.sqrt(sum((a - mean) ** 2 for a in known) / len(known))
    return len(chosen), pytest.approx(spread, abs=1e-6)


def random_groups(seed):
    rng = random.Random(seed)
    groups = defaultdict(list)
    sizes = {("a", "2022-04"): 1, ("b", "2022-04"): 2, ("c", "2022-04"): 10, ("d", "2022-04"): 11}
    sizes |= {(f"s{k}", "2022-05"): rng.randrange(1, 40) for k in range(15)}
    sizes["hot", "2022-04"] = sum(sizes.values()) // 2
    for key, n in sizes.items():
        groups[key] = [
            (rng.randrange(8), rng.choice([None, "1.10", "250.00", "33.33"])) for _ in range(n)
        ]
    groups["none", "2022-04"] = [(3, None)] * 5
    groups["flat", "2022-04"] = [(2, "9.99")] * 7
    groups["one", "2022-04"] = [(5, "8.00"), (5, None)]
    return dict(groups)


@pytest.mark.parametrize("seed", [1, 2])
def test_comparison_equals_brute_force(orders, seed):
    groups = random_groups(seed)
    frame = orders(groups)
    comparison = percentiles.compare_methods(
        percentiles.approx_summary(frame), percentiles.exact_summary(frame)
    )
    together = percentiles.both_summaries(frame)
    assert sorted(map(str, together.collect())) == sorted(map(str, comparison.collect()))
    sketched = percentiles.sketched_summary(frame).collect()
    assert sorted(map(str, sketched)) == sorted(map(str, percentiles.approx_summary(frame).collect()))
    rows = {(r["sku"], r["month"]): r for r in comparison.collect()}
    assert rows.keys() == groups.keys()
    for key, members in groups.items():
        row = rows[key]
        assert row["group_order_count"] == len(members)
        values = [count for count, _ in members]
        for name, fraction in percentiles.FRACTIONS.items():
            for method, find in (("approx", nearest), ("exact", exact)):
                threshold = find(values, fraction)
                assert row[f"{name}_{method}_threshold"] == threshold
                count, spread = tail(members, threshold)
                assert row[f"{name}_{method}_qualifying_count"] == count
                assert row[f"{name}_{method}_stddev"] == spread
            assert row[f"{name}_threshold_abs_diff"] == abs(
                row[f"{name}_exact_threshold"] - row[f"{name}_approx_threshold"]
            )
        assert row["p90_exact_threshold"] >= row["p80_exact_threshold"]
        assert row["p90_exact_qualifying_count"] <= row["p80_exact_qualifying_count"]


def test_four_values_show_the_difference_of_the_methods(orders):
    frame = orders({("a", "m"): [(k, "1") for k in (1, 2, 3, 4)]})
    assert percentiles.approx_thresholds(frame).first()["p90_approx_threshold"] == 4.0
    row = percentiles.exact_thresholds(frame).first()
    assert row["p90_exact_threshold"] == pytest.approx(3.7) and row["group_order_count"] == 4


def test_exact_thresholds_equal_the_built_in_percentile(orders):
    frame = orders(random_groups(3))
    frame.createOrReplaceTempView("orders_with_counts")
    built_in = frame.sparkSession.sql(
        "select sku, month, percentile(promotion_count, 0.9) p90, percentile(promotion_count, 0.8) p80"
        " from orders_with_counts group by sku, month"
    )
    expected = {(r["sku"], r["month"]): (r["p90"], r["p80"]) for r in built_in.collect()}
    for row in percentiles.exact_thresholds(frame).collect():
        got = (row["p90_exact_threshold"], row["p80_exact_threshold"])
        assert got == pytest.approx(expected[row["sku"], row["month"]], abs=1e-9)


def test_sketch_stays_within_its_rank_error_on_a_large_group(spark):
    n, accuracy = 60_000, 1_000
    frame = spark.sql(
        f"select id row_id, 'a' sku, 'm' month, cast(null as decimal(18,2)) amount,"
        f" cast(pmod(id * 7919, {n}) as int) promotion_count from range({n})"
    )
    row = percentiles.sketched_thresholds(frame, accuracy=accuracy).first()
    assert abs(row["p90_approx_threshold"] - 0.9 * n) <= n / accuracy
    assert abs(row["p80_approx_threshold"] - 0.8 * n) <= n / accuracy


def test_difference_report_counts_and_shares(orders):
    frame = orders({("a", "m"): [(k, str(k)) for k in (1, 2, 3, 4)], ("b", "m"): [(1, "1")] * 3})
    comparison = percentiles.compare_methods(
        percentiles.approx_summary(frame), percentiles.exact_summary(frame)
    )
    report = {r["measure"]: r for r in percentiles.difference_report(comparison).collect()}
    assert len(report) == 6
    assert report["p90_threshold_abs_diff"]["differing_groups"] == 1
    assert report["p90_threshold_abs_diff"]["share"] == 50.0
    empty = percentiles.difference_report(comparison.limit(0)).collect()
    assert {(r["differing_groups"], r["group_count"], r["share"]) for r in empty} == {(0, 0, 0.0)}
    assert percentiles.group_lookup(comparison, "b", "m").count() == 1


def test_other_fractions(orders):
    frame = orders({("a", "m"): [(k, "1") for k in range(101)]})
    row = percentiles.exact_summary(frame, {"half": 0.5}).first()
    assert (row["half_exact_threshold"], row["half_exact_qualifying_count"]) == (50.0, 51)


def test_group_profile(orders):
    frame = orders({("a", "m"): [(0, "1")] * 4, ("b", "m"): [(7, None)]})
    assert tuple(group_profile(frame, large=3).first()) == (5, 2, 4, 1, 0, 7)
    assert tuple(group_profile(frame.limit(0)).first()) == (0, 0, None, 0, None, None)
