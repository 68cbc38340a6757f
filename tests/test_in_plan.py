"""Checks inside the plan, and what the plans read, shuffle and work out."""

import random
from datetime import date, timedelta

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens.functions import money
from orderlens.operators import promotions as promo
from orderlens.operators import quality, trailing
from orderlens.plans import IN_PLAN, best_sizes, promotion_spread, qualified_by_city
from orderlens.sources import window_rows

DAY = date(2022, 4, 1)
PLANS = (best_sizes, qualified_by_city, promotion_spread)


def line(index, **changes):
    return {
        "index": str(index), "promotion-ids": "A,B,C", "ship-city": "c", "ship-state": "s", "Size": "L", "SKU": "k", "Qty": "1",
        "Date": (DAY + timedelta(index % 9 if isinstance(index, int) else 0)).strftime("%m-%d-%y"), "Amount": "5.25",
        "Status": "Cancelled" if index == 3 else "Shipped", "ship-service-level": "Standard", "Fulfilment": "Merchant", "Courier Status": "Shipped", **changes,
    }


@pytest.fixture
def stored(spark, raw, tmp_path):
    def build(rows):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        raw(rows).write.parquet(path)
        return spark.read.parquet(path)

    return build


@pytest.fixture
def settings(spark):
    before = {}

    def put(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("_", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    return df._jdf.queryExecution().executedPlan()


def scans(df):
    return executed(df).toString().count("FileScan parquet")


def shuffled(df):
    """Bytes and rows written by the shuffles of a plan without adaptive execution, after running it."""
    df.collect()
    sums, nodes = [0, 0], [executed(df)]
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "Exchange":
            metrics = node.metrics()
            sums[0] += metrics.apply("dataSize").value()
            sums[1] += metrics.apply("shuffleRecordsWritten").value()
    return sums


@pytest.mark.parametrize("plan", PLANS)
def test_no_job_before_the_result_is_read_and_no_further_scan(spark, stored, settings, plan):
    orders = stored([line(k) for k in range(1, 30)])
    settings(adaptive_enabled="false")
    spark.sparkContext.setJobGroup("building", "building")
    checked = plan(orders, check=IN_PLAN)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("reading", "reading")
    plain = plan(orders, check=False)
    assert scans(checked) == scans(plain)
    assert sorted(map(str, checked.collect())) == sorted(map(str, plain.collect())) != []
    assert checked.schema.names == plain.schema.names


REFUSED = [
    (qualified_by_city, [line(1), line("x")], "1 null or non-numeric ids"),
    (qualified_by_city, [line(1), line(1), line(1), line(2)], "2 rows repeat an id"),
    (qualified_by_city, [line(1, Amount="1e17"), line(2)], "Amount '1e17' has more digits"),
    (promotion_spread, [line(1), line(-7), line(-7)], "1 rows repeat an id"),
    (promotion_spread, [line(1, Amount="1.005")], "Amount '1.005' has more than 2 decimals"),
    (best_sizes, [line(1, Amount="1.005")], "Amount '1.005' has more than 2 decimals"),
    (best_sizes, [line(1, Amount="1e17")], "Amount '1e17' has more digits"),
    (best_sizes, [line(1, Qty="0")], "window length table is empty"),
]


@pytest.mark.parametrize(("plan", "rows", "why"), REFUSED)
@pytest.mark.parametrize("how", ["collect", "count"])
def test_faults_fail_the_reader(raw, plan, rows, why, how):
    result = plan(raw(rows), check=IN_PLAN)
    if how == "count" and "Amount" in why:
        return  # a count does not need the amounts
    # Several stages that fail at once are told as one error of the JVM.
    with pytest.raises((PySparkException, Py4JJavaError), match=why):
        getattr(result, how)()
    assert plan(raw(rows), check=False).count() >= 0


def test_amounts_of_any_scale_are_kept_on_request(raw):
    rows = [line(1, Amount="1.005"), line(1, Amount="1.007")]
    for check in (True, IN_PLAN):
        found = best_sizes(raw(rows), check=check, scale=3).first()
        assert found["variance"] == pytest.approx(1e-6, rel=1e-14)
    with pytest.raises(ValueError, match="decimals"):
        best_sizes(raw(rows))
    assert raw(rows).select(money(F.col("Amount"), 3)).distinct().count() == 2


@pytest.mark.parametrize(("short", "long"), [(5, 10), (2, 40)])
def test_what_is_shuffled_for_a_window_does_not_grow_with_it(raw, short, long):
    rng = random.Random(long)
    rows = [line(k, **{"ship-state": rng.choice("ab"), "Size": rng.choice("SML"), "Date": (DAY + timedelta(rng.randrange(60))).strftime("%m-%d-%y")}) for k in range(700)]
    daily = trailing.daily_stats(window_rows(raw(rows)))
    for days in (short, long):
        grid = daily.withColumn("window_days", F.lit(days))
        steps, copies = trailing.window_steps(grid).count(), grid.agg(F.sum("window_days")).first()[0]
        assert steps == 2 * daily.count() and copies == days * daily.count()
        totals = {(r["state"], r["size"], r["window_date"]): r["frequency"] for r in trailing.trailing_totals(grid).collect()}
        expected = {}
        for r in daily.collect():
            for k in range(1, days + 1):
                key = (r["state"], r["size"], r["order_date"] + timedelta(k))
                expected[key] = expected.get(key, 0) + r["n"]
        assert totals == expected


def test_variances_are_worked_out_after_the_ranking_by_frequency(stored, settings):
    settings(adaptive_enabled="false", debug_maxToStringFields="500")
    plan = executed(best_sizes(stored([line(k) for k in range(9)]), check=False)).toString()
    first, last = plan.index("__variance_mids"), plan.rindex("__variance_total")
    assert first < last < plan.index("rank(frequency")
    between = plan[: plan.index("rank(frequency")]
    assert "Exchange" not in between and "transform(" not in between and "lambda" not in between


def test_close_ids_are_shuffled_as_words(spark, settings):
    settings(adaptive_enabled="false")
    dense, sparse = (spark.range(0, 200_000, 1, 4).select((F.lit(7) - F.col("id") * k).alias("row_id")) for k in (1, 997))
    for ids, most in ((dense, 0.04), (sparse, 1.6)):
        by_id = shuffled(ids.groupBy("row_id").count().agg(F.count_if(F.col("count") > 1)))
        by_word = shuffled(quality.id_faults(quality.id_words(ids)))
        assert by_word[0] <= most * by_id[0] and by_word[1] <= by_id[1]
        assert tuple(quality.id_faults(quality.id_words(ids)).first()) == (0, 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_id_faults_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edge = [0, 63, 64, -1, -64, -65, 2**63 - 1, -(2**63)]
    ids = [rng.choice([None, rng.randrange(-200, 200), rng.choice(edge), rng.randrange(10**15)]) for _ in range(300)]
    frame = spark.createDataFrame([(i,) for i in ids], "row_id bigint")
    known = [i for i in ids if i is not None]
    assert tuple(quality.id_faults(quality.id_words(frame)).first()) == (ids.count(None), len(known) - len(set(known)))
    assert tuple(quality.id_report(frame).first()) == (ids.count(None), sum(known.count(i) > 1 for i in set(known)))


def test_a_code_gets_salts_by_its_share_of_the_uses(spark):
    uses = [("HOT", 5_000), ("WARM", 2_990), *[(f"c{k}", 1) for k in range(2_010)]]
    codes = spark.createDataFrame(uses, "promo string, uses bigint")
    found = {r["promo"]: r["salts"] for r in promo.with_salts(codes).collect()}
    assert (found["HOT"], found["WARM"], found["c0"]) == (500, 299, 1) and len(found) == len(uses)
    rows = spark.range(5_000).select(F.lit("HOT").alias("promo"), F.col("id").alias("row_id"))
    dealt = promo.with_salt(rows, promo.with_salts(codes)).groupBy("salt").count().collect()
    assert len(dealt) > 490 and max(r["count"] for r in dealt) < 40
    assert promo.salted(promo.with_salts(codes)).count() == 500 + 299 + 2_010
