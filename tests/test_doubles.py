"""Exact sums of doubles against fractions."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from test_promotions import LONG, order

from orderlens.functions import doubles as op
from orderlens.plans import IN_PLAN, qualified_by_city

DDL = "k string, x double"


def exact(values):
    """The exact sum, rounded once."""
    total = sum(map(Fraction, values), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def any_double(draw):
    while True:
        x = struct.unpack("<d", draw.randbytes(8))[0]
        if math.isfinite(x):
            return x


def groups():
    draw = random.Random(5)
    made = {f"any{k}": [any_double(draw) for _ in range(draw.randint(1, 40))] for k in range(60)}
    made |= {f"money{k}": [round(draw.uniform(-900, 900), 3) for _ in range(200)] for k in range(20)}
    for k in range(40):
        near = [math.ldexp(draw.choice([-1, 1]) * (1 + draw.choice([0, 2**-52, -(2**-53)])), draw.randint(-60, 60)) for _ in range(30)]
        made[f"near{k}"] = near
    made |= {
        "cancels": [1e300, 1.005, -1e300],
        "large": [1e17, 1.0, 1.0, 1.0],
        "half_even": [2.0**53, 1.0],
        "half_up": [2.0**53, 1.0, 2.0**-1074],
        "negative_half": [-(2.0**53), -1.0, -(2.0**-1074)],
        "least": [5e-324, 5e-324, -5e-324],
        "subnormal": [2.2250738585072014e-308, -5e-324],
        "greatest": [1.7976931348623157e308, 1e292],
        "beyond": [1.7976931348623157e308] * 3,
        "below": [-1.7976931348623157e308] * 3,
        "back": [1.7976931348623157e308] * 3 + [-1.7976931348623157e308] * 2,
        "zeros": [0.0, -0.0],
        "tenths": [0.1] * 10,
    }
    return made


def test_sums_are_the_exact_ones_in_any_order(spark):
    made = groups()
    rows = [(k, x) for k, xs in made.items() for x in xs]
    random.Random(1).shuffle(rows)
    for parts in (1, 7):
        found = op.exact_sums(spark.createDataFrame(rows, DDL).repartition(parts), ["k"], "x").collect()
        got = {r["k"]: (r["n"], r["total"]) for r in found}
        assert got == {k: (len(xs), exact(xs)) for k, xs in made.items()}


def test_nulls_and_non_finite_values(spark):
    inf, nan = math.inf, math.nan
    rows = [("a", None), ("b", None), ("b", 1.5), ("c", inf), ("c", 1.0), ("d", inf), ("d", -inf), ("e", nan), (None, 2.0), (None, None)]
    flag = {"priced": F.col("x") > 1}
    found = {r["k"]: r for r in op.exact_sums(spark.createDataFrame(rows, DDL), ["k"], "x", flag).collect()}
    assert (found["a"]["n"], found["a"]["total"]) == (0, None)
    assert (found["b"]["n"], found["b"]["total"], found["b"]["priced"]) == (1, 1.5, 1)
    assert found["c"]["total"] == inf and math.isnan(found["d"]["total"]) and math.isnan(found["e"]["total"])
    assert (found[None]["n"], found[None]["total"]) == (1, 2.0)
    assert op.exact_sums(spark.createDataFrame([], DDL), ["k"], "x").collect() == []


def test_keys_may_bear_the_names_of_parts_and_a_hot_key_is_summed_in_every_task(spark):
    rows = spark.range(0, 4000, 1, 4).select(F.lit("s").alias("slot"), F.lit(1).alias("sum"), F.lit(2).alias("entries"), (F.col("id") / 8).alias("x"))
    sums = op.exact_sums(rows, ["slot", "sum", "entries"], "x")
    assert [tuple(r) for r in sums.collect()] == [("s", 1, 2, 4000, sum(k / 8 for k in range(4000)))]
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(__piece" in plan and "Python" not in plan


@pytest.mark.parametrize("text, value", [("1.005", 1.005), ("1e17", 1e17), ("", None), ("x", None), ("NaN", None), ("Infinity", None)])
def test_text_amounts_keep_every_digit(column, text, value):
    assert column(op.finite_double, [text]) == [value]


@pytest.mark.parametrize("check", [True, False, IN_PLAN])
@pytest.mark.parametrize("others, own, qualified", [("1.0051", "1.005", 1), ("1.005", "1.005", 0), ("1e17", "1.005", 1), ("1e-9", "1e17", 0)])
def test_cities_by_amounts_of_any_size(raw, check, others, own, qualified):
    rows = [{**row, "Amount": others} for row in LONG] + [order(1, "A,B,C", amount=own)]
    found = qualified_by_city(raw(rows), check=check, scale=None).collect()
    assert [(r["cancelled_standard_count"], r["qualified_order_count"]) for r in found] == [(1, qualified)]


@pytest.mark.parametrize("scale", [None, 2])
def test_missing_amounts_and_repeated_ids_are_handled_alike(raw, scale):
    rows = LONG + [order(1, "A,B,C", amount=""), order(2, "A,B,C", amount="x", state=None)]
    found = qualified_by_city(raw(rows), check=IN_PLAN, scale=scale).collect()
    assert [(r["cancelled_standard_count"], r["qualified_order_count"]) for r in found] == [(2, 0)]
    with pytest.raises(Exception, match="row_id"):
        qualified_by_city(raw(rows + rows[:1]), check=IN_PLAN, scale=scale).collect()
