import random
from collections import defaultdict
from statistics import median

from orderlens.operators.variety import median_variety, style_variety
from orderlens.plans import median_by_month_state
from orderlens.sources import style_rows


def line(state="S", style="t1", sku="a", size="XXL", day="04-30-22"):
    return {"ship-state": state, "Style": style, "SKU": sku, "Size": size, "Date": day}


def varieties(raw, *rows):
    found = style_variety(style_rows(raw(list(rows)))).collect()
    return sorted((r["month"], r["state"], r["style"], r["variety"]) for r in found)


def test_one_large_row_qualifies_the_whole_style(raw):
    rows = [line(sku="a", size="S"), line(sku="A ", size="XXL"), line(sku="b", size="M")]
    assert varieties(raw, *rows) == [("2022-04", "S", "T1", 2)]


def test_small_free_and_unknown_sizes_do_not_qualify(raw):
    assert varieties(raw, line(size="XL"), line(size="FREE"), line(size="9XL")) == []


def test_styles_qualify_per_state_and_month(raw):
    rows = [line(state="A"), line(state="B", size="S"), line(state="A", day="05-01-22", size="S")]
    assert varieties(raw, *rows) == [("2022-04", "A", "T1", 1)]


def test_rows_without_keys_or_date_are_left_out(raw):
    rows = [line(state=""), line(style=" "), line(sku=None), line(day="00-00-22")]
    assert varieties(raw, *rows) == []


def test_impossible_days_mean_the_last_of_the_month(raw):
    assert varieties(raw, line(day="02-30-22")) == [("2022-02", "S", "T1", 1)]


def test_smallest_size_is_a_parameter(raw):
    rows = style_rows(raw([line(size="L")]), smallest="L")
    assert style_variety(rows).count() == 1


def test_median_of_odd_and_even_groups(spark):
    rows = [("m", "a", "x", v) for v in (1, 5, 9)] + [("m", "b", "x", v) for v in (1, 2, 4, 9)]
    frame = spark.createDataFrame(rows, "month string, state string, style string, variety bigint")
    got = sorted(map(tuple, median_variety(frame).collect()))
    assert got == [("m", "a", 5.0, 3), ("m", "b", 3.0, 4)]


def test_equals_brute_force_with_a_hot_style(raw):
    rng = random.Random(5)
    rows = [
        line(
            state=rng.choice(["a", "b"]),
            style="hot" if rng.random() < 0.34 else f"t{rng.randrange(6)}",
            sku=f"k{rng.randrange(40)}",
            size=rng.choice(["S", "M", "L", "XL", "XXL", "5XL", "FREE"]),
            day=rng.choice(["04-30-22", "05-02-22"]),
        )
        for _ in range(300)
    ]
    skus, large = defaultdict(set), set()
    for r in rows:
        key = ("2022-" + r["Date"][:2], r["ship-state"].upper(), r["Style"])
        skus[key].add(r["SKU"])
        if r["Size"] in ("XXL", "5XL"):
            large.add(key)
    groups = defaultdict(list)
    for key in large:
        groups[key[:2]].append(len(skus[key]))
    expected = sorted((*k, float(median(v)), len(v)) for k, v in groups.items())
    assert sorted(map(tuple, median_by_month_state(raw(rows)).collect())) == expected
