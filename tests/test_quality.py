import pytest

from orderlens.operators import quality, trailing
from orderlens.sources import HEADER_PREFIX, classify_lines, parse_lines, style_rows, window_rows


def test_id_report_and_errors(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,), (3,), (3,)], "row_id bigint")
    assert tuple(quality.id_report(ids).first()) == (2, 2)
    with pytest.raises(ValueError, match="2 null or non-numeric"):
        quality.require_unique(ids)
    with pytest.raises(ValueError, match="2 ids occur more than once"):
        quality.require_unique(ids, allow_null=True)
    clean = ids.filter("row_id = 2")
    assert quality.require_unique(clean) is clean
    assert tuple(quality.id_report(ids.limit(0)).first()) == (0, 0)


def text(state="s", size="XXL", day="04-30-22", status="Shipped", qty="1", amount="1", style="t", sku="k"):
    fields = [""] * 24
    fields[2], fields[3], fields[7], fields[8], fields[10] = day, status, style, sku, size
    fields[13], fields[15], fields[17] = qty, amount, state
    return ",".join(fields)


LINES = [
    HEADER_PREFIX + "Status",
    text(),
    text(amount=""),
    text(state=""),
    text(qty="x"),
    text(qty="0"),
    text(status="Pending"),
    text(size=" "),
    text(day="x"),
    text(state="other"),
    text(style=""),
    "1,2",
    "",
    '"open',
]


def reasons(frame):
    return {r["reason"]: r["n"] for r in frame.collect()}


@pytest.fixture
def checked(spark):
    return parse_lines(classify_lines(spark.createDataFrame([(x,) for x in LINES], "value string")))


def test_count_ledger_covers_every_line(checked):
    found = reasons(quality.ledger(window_rows(checked, ("fault",)), quality.count_reason()))
    assert found == {
        "header": 1, "wrong_column_count": 1, "bad_csv": 2, "missing_state": 1, "invalid_qty": 1,
        "not_bought": 2, "bought": 6,
    }
    assert sum(found.values()) == len(LINES)


def test_window_ledger_with_a_state_missing_from_the_lookup(spark, checked):
    rows = window_rows(checked, ("fault",))
    fates = quality.window_fates(rows)
    counts = trailing.bought_counts(rows)
    assert sorted(quality.bought_fates(fates).collect()) == sorted(counts.collect())
    lengths = trailing.window_lengths(counts).filter("state = 'S'")
    ledger = quality.window_ledger(fates, lengths)
    assert reasons(ledger) == {
        "header": 1, "wrong_column_count": 1, "bad_csv": 2, "missing_state": 1, "not_bought": 3,
        "missing_size": 1, "invalid_date": 1, "state_not_in_lookup": 1, "source": 3,
    }
    source = ledger.filter("reason = 'source'").first()
    assert (source["emitted_rows"], source["rows_without_amount"]) == (30, 1)
    daily = trailing.daily_stats(rows)
    stats = trailing.trailing_stats(trailing.with_lengths(daily, lengths))
    assert stats.agg({"frequency": "sum"}).first()[0] == source["emitted_rows"]


def test_variety_ledger(checked):
    found = reasons(quality.variety_ledger(style_rows(checked, keep=("fault",))))
    assert found == {
        "header": 1, "wrong_column_count": 1, "bad_csv": 2, "missing_key": 2, "invalid_date": 1,
        "valid": 7, "qualified_styles": 2,
    }
    assert sum(found.values()) - found["qualified_styles"] == len(LINES)
