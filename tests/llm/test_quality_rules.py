from collections import Counter

import pytest
from pyspark.sql import functions as F
from texts import words

from orderlens.llm import quality_rules as op


def measures(text):
    own = words(text)
    windows = Counter(tuple(own[k : k + 3]) for k in range(len(own) - 2))
    covered = {k + d for k in range(len(own) - 2) if windows[tuple(own[k : k + 3])] > 1 for d in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "é# x$ |y\nx\nx\n \nx", "a a a a a", "w " * 5000,
         " ".join(f"w{k}" for k in range(20_000)), "  x y", "a b c d a b\nc d"]


def test_measures_equal_brute_force(docs):
    rows = op.measured(docs([*enumerate(TEXTS)])).collect()
    assert {r["doc_id"]: tuple(r[c] for c in op.MEASURES) for r in rows} == {i: measures(t) for i, t in enumerate(TEXTS)}


def test_sketches_merge_and_stay_within_a_64th(session):
    rows = session.range(5000).select(
        "id", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1000).alias("n_words"),
        F.col("id").alias("n_symbols"), F.lit(1).alias("n_lines"), F.lit(0).alias("n_dup_lines"),
        F.lit(0).alias("n_repeat_words"), F.lit(0).alias("word_chars"),
    )
    whole = op.sketch(rows)
    merged = op.merge(op.sketch(rows.where("id % 3 = 0")), op.sketch(rows.where("id % 3 > 0")))
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    row = op.quartiles(whole, ["lang", "source"]).where("signal = 'symbol_rate'").first()
    assert row["n"] == 5000
    for found, true in ((row["q25"], 1249), (row["q75"], 3749)):
        assert true * 63 / 64 <= found <= true


def test_thresholds_follow_the_group(docs):
    plain = [(k, " ".join(f"w{k}x{j}" for j in range(80))) for k in range(200)]
    noisy = [(k, " ".join(f"w{k}x{j}$" for j in range(80))) for k in range(200, 400)]
    frame = docs(plain, source="plain").union(docs(noisy, source="noisy")).union(docs([(900, plain[0][1] + " $" * 80)], source="plain"))
    kept = {r["doc_id"]: r["kept"] for r in op.verdicts(frame).collect()}
    assert all(kept[k] for k in range(400)) and not kept[900]


def test_edge_cases(docs):
    text = " ".join(f"w{j}" for j in range(60))
    frame = docs([(1, text), (1, text), (None, text), (2, None)], lang=None, source=None)
    found = sorted(((r["doc_id"], r["base_failed"], r["kept"]) for r in op.verdicts(frame).collect()), key=str)
    assert found == sorted([(1, False, True), (1, False, True), (None, False, True), (2, True, False)], key=str)
    rest = op.kept(frame)
    assert rest.columns == frame.columns and rest.count() == 3
    assert op.verdicts(docs([])).collect() == [] and op.kept(docs([])).collect() == []


@pytest.mark.parametrize("repeats, failed", [(25, False), (26, True)])
def test_the_base_rule_is_strict(docs, repeats, failed):
    # so many words in repeated windows of 50 and one words
    own = [f"w{k}" for k in range(100)]
    own[:repeats] = (["r"] * repeats)
    own = own[: max(50, 2 * repeats - failed)]
    row = op.verdicts(docs([(1, " ".join(own))])).first()
    assert row["base_failed"] == (100 * row["n_repeat_words"] > 50 * row["n_words"]) == failed
