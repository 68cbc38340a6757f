import random

import duckdb
import pytest
from pyspark.sql import functions as F

from orderlens.llm import quality_rules as op


def text(k, junk):
    return " ".join(f"w{k}x{j}{'$$$' * junk}" for j in range(60))


def test_junk_in_one_source_does_not_widen_its_limits(docs):
    frame, junk = docs([]), set()
    for s, share in enumerate([0, 0, 40, 0, 0]):
        rows = [(1000 * s + k, text(k, k % 100 < share)) for k in range(100)]
        junk |= {i for i, t in rows if "$" in t}
        frame = frame.union(docs(rows, source=f"s{s}"))
    # symbols on every word of every document are the way of their source
    frame = frame.union(docs([(9000 + k, text(k, True)) for k in range(100)], source="code"))
    rejected = {r["doc_id"] for r in op.verdicts(frame).where("NOT kept").collect()}
    assert rejected == junk and len(junk) == 40


def test_a_lone_source_is_held_against_the_other_languages(docs):
    frame = docs([(k, text(k, k % 100 < 40)) for k in range(100)], lang="xx")
    for lang in ("en", "de", "fr"):
        frame = frame.union(docs([(None, text(k, False)) for k in range(100)], lang=lang))
    found = op.verdicts(frame).where("doc_id IS NOT NULL").select("doc_id", F.col("kept")).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == set(range(40))


def by_sql(frame):
    connection = duckdb.connect()
    connection.register("documents", frame.toArrow())
    result = connection.execute(op.ORACLE_SQL)
    names = [c[0] for c in result.description]
    return sorted(tuple(dict(zip(names, row, strict=True)).values()) for row in result.fetchall()), names


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_sql_has_the_bound(docs, seed):
    draw = random.Random(seed)
    frame, least = docs([]), op.LEAST
    # sources of every size about the least number of votes, with shares of junk that bind the bound or do not
    for s, size in enumerate([3, least - 1, least, least + 1, 120, 150, 200]):
        share, lang = draw.choice([0, 5, 40, 60]), draw.choice(["en", "de", None])
        length = draw.randint(1, 4)
        rows = [(1000 * s + k, text(k, draw.randint(1, 4) * (k % 100 < share)).replace("x", "x" * draw.randint(length, 2 * length))) for k in range(size)]
        frame = frame.union(docs(rows, lang=lang, source=f"s{s}"))
    expected, names = by_sql(frame)
    found = op.verdicts(frame).select(*names).collect()
    assert sorted(map(tuple, found)) == expected


def test_the_sql_agrees_where_the_bound_rejects(docs):
    frame = docs([])
    for s, share in enumerate([0, 0, 40, 0, 0]):
        frame = frame.union(docs([(1000 * s + k, text(k, k % 100 < share)) for k in range(100)], source=f"s{s}"))
    expected, names = by_sql(frame)
    kept = names.index("kept")
    assert sum(not row[kept] for row in expected) == 40
    assert sorted(map(tuple, op.verdicts(frame).select(*names).collect())) == expected
