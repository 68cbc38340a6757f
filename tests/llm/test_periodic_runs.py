import hashlib
import random
import zlib

import numpy as np
import pytest
from texts import words

from orderlens.llm import periodic_runs as op
from orderlens.llm.queries import op13_periodic_runs


def brute_force(own, least=12):
    """Every period, word by word; the least period of a stretch comes first."""
    found, known = [], set()
    for q in range(1, len(own) // 2 + 1):
        i = 0
        while i + q < len(own):
            start = i
            while i + q < len(own) and own[i] == own[i + q]:
                i += 1
            if i > start and i - start >= q and (start, i + q) not in known:
                known.add((start, i + q))
                if i + q - start >= least:
                    found.append((start, i + q - start, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(own, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def fibonacci(size):
    a, b = "a", "ab"
    while len(b) < size:
        a, b = b, b + a
    return list(b[:size])


def shapes(rng):
    """Words with many runs: few letters, powers, squares inside two regions of one period, nested copies."""
    yield [rng.choice("ab") for _ in range(rng.randrange(300))]
    yield fibonacci(rng.randrange(1, 400))
    yield [str(bin(i).count("1") % 2) for i in range(rng.randrange(300))]
    yield (["a", "b"] * rng.randrange(1, 60) + ["a"])[rng.randrange(3) :] + ["a", "b"] * rng.randrange(1, 60)
    unit = [rng.choice("ab") for _ in range(rng.randrange(1, 6))]
    yield [w for _ in range(4) for w in (unit * rng.randrange(1, 30))[rng.randrange(3) : -1]]
    unit = [str(rng.randrange(50)) for _ in range(rng.randrange(1, 150))]
    yield ["x"] + (unit * 5)[: rng.randrange(5 * len(unit) + 1)] + [rng.choice("xyz") for _ in range(20)]
    nested = ["a", "b"]
    while len(nested) < 300:
        nested = nested * rng.randrange(1, 4) + [rng.choice("abc")]
    yield nested[:500]


@pytest.mark.parametrize("least", [2, 12, 30])
def test_runs_of_several_texts_equal_brute_force(least):
    rng, total = random.Random(least), 0
    for _ in range(25):
        texts = list(shapes(rng))
        numbers: dict = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t], np.int64)
        firsts = np.cumsum([0, *map(len, texts)])
        found = list(zip(*(x.tolist() for x in op.runs_of(ids, firsts, least)), strict=True))
        expected = [(f + s, f + s + n, q) for t, f in zip(texts, firsts.tolist()[:-1], strict=True) for s, n, q in brute_force(t, least)]
        assert found == expected
        total += len(found)
    assert total > 1000


def test_long_overlap_free_words_and_long_periods():
    thue_morse = np.array([bin(i).count("1") % 2 for i in range(20_000)])
    assert {int(n) for n in op.runs_of(thue_morse, np.array([0, 20_000]))[2]} <= {3 << k for k in range(13)} | {1 << k for k in range(13)}
    block = np.random.default_rng(1).permutation(50_000)
    begin, end, period = op.runs_of(np.concatenate([[-1], block, block, block[:7], [-2]]), np.array([0, 100_009]))
    assert (begin.tolist(), end.tolist(), period.tolist()) == ([1], [100_008], [50_000])


def test_rows_and_edge_cases(docs):
    long_text = " ".join(["w", "v", "u"] * 40_000)
    rows = [(1, "  a b\ta b a\nb a b a b a b  end "), (1, None), (None, ""), (2, " \n "), (3, long_text), (4, "é ß " * 7), (4, "é ß " * 7), (5, "a b " * 5)]
    table = op.find_runs(docs(rows).withColumnRenamed("lang", "runs"))
    assert table.columns == ["doc_id", "text", "source", "n_chars", "n_tokens", "n_words", "runs", "collapsed"]
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in table.collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 13, [(0, 12, 2)], "a b end"), (1, 0, [], ""), (None, 0, [], ""), (2, 0, [], ""), (3, 120_000, [(0, 120_000, 3)], "w v u"),
         (4, 14, [(0, 14, 2)], "é ß"), (4, 14, [(0, 14, 2)], "é ß"), (5, 10, [], "a b " * 4 + "a b")], key=str)
    assert op.find_runs(docs([])).collect() == []
    assert len(op.find_runs(docs(rows[-1:]), min_length=10).first()["runs"]) == 1


def rewritten(doc_id, own):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not own:
        return own
    g, n = h // 10, len(own)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(docs, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(t)) for i, t in enumerate(x for _ in range(40) for x in shapes(rng))]
    rows += [(1000 + i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(200)))) for i in range(200)] + [(None, "a " * 20), (7000, None)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in op13_periodic_runs(docs([]).sparkSession, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    changed = 0
    for doc_id, text in rows:
        own = rewritten(doc_id, words(text))
        changed += own != words(text)
        runs = brute_force(own)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        r = found[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *best)
        assert r["runs_sha256"] == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == digest(collapsed(own, runs))
    assert changed > 20
