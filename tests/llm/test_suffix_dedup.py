import hashlib
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from texts import shared_passages

from orderlens.llm import suffix_dedup as op
from orderlens.llm.rounds import split


def brute_force(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first, out = {}, {}
    for i, b in texts:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(first.get(w, i), i)
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("block_bytes, hot", [(1000, 20_000), (1000, 3), (1 << 20, 0)])
def test_equals_brute_force(docs, block_bytes, hot):
    rows = shared_passages(5, 90, "xyz \0é", [*"ab cdé\n"], (30, 200), [""])
    result = op.remove_repeated(docs(rows), block_bytes=block_bytes, hot=hot, with_kept=True, carry=("source",))
    expected, found = brute_force(rows, op.LENGTH), result.collect()
    assert len(found) == len(rows) and sum(r["n_removed"] for r in found) > 1000
    for r in found:
        got = (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"]))
        assert got == expected[r["doc_id"]]
        assert r["kept_text"] == got[-1].decode(errors="ignore") and r["source"] == "s"


@pytest.mark.parametrize("most_ranges", [1, 3])
def test_ranges_cut_finer_than_the_splitters_find_the_same(docs, most_ranges):
    rows = shared_passages(6, 90, "xyz \0é", [*"ab cdé\n"], (30, 200), [""])
    expected = brute_force(rows, op.LENGTH)
    for hot in (20_000, 0):
        found = op.remove_repeated(docs(rows), block_bytes=700, hot=hot, most_ranges=most_ranges).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in found} == {k: v[:4] for k, v in expected.items()}


def test_a_third_of_all_rows_without_id(docs):
    rows = [(k if k % 3 else None, t) for k, t in shared_passages(7, 90, "xyz", [*"abcdef"], (30, 200), [""])]
    known = [(i, t) for i, t in rows if i is not None]
    found = op.remove_repeated(docs(rows), block_bytes=1000).collect()
    expected = brute_force([(i if i is not None else 10**6 + k, t) for k, (i, t) in enumerate(rows)], op.LENGTH)
    assert {r["doc_id"]: tuple(r)[1:] for r in found if r["doc_id"] is not None} == {i: expected[i][:4] for i, _ in known}
    strings = {t[k : k + op.LENGTH] for _, t in known if t for k in range(len(t))}
    for r, text in zip(*(sorted(x, key=lambda y: str(y[1])) for x in ([(r, r["kept_sha256"]) for r in found if r["doc_id"] is None], [(t or "", hashlib.sha256(cut(t or "", strings)).hexdigest()) for i, t in rows if i is None])), strict=True):
        assert r[1] == text[1]


def cut(text, strings):
    """ASCII text without what lies under one of the 50-byte strings."""
    gone = set()
    for k in range(len(text) - op.LENGTH + 1):
        if text[k : k + op.LENGTH] in strings:
            gone.update(range(k, k + op.LENGTH))
    return "".join(c for k, c in enumerate(text) if k not in gone).encode()


def test_edge_cases(docs):
    fifty = "".join(chr(48 + k) for k in range(50))
    long_text = "".join(f"{k} " for k in range(40_000))
    rows = [(1, fifty), (2, f"x{fifty}y"), (3, fifty[1:]), (4, ""), (5, None), (None, fifty), (6, long_text),
            (7, long_text), (8, "a" * 400), (9, "a" * 60), (2, f"x{fifty}y"), (10, "repeated" * 50)]
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in op.remove_repeated(docs(rows)).collect())
    size = len(long_text)
    assert found == sorted([("1", 50, 0, 0), ("2", 52, 50, 1), ("2", 52, 50, 1), ("3", 49, 0, 0), ("4", 0, 0, 0), ("5", 0, 0, 0),
                            ("None", 50, 50, 1), ("6", size, 0, 0), ("7", size, size, 1), ("8", 400, 0, 0), ("9", 60, 60, 1), ("10", 400, 0, 0)])
    assert op.remove_repeated(docs([])).collect() == []
    assert sum(r["n_removed"] for r in op.remove_repeated(docs([(1, "short"), (2, "short")])).collect()) == 0


def test_suffixes_are_sorted_by_their_bytes():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (3000, 50)).astype(np.uint8)
    rows[:, 20:] = 120
    rows[::7] = rows[0]
    order, same = op.sorted_suffixes(rows)
    raw = [rows[i].tobytes() for i in order]
    assert raw == sorted(raw) and same.tolist() == [a == b for a, b in zip(raw, raw[1:], strict=False)]


def block(texts):
    return pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def random_text(seed, size):
    return np.random.default_rng(seed).integers(97, 123, size).astype(np.uint8).tobytes().decode()


def test_leading_sequences_spread_evenly_over_ranges_of_keys():
    leads = op._by_lead(op._Runs(block([random_text(1, 400_000)]), op.LENGTH, op.LEAD))[0]
    counts = np.bincount(split(leads, 64), minlength=64)
    assert len(leads) > 20_000 and counts.max() < 1.5 * counts.mean()


def test_a_piece_without_windows_leaves_the_hashes_of_others_as_they_are():
    text = random_text(2, 1 << 20)
    alone, beside = (op._Runs(block(texts), op.LENGTH, op.LEAD) for texts in ([text], [text, "short"]))
    assert beside.leads.dtype == np.uint64
    assert beside.leads.tolist() == alone.leads.tolist() and beside.wholes.tolist() == alone.wholes.tolist()


def test_memory_of_a_block_is_a_small_multiple_of_its_text():
    table = block([random_text(k, 2000) for k in range(1000)] * 2)
    tracemalloc.start()
    runs = op._Runs(table, op.LENGTH, op.LEAD)
    half = len(runs.starts) // 2
    result = op._kept(table, runs, runs.starts[half:], runs.sizes[half:], op.LENGTH, False, True)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert result["n_removed"].to_pylist() == [0] * 1000 + [2000] * 1000
    assert most < 12 * 4_000_000


def test_text_alone_is_the_same_as_with_the_bytes(docs):
    rows = shared_passages(8, 60, "xyz é", [*"ab cdé"], (30, 200), [""])
    both, alone = (op.remove_repeated(docs(rows), block_bytes=1000, **{k: True}) for k in ("with_kept", "with_text"))
    assert alone.columns == [c for c in both.columns if c != "kept"]
    assert sorted(map(str, alone.collect())) == sorted(map(str, both.drop("kept").collect()))
