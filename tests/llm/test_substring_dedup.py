import hashlib

import pytest
from texts import shared_passages, words

from orderlens.llm import substring_dedup as op


def brute_force(rows, window):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out[doc_id] = (len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("block_bytes", [400, 1 << 20])
def test_equals_brute_force(docs, block_bytes):
    rows = shared_passages(3, 70, "xyzuvw", ["ab", "cd", "ef", "gh"], (5, 60), [" ", "  ", "\n", "\t"])
    result = op.remove_repeated(docs(rows), block_bytes=block_bytes, with_text=True, carry=("lang", "n_tokens"))
    found = result.collect()
    expected = brute_force(rows, op.WINDOW)
    assert len(found) == len(rows) and sum(r["n_removed"] for r in found) > 100
    for r in found:
        assert (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) == expected[r["doc_id"]]
        assert (r["lang"], r["n_tokens"]) == ("en", "kept")


def test_edge_cases(docs):
    long_text = " ".join(f"w{k}" for k in range(30_000))
    twenty = " ".join("abcdefghijklmnopqrst")
    rows = [(5, long_text), (9, long_text), (1, twenty), (2, twenty + " z"), (3, twenty[:-2]), (4, ""), (None, twenty),
            (7, "a " * 60), (2, twenty + " z")]
    found = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in op.remove_repeated(docs(rows)).collect()]
    assert sorted(found, key=str) == sorted(
        [(5, 30_000, 0), (9, 30_000, 30_000), (1, 20, 0), (2, 21, 20), (2, 21, 21), (3, 19, 0), (4, 0, 0),
         (None, 20, 20), (7, 60, 59)], key=str)
    assert op.remove_repeated(docs([])).collect() == []


def test_other_covers_and_what_is_no_cover(docs):
    rows = shared_passages(4, 40, "xyz", ["ab", "cd"], (5, 40))
    found = op.remove_repeated(docs(rows), window=9, period=7, cover=(1, 2, 4)).collect()
    assert {r["doc_id"]: r["n_removed"] for r in found} == {i: x[1] for i, x in brute_force(rows, 9).items()}
    with pytest.raises(ValueError, match="cover"):
        op.remove_repeated(docs(rows), period=13, cover=(0, 1, 3))
