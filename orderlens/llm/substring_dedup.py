"""Removes words that stand in a repeated window of words, found through difference-cover anchors.

A set of offsets modulo a period is a difference cover if every difference modulo the period occurs between
two of them. Two equal windows, wherever they start, then have a common offset below the period at which
both stand at a cover position. So only sequences of `window - period + 1` words at cover positions are
hashed and compared first:

1. Every block asks which of its distinct anchors occur twice or more anywhere.
2. Shared anchors extend to all windows that hold them. Each block asks about its distinct such windows,
   with the least document id that has them in the block; a window is answered if another block has it in
   an earlier document.
3. Words under a window that has an earlier start are taken out. Windows are judged on the input.

Words are `[^\\x20\\x09-\\x0D]+`, compared as they are. Windows are compared by 96 bits of hash between
blocks and 64 bits within one.

Null text: no words. Documents without id stand last. Rows of one id are one document each, in the order
of their texts. Ties in id and text are rows of equal content; the first of them keeps its words. Texts are read whole, a longer one than a
block as a block of its own. Tables without rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .buffers import chunks, column_buffer, mix, prefix_sums, ranges, span_hashes, text_hashes, word_spans
from .rounds import ASKED, blocks_of, first_pass, judged, named, next_pass, packed_rows, result_schema, split, with_carried

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
BLOCK_BYTES = 8 << 20

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_LAST = np.iinfo(np.int64).max


def is_cover(cover: tuple[int, ...], period: int) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


class _Words:
    """Words of a block's documents and their hashes."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.doc_ids = table["doc_id"].fill_null(_LAST).to_numpy()
        self.data, self.offsets = column_buffer(table["text"])
        starts, ends, hashes, firsts = [], [], [], [np.zeros(1, np.int64)]
        total = 0
        for a, b in chunks(self.offsets):
            base = self.offsets[a]
            part = self.data[base : self.offsets[b]]
            s, e, f = word_spans(part, self.offsets[a : b + 1] - base)
            hashes.append(text_hashes(part, s, e))
            starts.append(s + base)
            ends.append(e + base)
            firsts.append(f[1:] + total)
            total += len(s)
        none = [np.zeros(0, np.int64)]
        self.starts = np.concatenate(starts or none)
        self.ends = np.concatenate(ends or none)
        self.firsts = np.concatenate(firsts)
        hashes = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        self.sums = prefix_sums(hashes)
        self.check_sums = prefix_sums(mix(hashes), 1)

    def room(self, size: int) -> np.ndarray:
        """Whether a sequence of so many words starts at each word."""
        counts = np.diff(self.firsts)
        place = np.arange(self.firsts[-1]) - np.repeat(self.firsts[:-1], counts)
        return place + size <= np.repeat(counts, counts)

    def anchors(self, window: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions and the hashes of the sequences there."""
        size = window - period + 1
        counts = np.diff(self.firsts)
        place = np.arange(self.firsts[-1]) - np.repeat(self.firsts[:-1], counts)
        chosen = np.zeros(period, bool)
        chosen[list(cover)] = True
        at = np.flatnonzero(chosen[place % period] & (place + size <= np.repeat(counts, counts)))
        return at, span_hashes(self.sums, at, at + size)

    def covered(self, starts: np.ndarray, lengths: int, size: int) -> np.ndarray:
        """Marks [start, start + length) for each start, within `size` positions."""
        steps = np.bincount(np.clip(starts, 0, size), minlength=size + 1)[: size + 1].astype(np.int64)
        steps -= np.bincount(np.clip(starts + lengths, 0, size), minlength=size + 1)[: size + 1]
        return np.cumsum(steps)[:size] > 0


def remove_repeated(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    period: int = PERIOD,
    cover: tuple[int, ...] = COVER,
    block_bytes: int = BLOCK_BYTES,
    with_text: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256, of the kept words joined by one space; those as kept_text if asked for.

    `carry` names further columns of `docs` to keep; they replace result columns of their names.
    """
    if not is_cover(cover, period) or period > window:
        raise ValueError("the offsets must cover all differences modulo a period no longer than the window")
    blocks, number, parts = blocks_of(docs, doc_id, text, block_bytes, carry)
    size = window - period + 1

    def ask_anchors(table: pa.Table, block: int) -> pa.Table:
        _, hashes = _Words(table).anchors(window, period, cover)
        keys, counts = np.unique(hashes, return_counts=True)
        return packed_rows(block, split(keys, number), _short(keys), (counts > 1).astype(np.uint8))

    def judge_anchors(keys: np.ndarray, notes: np.ndarray, _: np.ndarray) -> np.ndarray:
        _, inverse, counts = np.unique(_long(keys), return_inverse=True, return_counts=True)
        return (counts[inverse] > 1) | (notes > 0)

    def windows(words: _Words, shared: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts of the windows that hold a shared anchor, their distinct keys, first places, and places among the keys."""
        at, hashes = words.anchors(window, period, cover)
        _, inverse = np.unique(hashes, return_inverse=True)
        hit = at[shared[inverse] > 0]
        doc_first = words.firsts[np.searchsorted(words.firsts, hit, "right") - 1]
        low = np.maximum(hit + size - window, doc_first)
        total = int(words.firsts[-1])
        steps = np.bincount(low, minlength=total + 1) - np.bincount(hit + 1, minlength=total + 1)
        near = np.flatnonzero((np.cumsum(steps)[:total] > 0) & words.room(window))
        hashes = span_hashes(words.sums, near, near + window)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        return near, keys, first, inverse

    def ask_windows(table: pa.Table, block: int, shared: np.ndarray) -> pa.Table:
        words = _Words(table)
        near, keys, first, _ = windows(words, shared)
        at = near[first]
        checks = span_hashes(words.check_sums, at, at + window, 1)
        owner = words.doc_ids[np.searchsorted(words.firsts, at, "right") - 1]
        return packed_rows(block, split(keys, number), _pair(keys, checks), owner)

    def judge_windows(keys: np.ndarray, notes: np.ndarray, _: np.ndarray) -> np.ndarray:
        return later(keys, notes)

    def remove(table: pa.Table, block: int, shared: np.ndarray, earlier: np.ndarray) -> pa.Table:
        words = _Words(table)
        near, _, first, inverse = windows(words, shared)
        again = (earlier[inverse] > 0) | (np.arange(len(near)) != first[inverse])
        gone = words.covered(near[again], window, int(words.firsts[-1]))
        return with_carried(_kept(table, words, gone, with_text), table, carry)

    anchors = first_pass(blocks, ask_anchors)
    shared = judged(anchors, np.dtype("V6"), np.dtype(np.uint8), judge_anchors, parts)
    asked = next_pass(blocks, [shared], ask_windows, ASKED)
    earlier = judged(asked, KEY, np.dtype(np.int64), judge_windows, parts)
    schema = result_schema(RESULT + ", kept_text string" * with_text, docs, carry)
    return named(next_pass(blocks, [shared, earlier], remove, schema), carry)


KEY = np.dtype([("key", "<u8"), ("check", "<u4")])


def _short(keys: np.ndarray) -> np.ndarray:
    """The lower six bytes; the bucket has the leading bits."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).view("V6").reshape(-1)


def _long(keys: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(keys), 8), np.uint8)
    wide[:, :6] = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 6)
    return wide.view("<u8").reshape(-1)


def _pair(keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
    out = np.empty(len(keys), KEY)
    out["key"], out["check"] = keys, checks.astype(np.uint32)
    return out


def later(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Whether another entry of the same key has a smaller owner."""
    order = np.lexsort((owners, keys["check"], keys["key"]))
    key, check = keys["key"][order], keys["check"][order]
    new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))[: len(order)]
    least = owners[order][new][np.cumsum(new) - 1]
    said = np.zeros(len(order), bool)
    said[order] = owners[order] > least
    return said


def _kept(table: pa.Table, words: _Words, gone: np.ndarray, with_text: bool) -> pa.Table:
    counts = np.diff(words.firsts)
    gone_before = np.append(0, np.cumsum(gone))
    removed = gone_before[words.firsts[1:]] - gone_before[words.firsts[:-1]]
    kept = np.flatnonzero(~gone)
    lengths = (words.ends - words.starts)[kept]
    ends = np.cumsum(lengths + 1)
    firsts = np.append(0, ends)[words.firsts - gone_before[words.firsts]]
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    step = 1 << 18
    for k in range(0, len(kept), step):
        own = slice(k, k + step)
        out[ranges(ends[own] - lengths[own] - 1, lengths[own])] = words.data[ranges(words.starts[kept[own]], lengths[own])]
    raw = out.tobytes()
    texts = [raw[a : max(a, b - 1)] for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
    result = pa.table(
        {
            "doc_id": table["doc_id"],
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        }
    )
    return result.append_column("kept_text", pa.array([t.decode() for t in texts], pa.string())) if with_text else result


ORACLE_SQL = f"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), windows AS (
  SELECT doc_id, pos, row_number() OVER (
    PARTITION BY array_to_string(words[pos:pos + {WINDOW - 1}], ' ') ORDER BY doc_id, pos) AS nth
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS pos FROM docs)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + {WINDOW})) AS pos FROM windows WHERE nth > 1
), counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
places AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words FROM places ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.words, '')) AS kept_sha256
FROM docs d LEFT JOIN counts c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
