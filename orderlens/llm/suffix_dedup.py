"""Removes bytes under a 50-byte string that an earlier document also holds, by a sparse suffix array.

A suffix of the text is sampled at every minimiser: the place whose next `lead` bytes hash lowest among all
places of a `length`-byte window. Equal windows have the same minimiser, so the windows fall into runs, one
for each sampled suffix, and equal windows stand in runs with the same leading bytes.

1. Every block asks which of its leading sequences stand in two documents or more.
2. Runs are told apart by their whole bytes. All windows of a run that an earlier document holds byte for
   byte are taken out; that settles long copies at one entry a run. A block also asks whether a leading
   sequence is followed or preceded by anything else elsewhere.
3. Where it is, the first copy of each run goes into the suffix array. Splitters, sampled from the leading
   bytes of suffixes of the corpus, cut the order of suffixes into ranges; a range sorts the 50-byte
   suffixes of its runs by their bytes, most significant chunk first and only among ties further, and
   compares neighbours. Suffixes with equal leading bytes are in one range, so no equal pair lies across a
   boundary. A leading sequence with more than `hot` different surroundings is dealt out by the
   bytes of each of its windows instead, so no range is unbounded.

Null text is empty. Documents without id stand last, however many they are; documents of one id do not take bytes from
each other. Repeated rows therefore stay as they are, and so do texts under 50 bytes. Texts are read whole: a block is one
text where that is longer. A worker holds some 20 times a block of many texts, more of one long text. Tables without rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import byte_codes, chunks, column_buffer, mix, prefix_sums, ranges, span_hashes
from .rounds import (
    ANSWERED,
    ASKED,
    blocks_of,
    first_pass,
    judged,
    named,
    next_pass,
    packed_rows,
    result_schema,
    split,
    with_carried,
)
from .substring_dedup import _LAST, KEY, _long, _pair, _short, later

LENGTH = 50
LEAD = 20
HOT = 20_000
BLOCK_BYTES = 8 << 20
#: Sampled leading sequences for each range of suffixes.
SAMPLES = 40
#: Ranges between splitters, so that many times SAMPLES samples reach the driver at most; a larger input cuts each range
#: into parts by a hash of the leading bytes, which keeps equal suffixes together as well.
MOST_RANGES = 16_384
#: Leading bytes that splitters compare.
TOKEN = 16
#: Bytes of whole texts worked on at a time; decides memory only.
CHUNK_BYTES = 1 << 18

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _least_of(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of values[i:i + size] for each i where all of it exists."""
    have, span = values, 1
    while span * 2 <= size:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = size - span
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


class _Runs:
    """Sampled suffixes of a block: runs of windows with one minimiser."""

    def __init__(self, table: pa.Table, length: int, lead: int):
        self.doc_ids = table["doc_id"].fill_null(_LAST).to_numpy()
        self.data, self.offsets = column_buffer(table["text"])
        found = [f for a, b in chunks(self.offsets, CHUNK_BYTES) if (f := self._chunk(a, b, length, lead)) is not None]
        #: Hash of the leading bytes, first window, number of windows, document, hash of all bytes of the run, where the lead is.
        kinds = (np.uint64, np.int64, np.int64, np.int64, np.uint64, np.int64)
        columns = [*zip(*found, strict=True)] or [()] * len(kinds)
        del found
        self.places, self.wholes, self.owners, self.sizes, self.starts, self.leads = (
            np.concatenate([np.zeros(0, kind), *columns.pop()]) for kind in reversed(kinds)
        )

    def _chunk(self, a: int, b: int, length: int, lead: int) -> tuple[np.ndarray, ...] | None:
        base = self.offsets[a]
        data = self.data[base : self.offsets[b]]
        ends = self.offsets[a + 1 : b + 1] - base
        if len(data) < length:
            return None
        sums = prefix_sums(byte_codes(data))
        at = np.arange(len(data) - lead + 1)
        hashes = span_hashes(sums, at, at + lead)
        least = _least_of(hashes, length - lead + 1)
        owner = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))[: len(least)]
        room = np.arange(len(least)) + length <= ends[owner]
        new = np.append(True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~room[:-1])
        firsts = np.flatnonzero(new & room)
        if not len(firsts):
            return None
        # a run goes on to the next run or to its document's last window
        lasts = np.minimum(np.append(firsts[1:], len(least)), ends[owner[firsts]] - length + 1)
        sizes = lasts - firsts
        leads = least[firsts]
        wholes = mix(span_hashes(sums, firsts, lasts + length - 1) + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        places = self._place(hashes, firsts, leads, length - lead + 1)
        # the least of many hashes is small: mixed, they spread evenly over ranges of keys
        return mix(leads), firsts + base, sizes, owner[firsts] + a, wholes, places + base

    @staticmethod
    def _place(hashes: np.ndarray, firsts: np.ndarray, leads: np.ndarray, room: int) -> np.ndarray:
        """Where in its first window each run's leading bytes stand."""
        at = np.full(len(firsts), -1, np.int64)
        for step in range(room):
            hit = (at < 0) & (hashes[firsts + step] == leads)
            at[hit] = firsts[hit] + step
        return at

    def ids(self) -> np.ndarray:
        return self.doc_ids[self.owners]

    def rows(self, starts: np.ndarray, width: int) -> np.ndarray:
        """The `width` bytes from each start, one row each."""
        return np.lib.stride_tricks.sliding_window_view(self.data, width)[starts]


def _classes(runs: _Runs, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
    """Among the chosen runs: distinct (lead, whole) pairs by key, check, first run, and the class of each run."""
    keys = mix(runs.leads[chosen] ^ mix(runs.wholes[chosen]))
    keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    first = chosen[first]
    return keys, (runs.wholes[first] >> np.uint64(32)), first, inverse


def splitters(docs: DataFrame, text: str, doc_id: str, ranges_wanted: int, length: int, lead: int, samples: int) -> np.ndarray:
    """Leading bytes that cut the order of suffixes into ranges of about equal size.

    Taken from at most `samples` suffixes for each range, of documents chosen by a hash of their id. They decide how even the
    ranges are, never what is found.
    """
    wanted = ranges_wanted * samples
    number = docs.count()
    keep = max(1, number * 20 // max(1, wanted))

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch]).rename_columns(["doc_id", "text"])
            runs = _Runs(table, length, lead)
            fits = np.flatnonzero(runs.places + TOKEN <= len(runs.data))[::17][: 20 * max(1, table.num_rows)]
            leads = runs.rows(runs.places[fits], TOKEN) if len(fits) else np.zeros((0, TOKEN), np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in leads], pa.binary())], names=["lead"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(
        F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(keep)) == 0
    )
    found = sorted(bytes(r["lead"]) for r in chosen.mapInArrow(run, "lead binary").limit(wanted).collect())
    if ranges_wanted < 2 or not found:
        return np.zeros(0, f"S{TOKEN}")
    picks = [found[len(found) * k // ranges_wanted] for k in range(1, ranges_wanted)]
    return np.unique(np.array(picks, f"S{TOKEN}"))


def _range_of(rows: np.ndarray, cuts: np.ndarray, finer: int) -> np.ndarray:
    """Range of each row of leading bytes: between two splitters, and one of `finer` parts by a hash of them."""
    lead = np.ascontiguousarray(rows[:, :TOKEN])
    coarse = np.searchsorted(cuts, lead.view(f"S{TOKEN}").reshape(-1), "right").astype(np.int64)
    if finer < 2:
        return coarse
    words = lead.view(np.uint64)
    mixed = mix(words[:, 0])
    for k in range(1, words.shape[1]):
        mixed = mix(mixed ^ words[:, k])
    return coarse * finer + (mixed % np.uint64(finer)).astype(np.int64)


def sorted_suffixes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of fixed-width suffixes, and whether each but the first in that order equals the one before.

    Sorts by the first eight bytes, then only the ties by the next eight, and so on.
    """

    def chunk(k: int, which: np.ndarray | slice) -> np.ndarray:
        own = rows[which, 8 * k : 8 * k + 8]
        wide = np.zeros((len(own), 8), np.uint8)
        wide[:, : own.shape[1]] = own
        return wide.view(">u8").reshape(-1).astype(np.uint64)

    values = chunk(0, slice(None))
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    for k in range(1, -(-rows.shape[1] // 8)):
        tied = np.zeros(len(order), bool)
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(np.append(True, ~same))[at]
        values = chunk(k, order[at])
        inner = np.lexsort((values, group))
        order[at] = order[at][inner]
        values = values[inner]
        # of neighbours that were equal so far, both are in `at`, one after the other
        equal = np.flatnonzero(same[at[:-1]])
        same[at[equal]] = values[equal + 1] == values[equal]
    return order, same


def _earlier(order: np.ndarray, same: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Whether an equal suffix has a smaller owner."""
    said = np.zeros(len(order), bool)
    if len(order):
        firsts = np.flatnonzero(np.append(True, ~same))
        least = np.minimum.reduceat(owners[order], firsts)
        said[order] = owners[order] > np.repeat(least, np.diff(np.append(firsts, len(order))))
    return said


def remove_repeated(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = LENGTH,
    lead: int = LEAD,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT,
    samples: int = SAMPLES,
    most_ranges: int = MOST_RANGES,
    with_kept: bool = False,
    with_text: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (runs of removed bytes) and kept_sha256, of the remaining bytes.

    If asked for, also kept, those bytes, and kept_text, the same as text without characters that a cut broke; `with_text` gives
    the second alone. `carry` names further columns of `docs` to keep; they replace result columns of their names.
    """
    if not TOKEN <= lead <= length:
        raise ValueError(f"the leading sequence needs {TOKEN} bytes or more and no more than the string")
    blocks, number, parts = blocks_of(docs, doc_id, text, block_bytes, carry, spread_null=True)
    cuts = splitters(docs, text, doc_id, min(number, most_ranges), length, lead, samples)
    finer = -(-number // most_ranges)

    def ask_leads(table: pa.Table, block: int) -> pa.Table:
        runs = _Runs(table, length, lead)
        keys, _, several = _by_lead(runs)
        return packed_rows(block, split(keys, number), _short(keys), several.astype(np.uint8))

    def judge_leads(keys: np.ndarray, notes: np.ndarray, _: np.ndarray) -> np.ndarray:
        _, inverse, counts = np.unique(_long(keys), return_inverse=True, return_counts=True)
        several = np.bincount(inverse, weights=notes) > 0
        return (counts > 1)[inverse] | several[inverse]

    def shared_runs(runs: _Runs, shared: np.ndarray) -> np.ndarray:
        _, inverse, _ = _by_lead(runs)
        return np.flatnonzero(shared[inverse] > 0)

    def ask_runs(table: pa.Table, block: int, shared: np.ndarray) -> pa.Table:
        """Distinct runs, noted by their first document; and distinct leads (in further buckets), by their kinds of runs."""
        runs = _Runs(table, length, lead)
        chosen = shared_runs(runs, shared)
        keys, checks, first, _ = _classes(runs, chosen)
        one = packed_rows(block, split(keys, number), _pair(keys, checks), runs.ids()[first])
        leads, kinds = np.unique(runs.leads[first], return_counts=True)
        only = np.zeros(len(leads), np.uint64)
        only[np.searchsorted(leads, runs.leads[first])] = runs.wholes[first]
        two = packed_rows(block, number + split(leads, number), _pair(leads, np.minimum(kinds, 2**31)), only.view(np.int64))
        return pa.concat_tables([one, two])

    def judge_runs(keys: np.ndarray, notes: np.ndarray, bucket: int) -> np.ndarray:
        if bucket < number:
            return later(keys, notes)
        _, inverse = np.unique(keys["key"], return_inverse=True)
        least, most = np.full(inverse.max() + 1, _LAST), np.full(inverse.max() + 1, -_LAST - 1)
        np.minimum.at(least, inverse, notes)
        np.maximum.at(most, inverse, notes)
        kinds = np.bincount(inverse, weights=keys["check"])
        several = (least != most) | (np.bincount(inverse, weights=keys["check"] > 1) > 0)
        return (several.astype(np.uint8) + (several & (kinds > hot)))[inverse]

    def opened(runs: _Runs, shared: np.ndarray, said: np.ndarray) -> tuple[np.ndarray, ...]:
        """Chosen runs, their classes, whether a class is elsewhere earlier, its first run, and 1 or 2 if it needs sorting."""
        chosen = shared_runs(runs, shared)
        keys, _, first, inverse = _classes(runs, chosen)
        leads = np.unique(runs.leads[first])
        elsewhere = said[: len(keys)] > 0
        sort = said[len(keys) :][np.searchsorted(leads, runs.leads[first])] if len(leads) else said[:0]
        return chosen, inverse, elsewhere, first, np.where(elsewhere, 0, sort)

    def asked_suffixes(runs: _Runs, first: np.ndarray, sort: np.ndarray) -> tuple[np.ndarray, ...]:
        """Classes sent as whole runs, by range; distinct windows of hot classes, by range; and their places."""
        whole = np.flatnonzero(sort == 1)
        lead_rows = runs.rows(runs.places[first[whole]], TOKEN) if len(whole) else np.zeros((0, TOKEN), np.uint8)
        spot = _range_of(lead_rows, cuts, finer)
        order = np.argsort(spot, kind="stable")
        whole, spot = whole[order], spot[order]
        single = np.flatnonzero(sort == 2)
        single = single[np.argsort(runs.owners[first[single]], kind="stable")]
        windows = ranges(runs.starts[first[single]], runs.sizes[first[single]])
        if len(windows):
            rows = runs.rows(windows, length)
            ordered, same = sorted_suffixes(rows)
            group = np.empty(len(rows), np.int64)
            group[ordered] = np.cumsum(np.append(True, ~same)) - 1
            at = np.full(int(group.max()) + 1, len(windows))
            np.minimum.at(at, group, np.arange(len(windows)))
            distinct = windows[at]
            window_spot = _range_of(rows[at], cuts, finer)
            if finer > 1:  # else sorted windows are in the order of their ranges
                by_range = np.argsort(window_spot, kind="stable")
                place = np.empty(len(by_range), np.int64)
                place[by_range] = np.arange(len(by_range))
                group, at, distinct, window_spot = place[group], at[by_range], distinct[by_range], window_spot[by_range]
        else:
            group = distinct = window_spot = at = np.zeros(0, np.int64)
        return whole, spot, single, windows, group, at, distinct, window_spot

    def ask_suffixes(table: pa.Table, block: int, shared: np.ndarray, said: np.ndarray) -> pa.Table:
        runs = _Runs(table, length, lead)
        _, _, _, first, sort = opened(runs, shared, said)
        whole, spot, _, _, _, _, distinct, window_spot = asked_suffixes(runs, first, sort)
        one = _suffix_rows(block, spot, runs, runs.starts[first[whole]], runs.sizes[first[whole]], runs.ids()[first[whole]], length)
        doc = runs.doc_ids[np.searchsorted(runs.offsets, distinct, "right") - 1]
        two = _suffix_rows(block, (len(cuts) + 1) * finer + window_spot, runs, distinct, np.ones(len(distinct), np.int64), doc, length)
        return pa.concat_tables([one, two])

    def judge_suffixes(table: pa.Table) -> pa.Table:
        sizes = [np.frombuffer(x, np.int32).astype(np.int64) for x in table["sizes"].to_pylist()]
        owners = np.repeat(np.concatenate([np.frombuffer(x, np.int64) for x in table["notes"].to_pylist()]), np.concatenate(sizes))
        data = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint8)
        every = np.concatenate(sizes)
        starts = np.cumsum(every + length - 1) - (every + length - 1)
        rows = np.lib.stride_tricks.sliding_window_view(data, length)[ranges(starts, every)]
        said = _earlier(*sorted_suffixes(rows), owners).astype(np.uint8)
        ends = np.cumsum([int(s.sum()) for s in sizes])
        cut = [said[e - int(s.sum()) : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "said": pa.array(cut, pa.binary())})

    def remove(table: pa.Table, block: int, shared: np.ndarray, said: np.ndarray, sorted_: np.ndarray) -> pa.Table:
        runs = _Runs(table, length, lead)
        chosen, inverse, elsewhere, first, sort = opened(runs, shared, said)
        whole, _, single, windows, group, at, _, _ = asked_suffixes(runs, first, sort)
        ids = runs.ids()
        gone = elsewhere[inverse] | (ids[chosen] > ids[first[inverse]])
        settled_runs = chosen[gone]
        # the answers about a class hold for all its runs in its first document
        open_runs = np.flatnonzero(~gone & (sort[inverse] > 0))
        total = int(runs.sizes[first[whole]].sum())
        verdict_at = np.full(len(first), -1, np.int64)
        verdict_at[whole] = np.cumsum(runs.sizes[first[whole]]) - runs.sizes[first[whole]]
        verdicts = sorted_[:total] > 0
        if len(single):
            owner = runs.doc_ids[np.searchsorted(runs.offsets, windows, "right") - 1]
            own = (sorted_[total:] > 0)[group] | (owner > owner[at][group])
            verdict_at[single] = total + np.cumsum(runs.sizes[first[single]]) - runs.sizes[first[single]]
            verdicts = np.concatenate([verdicts, own])
        rest = chosen[open_runs]
        hit = verdicts[ranges(verdict_at[inverse[open_runs]], runs.sizes[rest])]
        alone = ranges(runs.starts[rest], runs.sizes[rest])[hit]
        starts = np.concatenate([runs.starts[settled_runs], alone])
        sizes = np.concatenate([runs.sizes[settled_runs], np.ones(len(alone), np.int64)])
        return with_carried(_kept(table, runs, starts, sizes, length, with_kept, with_kept or with_text), table, carry)

    def judge_by_bucket(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        keys = [np.frombuffer(x, KEY) for x in table["keys"].to_pylist()]
        notes = [np.frombuffer(x, np.int64) for x in table["notes"].to_pylist()]
        sizes = list(map(len, keys))
        said = judge_runs(np.concatenate(keys), np.concatenate(notes), bucket).astype(np.uint8)
        ends = np.cumsum(sizes)
        cut = [said[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "said": pa.array(cut, pa.binary())})

    shared = judged(first_pass(blocks, ask_leads), np.dtype("V6"), np.dtype(np.uint8), judge_leads, parts)
    asked = next_pass(blocks, [shared], ask_runs, ASKED)
    settled = asked.repartition(parts, "bucket").groupBy("bucket").applyInArrow(judge_by_bucket, ANSWERED).repartition(parts, "block")
    suffixes = next_pass(blocks, [shared, settled], ask_suffixes, f"{ASKED}, sizes binary")
    compared = suffixes.repartition(parts, "bucket").groupBy("bucket").applyInArrow(judge_suffixes, ANSWERED).repartition(parts, "block")
    schema = result_schema(RESULT + ", kept binary" * with_kept + ", kept_text string" * (with_kept or with_text), docs, carry)
    return named(next_pass(blocks, [shared, settled, compared], remove, schema), carry)


def _by_lead(runs: _Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct leads in order, the lead of each run, and whether two documents of the block have it."""
    keys, first, inverse = np.unique(runs.leads, return_index=True, return_inverse=True)
    ids = runs.ids()
    several = np.bincount(inverse, weights=ids != ids[first][inverse], minlength=len(keys)) > 0
    return keys, inverse, several


def _suffix_rows(block, spot, runs: _Runs, starts, sizes, notes, length: int) -> pa.Table:
    """One row for each range: bytes of its runs, their numbers of windows, and their documents."""
    firsts = np.flatnonzero(np.append(True, spot[1:] != spot[:-1])) if len(spot) else np.zeros(0, np.int64)
    lasts = np.append(firsts[1:], len(spot))[: len(firsts)]
    cut = lambda a: [a[x:y].tobytes() for x, y in zip(firsts, lasts, strict=True)]
    raw = [runs.data[ranges(starts[x:y], sizes[x:y] + length - 1)].tobytes() for x, y in zip(firsts, lasts, strict=True)]
    return pa.table(
        {
            "bucket": pa.array(spot[firsts], pa.int64()),
            "block": pa.array(np.full(len(firsts), block, np.int64)),
            "keys": pa.array(raw, pa.binary()),
            "notes": pa.array(cut(notes), pa.binary()),
            "sizes": pa.array(cut(sizes.astype(np.int32)), pa.binary()),
        }
    )


def _kept(
    table: pa.Table, runs: _Runs, starts: np.ndarray, sizes: np.ndarray, length: int, with_kept: bool, with_text: bool
) -> pa.Table:
    """The result, where the windows of the runs at `starts` go; no window is in two of them."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], (starts + sizes + length - 1)[order]
    removed, spans, digests, kept, texts = [], [], [], [], []
    for first, last in chunks(runs.offsets, CHUNK_BYTES):
        base, end = int(runs.offsets[first]), int(runs.offsets[last])
        own_runs = slice(*np.searchsorted(starts, [base, end]).tolist())
        steps = np.zeros(end - base + 1, np.int32)  # neither a first nor a last window comes twice
        steps[starts[own_runs] - base] += 1
        steps[ends[own_runs] - base] -= 1
        gone, data = np.cumsum(steps[:-1], dtype=np.int32) > 0, runs.data[base:end]
        cuts = (runs.offsets[first : last + 1] - base).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = gone[a:b]
            removed.append(int(own.sum()))
            spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()) if removed[-1] else 0)
            left = (data[a:b][~own] if removed[-1] else data[a:b]).tobytes()
            digests.append(hashlib.sha256(left).hexdigest())
            if with_kept:
                kept.append(left)
            if with_text:
                texts.append(left.decode(errors="ignore"))
    result = pa.table(
        {
            "doc_id": table["doc_id"],
            "n_bytes": pa.array(np.diff(runs.offsets), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )
    if with_kept:
        result = result.append_column("kept", pa.array(kept, pa.binary()))
    if with_text:
        result = result.append_column("kept_text", pa.array(texts, pa.string()))
    return result


ORACLE_SQL = f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
windows AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY substr(digits, 2 * pos - 1, {2 * LENGTH})) < doc_id AS again
  FROM (SELECT doc_id, digits, unnest(range(1, len(digits) // 2 - {LENGTH - 2})) AS pos FROM docs)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + {LENGTH})) AS pos FROM windows WHERE again
), counts AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (before IS DISTINCT FROM pos - 1) AS spans
  FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone) GROUP BY doc_id
), places AS (
  SELECT doc_id, pos, substr(digits, 2 * pos - 1, 2) AS byte
  FROM (SELECT doc_id, digits, unnest(range(1, len(digits) // 2 + 1)) AS pos FROM docs)
), kept AS (
  SELECT doc_id, string_agg(byte, '' ORDER BY pos) AS digits FROM places ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, (len(d.digits) // 2)::BIGINT AS n_bytes, coalesce(c.n, 0)::BIGINT AS n_removed,
       coalesce(c.spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.digits, ''))) AS kept_sha256
FROM docs d LEFT JOIN counts c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
