"""Runs of repeating words, by string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least 2 q words long,
that no neighbouring word extends with period q.

Blocks of 2^k words are named by hashes made from two hashes of 2^(k-1) words. At each scale t = 2^k the synchronising
set holds the places i whose least block name among i..i+t stands at i or at i+t; blocks of a period of t/3 or less
have no name. Whether a place belongs to it depends on the 2 t words from there alone, so a run of period q chooses
the same places again q words later, and two places with the same 2 t words propose their distance. A scale answers
for periods from 3 t up to 6 t, for which the distance is that of two of 18 neighbours at most: places of the set with
equal words are more than t/3 apart.

What the sets leave out comes from two other sources:

* periods below 12, compared word by word;
* squares inside two highly periodic regions of one period that touch or overlap, where no place of the set has both
  of its copies inside the run. Such regions are runs found at smaller scales; the phases of the two regions fix the
  distance up to multiples of their period.

Every proposal is extended both ways over the block names, so it is judged by the words themselves.

A null text has no words and no runs. Equal texts have equal results, row by row; rows are never compared, so null,
repeated or missing ids do not matter. An empty table gives an empty result. Texts are read whole, one at a time
beyond 1 MB: a worker holds about 40 times the size of its longest text. Other columns stay; one that is named like a
result is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import with_text_results
from .buffers import IS_BLANK, mix, ranges, word_spans

MIN_LENGTH = 12
#: The first scale, and the period below which words are compared one by one: three times the scale.
FIRST_SCALE = 2
SMALL = 3 << FIRST_SCALE

RESULTS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_NAMELESS = np.uint64(2**64 - 1)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """The rows with n_words, runs (by start, then period) and collapsed.

    Runs have at least max(min_length, 2 * period) words. `collapsed` holds the words that are in no run after its first
    period, joined by one space.
    """

    def make(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        starts, ends, firsts = word_spans(data, offsets)
        begin, end, period = runs_of(word_ids(data, starts, ends), firsts, min_length)
        owner = np.searchsorted(firsts, begin, "right") - 1
        cuts = np.searchsorted(owner, np.arange(len(offsets))).astype(np.int32)
        found = pa.StructArray.from_arrays([pa.array(begin - firsts[owner]), pa.array(end - begin), pa.array(period)], ["start", "length", "period"])
        dropped = covered(begin + period, end, len(starts))
        return [pa.array(np.diff(firsts)), pa.ListArray.from_arrays(pa.array(cuts), found), joined_words(data, starts, ends, firsts, ~dropped)]

    return with_text_results(docs, text, RESULTS, make)


def word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words and only for those."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~IS_BLANK[data]])])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, keep: np.ndarray) -> pa.Array:
    """For each text its kept words, joined by one space."""
    before = np.append(0, np.cumsum(keep))[firsts]
    followed = np.ones(before[-1], bool)
    followed[before[1:][before[1:] > before[:-1]] - 1] = False
    sizes = (ends - starts)[keep] + followed
    out = data[ranges(starts[keep], sizes)]
    at = np.append(0, np.cumsum(sizes))
    out[at[1:][followed] - 1] = 0x20
    offsets = pa.py_buffer(at[before].astype(np.int32))
    return pa.Array.from_buffers(pa.string(), len(firsts) - 1, [None, offsets, pa.py_buffer(out)])


def covered(begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which of the places 0 to size - 1 lie in a stretch."""
    steps = np.bincount(begin, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def runs_of(ids: np.ndarray, firsts: np.ndarray, min_length: int = MIN_LENGTH) -> Runs:
    """Starts, ends and periods of the runs of several texts; firsts[k] is the first word of text k, in `ids`."""
    texts = len(firsts) - 1
    longest = int(np.diff(firsts).max(initial=0))
    apart = np.insert(ids, firsts[1:], ids.max(initial=0) + 1 + np.arange(texts))
    names = block_names(apart, longest)
    known = [_small_periods(apart, min_length)]
    for k in range(FIRST_SCALE, len(names)):
        if 6 << k > longest:
            break
        runs = tuple(np.concatenate(x) for x in zip(*known, strict=True))
        at, gap = _proposals(names, k, runs)
        more = _paired_regions(apart, runs, 1 << k)
        known.append(_extended(names, np.append(at, more[0]), np.append(gap, more[1])))
    begin, end, period = (np.concatenate(x) for x in zip(*known, strict=True))
    # A proposal may be a multiple of the period; then the run itself is known, with the same ends.
    begin, end, period = _least_periods(begin, end, period)
    long = end - begin >= np.maximum(min_length, 2 * period)
    begin, end, period = begin[long], end[long], period[long]
    order = np.lexsort((period, begin))
    gone = np.searchsorted(firsts[1:] + np.arange(texts), begin, "left")  # one place more stands after each text
    return (begin - gone)[order], (end - gone)[order], period[order]


def block_names(ids: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[k][i]: a hash of the 2^k ids from i on, for blocks up to the longest text."""
    names = [mix((ids + 1).astype(np.uint64) * _LEFT)]
    while 1 << len(names) <= longest:
        half = 1 << (len(names) - 1)
        last = names[-1]
        names.append(mix(last[:-half] * _LEFT + (last[half:] ^ _RIGHT) * _RIGHT))
    return names


def _small_periods(ids: np.ndarray, min_length: int) -> Runs:
    """Runs of periods below SMALL; short ones too where larger scales need to know them."""
    begins, ends, periods = [], [], []
    for q in range(1, min(SMALL, len(ids))):
        same = np.flatnonzero(ids[q:] == ids[:-q])
        if not len(same):
            continue
        cut = np.flatnonzero(np.diff(same) != 1)
        begin, end = same[np.append(0, cut + 1)], same[np.append(cut, len(same) - 1)] + 1 + q
        long = end - begin >= max(2 * q, min(min_length, 4 * q, 12))
        begins.append(begin[long])
        ends.append(end[long])
        periods.append(np.full(int(long.sum()), q))
    return _least_periods(*(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (begins, ends, periods)))


def _least_periods(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> Runs:
    """Of stretches with the same ends, the one of the least period."""
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.append(True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))[: len(begin)]
    return begin[first], end[first], period[first]


def _proposals(names: list[np.ndarray], k: int, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Places of the set of scale 2^k whose 2^(k+1) words stand again 3 to 6 scales later, and how far."""
    t = 1 << k
    block = names[k]
    begin, end, period = runs
    flat = (3 * period <= t) & (end - begin >= t)
    if flat.any():
        block = np.where(covered(begin[flat], end[flat] - t + 1, len(block)), _NAMELESS, block)
    least = block
    for j in range(k):
        least = np.minimum(least[: len(least) - (1 << j)], least[1 << j :])
    least = np.minimum(least[:-1], block[t : t + len(least) - 1])
    n = len(least)
    places = np.flatnonzero(((least == block[:n]) | (least == block[t : t + n])) & (least != _NAMELESS))
    places = places[places < len(names[k + 1])]
    context = names[k + 1][places]
    order = np.argsort(context, kind="stable")
    places, context = places[order], context[order]
    starts, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lag in range(1, len(places)):
        gap = places[lag:] - places[:-lag]
        near = np.flatnonzero((context[lag:] == context[:-lag]) & (gap < 6 * t))
        if not len(near):
            break
        wide = near[gap[near] >= 3 * t]
        starts.append(places[wide])
        gaps.append(gap[wide])
    return np.concatenate(starts), np.concatenate(gaps)


def _paired_regions(ids: np.ndarray, runs: Runs, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals from highly periodic regions of one period, the second of which begins inside the first or at its end."""
    begin, end, period = runs
    flat = np.flatnonzero((3 * period <= t) & (end - begin >= 3 * t))
    flat = flat[np.lexsort((begin[flat], period[flat]))]
    one, two = flat[:-1], flat[1:]
    meet = (period[one] == period[two]) & (begin[two] <= end[one])
    starts, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in zip(one[meet], two[meet], strict=True):
        p, at = int(period[a]), int(begin[b])
        tail, head = ids[end[a] - 2 * p : end[a]], ids[at : at + p]
        for shift in np.flatnonzero(tail[1 : p + 1] == head[0]) + 1:
            if np.array_equal(tail[shift : shift + p], head):
                phase = (at - (end[a] - 2 * p + shift)) % p
                gap = np.arange(3 * t + (phase - 3 * t) % p, min(6 * t, end[b] - at + p, end[a] - begin[a] + p), p)
                starts.append(np.maximum(at - gap, begin[a]))
                gaps.append(gap)
                break
    return np.concatenate(starts), np.concatenate(gaps)


def _extended(names: list[np.ndarray], at: np.ndarray, gap: np.ndarray) -> Runs:
    """The run of each proposal, where it has two periods or more."""
    if not len(at):
        return at, at, gap
    order = np.lexsort((at, gap))
    at, gap = at[order], gap[order]
    # Of neighbours with the same distance between which the words agree at that distance, the first speaks for all.
    fresh = np.ones(len(at), bool)
    near = np.flatnonzero(gap[1:] == gap[:-1]) + 1
    fresh[near] = ~_same(names, at[near - 1], at[near - 1] + gap[near], at[near] - at[near - 1])
    at, gap = at[fresh], gap[fresh]
    size = len(names[0])
    right, left = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in reversed(range(len(names))):
        name, step = names[k], 1 << k
        here = at + right
        fits = here + gap + step <= size
        right += step * (fits & (name[np.where(fits, here, 0)] == name[np.where(fits, here + gap, 0)]))
        here = at - left - step
        fits = here >= 0
        left += step * (fits & (name[np.where(fits, here, 0)] == name[np.where(fits, here + gap, 0)]))
    long = left + right >= gap
    return _least_periods((at - left)[long], (at + gap + right)[long], gap[long])


def _same(names: list[np.ndarray], here: np.ndarray, there: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether `size` words from two places on are equal; sizes of nothing are."""
    level = np.frexp(np.maximum(size, 1).astype(float))[1] - 1
    equal = np.zeros(len(here), bool)
    for k in np.unique(level).tolist():
        if k < len(names):
            on = np.flatnonzero(level == k)
            last = size[on] - (1 << k)
            name = names[k]
            equal[on] = (name[here[on]] == name[there[on]]) & (name[here[on] + last] == name[there[on] + last])
    return equal | (size == 0)
