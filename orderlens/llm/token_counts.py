"""Exact token counts at every prefix, without encoding a text twice.

Every text is cut into units whose encodings do not touch. For each distinct unit a prefix pass
(`pieces.PrefixTrie`) stores the token count after each character; a text's count at any prefix is the sum
over its earlier units plus the stored count inside the current one. Truncation to a limit and the question
whether a text fits are look-ups in those counts.

Null text: counted as empty, 0 tokens. Other columns stay; `n_bytes`, `n_tokens`, `over_limit` and
`cut_chars` replace columns of those names. Texts are read whole, one at a time beyond 1 MB. Rows are independent, so repeated rows and empty tables need no rule.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import led_by, list_array, sums_by, with_text_results
from .buffers import ranges
from .memo import UnitMemo
from .pieces import count_units, piece_model, unit_spans

RESULTS = "n_bytes long, n_tokens long, over_limit boolean, cut_chars long"


@functools.lru_cache(maxsize=2)
def _memo(path: str) -> UnitMemo:
    model = piece_model(path)
    return UnitMemo(lambda units: count_units(model, units), np.int32)


def _prefixes(path: str, data: np.ndarray, offsets: np.ndarray):
    """Counts after each character of the units, characters of each unit, tokens before each unit, first units."""
    starts, ends, firsts = unit_spans(piece_model(path), data, offsets)
    inside, chars = _memo(path).lookup(data, starts, ends)
    whole = inside[np.cumsum(chars) - 1].astype(np.int64) if len(chars) else np.zeros(0, np.int64)
    before = np.cumsum(whole) - whole
    heads = before[np.minimum(firsts[:-1], max(0, len(before) - 1))] if len(before) else np.zeros(len(firsts) - 1, np.int64)
    return inside, chars, before - np.repeat(heads, np.diff(firsts)), whole, firsts


def count_tokens(docs: DataFrame, model_path: str, limit: int, text: str = "text") -> DataFrame:
    """Adds n_bytes, n_tokens, over_limit and cut_chars, the length in characters of the longest prefix within the limit."""

    def make(data: np.ndarray, offsets: np.ndarray) -> list:
        n_bytes = np.diff(offsets)
        data, offsets = led_by(data, offsets, 0x20)
        inside, chars, before, whole, firsts = _prefixes(model_path, data, offsets)
        tokens = sums_by(whole, firsts)
        cut = np.maximum(sums_by(chars, firsts) - (n_bytes > 0), 0)
        ends = np.cumsum(chars)
        for doc in np.flatnonzero(tokens > limit):
            a, b = firsts[doc], firsts[doc + 1]
            counts = inside[ends[a] - chars[a] : ends[b - 1]] + np.repeat(before[a:b], chars[a:b])
            fits = np.flatnonzero(counts <= limit)
            cut[doc] = fits[-1] if len(fits) else 0  # the added mark is the first character
        return [n_bytes, tokens, tokens > limit, cut]

    return with_text_results(docs, text, RESULTS, make)


def prefix_counts(docs: DataFrame, model_path: str, text: str = "text", name: str = "prefix_tokens") -> DataFrame:
    """Adds the token counts of the prefixes of 1, 2, 3, ... characters as one array."""

    def make(data: np.ndarray, offsets: np.ndarray) -> list:
        data, offsets = led_by(data, offsets, 0x20)
        inside, chars, before, _, firsts = _prefixes(model_path, data, offsets)
        counts = (inside + np.repeat(before, chars)).astype(np.int32)
        at = np.append(0, np.cumsum(chars))[firsts]
        lengths = np.diff(at)
        rest = np.maximum(lengths - 1, 0)  # a prefix without characters, the added mark, has no count
        return [list_array(counts[ranges(at[:-1] + 1, rest)], np.append(0, np.cumsum(rest)))]

    return with_text_results(docs, text, f"{name} array<int>", make)


def tokens_at(prefixes: Column, chars: Column) -> Column:
    """Token count of the prefix of so many characters, from the stored array."""
    return F.when(chars <= 0, 0).otherwise(F.get(prefixes, F.least(chars, F.size(prefixes)) - 1))


def truncated(docs: DataFrame, model_path: str, limit: int, text: str = "text") -> DataFrame:
    """The rows with each text cut to its longest prefix of at most `limit` tokens."""
    counted = count_tokens(docs, model_path, limit, text)
    return counted.withColumn(text, F.when(F.col("over_limit"), F.substring(text, F.lit(1), F.col("cut_chars"))).otherwise(F.col(text)))
