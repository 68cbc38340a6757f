"""Byte-level BPE through the tokenizers library, each distinct unit of text encoded once per worker.

The library's pattern never lets a piece run from a visible character into white space, from a single
line end into a word, or across the border of ASCII letters or digits and ASCII punctuation (apostrophes aside).
Texts are cut there. Texts with other white space or with an added token's string go to the library whole.

Units without blanks but one leading space go to the library many at a time, a line each: a single line end before
a visible character or a space is a piece of its own, and no such unit has its id.
"""

from __future__ import annotations

import functools
import json

import numpy as np
from tokenizers import Tokenizer

from .buffers import IS_BLANK, ranges
from .memo import UnitMemo

AT_ONCE = 2048
A_TEXT = 64
LINE = b"\n"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = True

#: White space beyond the six ASCII characters, as UTF-8.
_OTHER_BLANKS = tuple(
    chr(c).encode()
    for c in (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def _simple(units: list[bytes]) -> np.ndarray:
    """Which units have no blank but one leading space before something else."""
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    data = np.frombuffer(b"".join(units), np.uint8)
    firsts = np.append(0, np.cumsum(sizes))
    blanks = np.diff(np.append(0, np.cumsum(IS_BLANK[data]))[firsts])
    return (blanks == 0) | ((blanks == 1) & (sizes > 1) & (data[firsts[:-1]] == 0x20))


class ByteBpe:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        told = json.loads(self.tokenizer.to_str())
        pre = told.get("pre_tokenizer") or {}
        self.cuts = (
            told.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
        )
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = [*_OTHER_BLANKS, *added]
        line = self.tokenizer.encode(LINE.decode(), add_special_tokens=False).ids
        self.line = line[0] if self.cuts and len(line) == 1 else None
        self.memo = UnitMemo(self._encode_units, np.int32, in_order=False)

    def _encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units as `unit_spans` cuts them."""
        if self.line is None:
            return self._encode(units)
        simple = _simple(units)
        if not simple.all():
            one, two = np.flatnonzero(simple), np.flatnonzero(~simple)
            values, sizes = self._encode_units([units[k] for k in one])
            more, more_sizes = self._encode([units[k] for k in two])
            counts, at = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
            counts[one], counts[two] = sizes, more_sizes
            at[one], at[two] = np.cumsum(sizes) - sizes, len(values) + np.cumsum(more_sizes) - more_sizes
            return np.concatenate([values, more])[ranges(at, counts)], counts
        lines = [(LINE.join(units[k : k + A_TEXT]) + LINE).decode() for k in range(0, len(units), A_TEXT)]
        ids = [np.zeros(0, np.int32)]
        for k in range(0, len(lines), AT_ONCE // A_TEXT):  # the library's results take far more room than the ids
            some = self.tokenizer.encode_batch_fast(lines[k : k + AT_ONCE // A_TEXT], add_special_tokens=False)
            ids += [np.array(x.ids, np.int32) for x in some]
        ids = np.concatenate(ids)
        ends = np.flatnonzero(ids == self.line)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.int32)], np.zeros(len(units), np.int64)
        for k in range(0, len(units), AT_ONCE):
            some = [u.decode() for u in units[k : k + AT_ONCE]]
            rows = [x.ids for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            sizes[k : k + len(rows)] = list(map(len, rows))
            ids.append(np.fromiter((i for row in rows for i in row), np.int32))
        return np.concatenate(ids), sizes

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all whole texts one after the other, and how many each text has."""
        raw, n = data.tobytes(), len(offsets) - 1
        odd = np.zeros(n, bool)
        seen = np.zeros(256, bool)
        seen[data] = True
        for mark in self.whole if self.cuts else ():
            at = raw.find(mark) if seen[list(mark)].all() else -1
            while at >= 0:
                doc = int(np.searchsorted(offsets, at, "right")) - 1
                odd[doc] = True
                at = raw.find(mark, int(offsets[doc + 1]))
        if not self.cuts:
            odd[:] = True
        starts, ends = unit_spans(data, offsets)
        owner = np.searchsorted(offsets, starts, "right") - 1
        plain = ~odd[owner]
        values, sizes = self.memo.lookup(data, starts[plain], ends[plain])
        counts = np.bincount(owner[plain], weights=sizes, minlength=n).astype(np.int64)
        if odd.any():
            which = np.flatnonzero(odd)
            own, own_sizes = self._encode([raw[offsets[k] : offsets[k + 1]] for k in which])
            at = np.cumsum(counts) - counts
            pool_at = at.copy()
            pool_at[which] = len(values) + np.cumsum(own_sizes) - own_sizes
            counts[which] = own_sizes
            values = np.concatenate([values, own])[ranges(pool_at, counts)]
        return values, counts


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def unit_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none
    blank, letter, punctuation = IS_BLANK[data], _LETTER[data], _PUNCTUATION[data]
    alone = blank & (data != 0x20)  # one blank between visible characters, not a space
    alone[1:] &= ~blank[:-1]
    head = np.zeros(len(data), bool)
    head[1:] = (
        (blank[1:] & ~blank[:-1])
        | (alone[:-1] & ~blank[1:])
        | (letter[:-1] & punctuation[1:])
        | (punctuation[:-1] & letter[1:])
    )
    head[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(head)
    return starts, np.append(starts[1:], len(data))
