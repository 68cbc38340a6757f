"""SentencePiece vocabularies: which unit boundaries are safe, and the best segmentation of every prefix.

A unit is a run of marks (U+2581, the mark of a space) with the characters up to the next mark. No piece
goes on past a unit's end, so units are encoded on their own.

For a merging (BPE) vocabulary the segmentation of a prefix is that of a shorter prefix plus one last
piece. A last piece is admissible if the merges leave it and its neighbour apart; exactly one is, so the
forward pass has one admissible path and its result is that of the merges. For a unigram vocabulary
every piece is admissible and the path of the highest score wins.
"""

from __future__ import annotations

import functools

import numpy as np
import sentencepiece

MARK = "▁"


class PieceModel:
    def __init__(self, path: str):
        self.path = path
        sp = self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unigram = not _is_bpe(sp)
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        spelled = []
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                spelled.append(b" \xe2\x81\x87 " if sp.is_unknown(i) else b"")
            else:
                self.ids[piece] = i
                spelled.append(piece.replace(MARK, " ").encode())
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_size = np.array(list(map(len, spelled)), np.int64)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        #: A line end is a unit of its own where no piece holds it.
        self.cuts_lines = not any("\n" in p for p in self.ids)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes on past a mark; units cannot be encoded on their own")
        self._apart: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}

    def merged(self, text: str) -> list[str]:
        """The merges, best score first and leftmost among equals; for short texts only."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def whole(self, piece: str) -> bool:
        """Whether the merges make this piece of its own characters."""
        known = self._whole.get(piece)
        if known is None:
            known = self._whole[piece] = self.merged(piece) == [piece]
        return known

    def apart(self, left: str, right: str) -> bool:
        """Whether the merges leave the two pieces apart."""
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) > 400_000:
                self._apart.clear()
            known = self._apart[left, right] = self.merged(left + right) == [left, right]
        return known

    def piece_ids(self, piece: str) -> list[int]:
        """One id, or an id for each byte of a character that the vocabulary lacks."""
        i = self.ids.get(piece)
        return [i] if i is not None else [self.byte_ids[b] for b in piece.encode()]


def _is_bpe(sp: sentencepiece.SentencePieceProcessor) -> bool:
    """Scores of merging vocabularies are minus the rank: whole numbers."""
    ids = [i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    return all(float(sp.get_score(i)).is_integer() for i in ids[:2000])


@functools.lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


class PrefixTrie:
    """Depth-first pass over the trie of sorted distinct units.

    Kept for every prefix on the way down: its last piece, its token count and its forward score. The next
    unit starts from the prefix that it shares with the unit before.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.unit = ""
        self.last: list[str] = [""]
        self.count: list[int] = [0]
        self.score: list[float] = [0.0]

    def visit(self, unit: str) -> None:
        shared, most = 0, min(len(unit), len(self.unit))
        while shared < most and unit[shared] == self.unit[shared]:
            shared += 1
        for row in (self.last, self.count, self.score):
            del row[shared + 1 :]
        self.unit = unit
        step = self._best if self.model.unigram else self._admissible
        for end in range(shared + 1, len(unit) + 1):
            piece = step(unit, end)
            before = end - len(piece)
            known = piece in self.model.ids
            self.last.append(piece)
            self.count.append(self.count[before] + (1 if known else len(piece.encode())))
            self.score.append(self.score[before] + (self.model.scores[piece] if known else 0.0))

    def _admissible(self, unit: str, end: int) -> str:
        model, last = self.model, self.last
        for size in range(min(end, model.longest), 1, -1):
            piece = unit[end - size : end]
            if piece in model.ids and model.whole(piece) and (size == end or model.apart(last[end - size], piece)):
                return piece
        return unit[end - 1 : end]

    def _best(self, unit: str, end: int) -> str:
        model, best, won = self.model, None, unit[end - 1 : end]
        unknown = min(model.scores.values(), default=0.0) - 10.0
        for size in range(1, min(end, model.longest) + 1):
            piece = unit[end - size : end]
            score = model.scores.get(piece, unknown if size == 1 else None)
            if score is not None and (best is None or self.score[end - size] + score > best):
                best, won = self.score[end - size] + score, piece
        return won

    def pieces(self) -> list[str]:
        """The segmentation of the unit visited last."""
        out, end = [], len(self.unit)
        while end:
            out.append(self.last[end])
            end -= len(self.last[end])
        return out[::-1]


def unit_spans(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the units of texts that begin with their added mark, and each text's first unit."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    blank = data == 0x20
    own = np.zeros(len(data), bool)  # the last byte of a mark that the text itself holds
    own[2:] = (data[2:] == 0x81) & (data[1:-1] == 0x96) & (data[:-2] == 0xE2)
    head = blank.copy()
    head[1:] &= ~(blank[:-1] | own[:-1])
    if model.cuts_lines:
        line = data == 0x0A
        head |= line
        head[1:] |= line[:-1]
    head[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(head)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


def unit_text(unit: bytes) -> str:
    return unit.decode().replace(" ", MARK)


def encode_units(model: PieceModel, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units, and how many each unit has."""
    trie, ids, sizes = PrefixTrie(model), [], []
    for unit in units:
        trie.visit(unit_text(unit))
        before = len(ids)
        for piece in trie.pieces():
            ids += model.piece_ids(piece)
        sizes.append(len(ids) - before)
    return np.array(ids, np.int32), np.array(sizes, np.int64)


def count_units(model: PieceModel, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token counts after every character of every unit, and how many characters each unit has."""
    trie, counts, sizes = PrefixTrie(model), [], []
    for unit in units:
        trie.visit(unit_text(unit))
        counts += trie.count[1:]
        sizes.append(len(trie.count) - 1)
    return np.array(counts, np.int32), np.array(sizes, np.int64)
