"""Encoding and decoding with a SentencePiece vocabulary.

Encoding: the distinct marked words of the texts at hand are sorted, which lays out their trie in
depth-first order; one pass keeps the forward score and last piece of every prefix and starts each word
from the prefix that it shares with the word before (`pieces.PrefixTrie`). For a merging vocabulary only
transitions that its merges leave standing are admissible, so ids equal the library's. A worker keeps
the words it has seen.

Decoding joins the spelled-out bytes of the ids and takes away the added mark.

Null text: no ids; it decodes to the empty text. Other columns stay; the result columns replace columns of
their names. Texts are read whole, one at a time beyond 1 MB. Rows are independent, so ties, repeated rows and empty tables need no rule.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import led_by, list_array, sums_by, with_text_results
from .buffers import ranges
from .memo import UnitMemo
from .pieces import PieceModel, encode_units, piece_model, unit_spans


@functools.lru_cache(maxsize=2)
def _memo(path: str) -> UnitMemo:
    model = piece_model(path)
    return UnitMemo(lambda units: encode_units(model, units), np.int32)


def ids_of(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the offset of each text's ids."""
    data, offsets = led_by(data, offsets, 0x20)
    starts, ends, firsts = unit_spans(piece_model(path), data, offsets)
    ids, sizes = _memo(path).lookup(data, starts, ends)
    return ids, np.append(0, np.cumsum(sums_by(sizes, firsts)))


def texts_of(model: PieceModel, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Bytes of each text; a leading mark, which encoding adds, is taken away."""
    sizes = model.spelled_size[ids]
    raw = model.spelled[ranges(model.spelled_at[ids], sizes)].tobytes()
    at = np.append(0, np.cumsum(sizes))[offsets].tolist()
    return [raw[a + raw.startswith(b" ", a, b) : b] for a, b in zip(at, at[1:], strict=False)]


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds the ids of each whole text and, if it is given a name, the text that these ids decode to.

    Decoding in the same pass spares a second Python worker in every task.
    """

    def make(data: np.ndarray, offsets: np.ndarray) -> list:
        found, cuts = ids_of(model_path, data, offsets)
        if decoded is None:
            return [list_array(found, cuts)]
        texts = texts_of(piece_model(model_path), found, cuts)
        return [list_array(found, cuts), pa.array([t.decode(errors="replace") for t in texts], pa.string())]

    results = f"{ids} array<int>" + (f", {decoded} string" if decoded else "")
    return with_text_results(docs, text, results, make)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of each row's ids; ids that form no valid UTF-8 give replacement characters."""
    kept = [c for c in encoded.columns if c != text]
    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            offsets = column.offsets.to_numpy().astype(np.int64)
            values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            texts = [t.decode(errors="replace") for t in texts_of(model, values, offsets - offsets[0])]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], names=[*kept, text])

    return encoded.mapInArrow(run, schema)
