"""Row-wise Arrow operators that keep the other columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .buffers import chunks, column_buffer


def with_text_results(
    docs: DataFrame,
    text: str,
    results: str,
    make: Callable[[np.ndarray, np.ndarray], list],
) -> DataFrame:
    """The rows with the columns of `results` (DDL) added; a column of such a name in `docs` is replaced.

    `make` gets the bytes and offsets of some whole texts and returns an array for each new column. Texts
    reach it about 1 MB at a time, so what it holds does not grow with the partition.
    """
    added = T.StructType.fromDDL(results)
    names = added.fieldNames()
    kept = [c for c in docs.columns if c not in names]
    schema = T.StructType([*(docs.schema[c] for c in kept), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_buffer(batch.column(batch.schema.get_field_index(text)))
            for first, last in chunks(offsets):
                cut = offsets[first : last + 1] - offsets[first]
                made = make(data[offsets[first] : offsets[last]], cut)
                rows = batch.slice(first, last - first)
                arrays = [rows.column(batch.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, *(x if isinstance(x, pa.Array) else pa.array(x) for x in made)], names=[*kept, *names])

    return docs.mapInArrow(run, schema)


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def sums_by(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of values[firsts[k]:firsts[k + 1]] for each k."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def led_by(data: np.ndarray, offsets: np.ndarray, byte: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each non-empty one led by one more byte."""
    full = offsets[:-1] < offsets[1:]
    return np.insert(data, offsets[:-1][full], byte), offsets + np.append(0, np.cumsum(full))
