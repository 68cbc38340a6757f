"""Token ids in bit-packed files.

A file is a Parquet file of blocks, written by Spark's own committer to any store that Spark writes to. A
block holds whole documents of about 64 Ki ids, or one longer document:

    part    number of the file in document order
    first   ids in this file before the block
    bits    width of an id, the least that holds the vocabulary
    docs    document ids
    starts  offset of each document's ids in the block, and the number of ids in the block
    packed  ids of `bits` bits each, lowest bit first, without gaps

Id k of a block begins at bit k * bits, so numpy unpacks a block, or one document of it, in one go without
reading what stands before it. `part` and `first` have Parquet statistics, so a look-up by position reads
few blocks.

Documents stand in ascending doc_id order, null ids first, equal ids by text. Null text has no ids but the
end id. Tables without rows give files without blocks. Columns other than id and text are not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrow import list_array
from .buffers import chunks, column_buffer
from .byte_bpe import byte_bpe

BLOCK_IDS = 1 << 16
#: Files up to which their list is small enough to send to every task.
SMALL_LIST = 100_000

BLOCK = "part int, first long, bits int, docs array<long>, starts array<long>, packed binary"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of `bits` bits each, lowest bit first."""
    groups = -(-len(ids) // 8)
    lanes = np.zeros(groups * 8, np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, 8)
    out = np.zeros((groups, bits), np.uint8)
    for lane in range(8):
        at, shift = divmod(lane * bits, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, at + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(packed: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """Ids first, first + 1, ... of a block."""
    group = first // 8
    groups = -(-(first + count) // 8) - group
    part = np.frombuffer(packed, np.uint8)[group * bits : (group + groups) * bits]
    rows = np.zeros(groups * bits, np.uint8)
    rows[: len(part)] = part
    rows = rows.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    for lane in range(8):
        at, shift = divmod(lane * bits, 8)
        value = np.zeros(groups, np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            value |= rows[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[first - group * 8 :][:count]


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encodes every whole text, ends it with `end_id`, and writes the blocks."""
    bits = max(1, (byte_bpe(tokenizer_path).size - 1).bit_length(), end_id.bit_length())
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def encoded(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        data, offsets = column_buffer(batch.column(1))
        for a, b in chunks(offsets):
            ids, counts = byte_bpe(tokenizer_path).ids(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            at = np.cumsum(counts)
            yield batch.column(0).slice(a, b - a), np.insert(ids, at, end_id), counts + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            for names, ids, counts in encoded(batch):
                ends = np.cumsum(counts)
                a = 0
                while a < len(counts):
                    begin = int(ends[a] - counts[a])
                    b = min(len(counts), max(a + 1, int(np.searchsorted(ends, begin + BLOCK_IDS, "right"))))
                    own = ids[begin : ends[b - 1]]
                    starts = np.append(0, ends[a:b] - begin)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part], pa.int32()),
                            pa.array([first], pa.int64()),
                            pa.array([bits], pa.int32()),
                            list_array_of(names.slice(a, b - a)),
                            list_array(starts, np.array([0, len(starts)])),
                            pa.array([pack(own, bits)], pa.binary()),
                        ],
                        names=["part", "first", "bits", "docs", "starts", "packed"],
                    )
                    first += len(own)
                    a = b

    (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, BLOCK)
        .write.option("compression", "none")
        .parquet(path)
    )


def list_array_of(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.int64()))


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, base: ids of all files before this one. One row per file."""
    sizes = spark.read.parquet(path).groupBy("part").agg(F.sum(F.element_at("starts", -1)).alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def read(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32-bit numbers) of every document, or of those in `wanted`'s doc_id.

    `start` counts the ids of all documents before this one. Only the wanted documents are unpacked.
    """
    blocks, starts = spark.read.parquet(path), file_starts(spark, path)
    if starts.count() <= SMALL_LIST:
        starts = F.broadcast(starts)
    blocks = blocks.join(starts, "part")
    if wanted is not None:
        hit = (
            blocks.select("part", "first", F.explode("docs").alias("doc_id"))
            .join(wanted.select("doc_id").distinct(), "doc_id")
            .groupBy("part", "first")
            .agg(F.collect_set("doc_id").alias("picked"))
        )
        blocks = blocks.join(hit, ["part", "first"])
    else:
        blocks = blocks.withColumn("picked", F.lit(None).cast("array<long>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(batch.schema.get_field_index(c))[k] for c in batch.schema.names}
                docs = row["docs"].values
                starts = row["starts"].values.to_numpy()
                packed, bits = row["packed"].as_py(), row["bits"].as_py()
                sizes = np.diff(starts)
                if row["picked"].is_valid:
                    rows = np.flatnonzero(np.isin(docs.to_numpy(zero_copy_only=False), row["picked"].values.to_numpy()))
                    ids = [unpack(packed, bits, int(starts[i]), int(sizes[i])) for i in rows]
                    raw, ends = b"".join(x.tobytes() for x in ids), np.cumsum(sizes[rows]) * 4
                else:
                    rows = np.arange(len(sizes))
                    raw, ends = unpack(packed, bits, 0, int(starts[-1])).tobytes(), starts[1:] * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.take(pa.array(rows)),
                        pa.array(starts[rows] + row["first"].as_py() + row["base"].as_py()),
                        pa.array(sizes[rows]),
                        pa.BinaryArray.from_buffers(
                            pa.binary(),
                            len(rows),
                            [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(raw)],
                        ),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    columns = ["part", "first", "base", "bits", "docs", "starts", "packed", "picked"]
    return blocks.select(*columns).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
