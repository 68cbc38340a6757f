"""Question-and-answer rounds between blocks of documents and ranges of keys.

Documents are dealt into blocks by a hash of their id, so a block and all that is said about it meet again.
In a round every block asks about its distinct keys, as one packed row for each group of keys; the group
compares what all blocks ask and answers each row with one byte for each key, in the order in which it was
asked. A key that stands in a third of all rows is asked about once by each block, so no group is unbounded,
and a block's answers are no more than its keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ASKED = "bucket long, block long, keys binary, notes binary"
ANSWERED = "block long, bucket long, said binary"


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def blocks_of(
    docs: DataFrame, doc_id: str, text: str, block_bytes: int, carry: Sequence[str] = (), spread_null: bool = False
) -> tuple[DataFrame, int, int]:
    """doc_id, text, block and the carried columns, the number of blocks, and the number of partitions.

    Texts are shuffled once; every pass reuses that. Carried columns are named by `carried`. With `spread_null`, rows without
    id are dealt by their text, for operators to which they are not one after the other; else they share a block.
    """
    key = F.xxhash64(F.col(doc_id).cast("long"))
    if spread_null:
        key = F.when(F.col(doc_id).cast("long").isNull(), F.xxhash64(F.lit(3), F.col(text))).otherwise(key)
    number = max(1, -(-text_bytes(docs, text) // block_bytes))
    parts = max(1, min(number, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.pmod(key, F.lit(number)).alias("block"),
        *[F.col(c).alias(name) for c, name in zip(carry, carried(carry), strict=True)],
    )
    return rows.repartition(parts, "block"), number, parts


def carried(carry: Sequence[str]) -> list[str]:
    """Names that cannot clash with a block's own columns."""
    return [f"__carried_{k}" for k in range(len(carry))]


def result_schema(ddl: str, docs: DataFrame, carry: Sequence[str]) -> T.StructType:
    """The result's columns and the carried ones, under their inner names."""
    extra = [T.StructField(name, docs.schema[c].dataType) for c, name in zip(carry, carried(carry), strict=True)]
    return T.StructType([*T.StructType.fromDDL(ddl).fields, *extra])


def with_carried(result: pa.Table, table: pa.Table, carry: Sequence[str]) -> pa.Table:
    for name in carried(carry):
        result = result.append_column(name, table[name])
    return result


def named(result: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The result with its carried columns under their own names; a result column of such a name goes."""
    own = [c for c in result.columns if c not in carried(carry) and c not in carry]
    return result.select(*own, *[F.col(name).alias(c) for c, name in zip(carry, carried(carry), strict=True)])


def split(order_key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit key: even ranges of its leading bits, so sorted keys give sorted buckets."""
    return ((order_key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed_rows(block: int, bucket: np.ndarray, keys: np.ndarray, notes: np.ndarray) -> pa.Table:
    """One row for each bucket. `bucket` is ascending; keys and notes are arrays of fixed-width items."""
    firsts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    lasts = np.append(firsts[1:], len(bucket))[: len(firsts)]
    cut = lambda a: [a[x:y].tobytes() for x, y in zip(firsts, lasts, strict=True)]
    return pa.table(
        {
            "bucket": pa.array(bucket[firsts], pa.int64()),
            "block": pa.array(np.full(len(firsts), block, np.int64)),
            "keys": pa.array(cut(keys), pa.binary()),
            "notes": pa.array(cut(notes), pa.binary()),
        }
    )


def answers_by_bucket(table: pa.Table) -> np.ndarray:
    """All answers of a block in the order in which it asked."""
    order = np.argsort(table["bucket"].to_numpy())
    said = table["said"].to_pylist()
    return np.frombuffer(b"".join(said[i] for i in order), np.uint8)


def judged(asked: DataFrame, key: np.dtype, note: np.dtype, judge: Callable, parts: int) -> DataFrame:
    """Answers of every bucket. `judge(keys, notes, blocks)` gets all entries of one bucket and returns a byte for each."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, key) for x in table["keys"].to_pylist()]
        notes = [np.frombuffer(x, note) for x in table["notes"].to_pylist()]
        sizes = np.array(list(map(len, keys)), np.int64)
        blocks = table["block"].to_numpy()
        said = judge(np.concatenate(keys), np.concatenate(notes), np.repeat(blocks, sizes)).astype(np.uint8)
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "block": pa.array(blocks),
                "bucket": table["bucket"],
                "said": pa.array([said[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)], pa.binary()),
            }
        )

    return asked.repartition(parts, "bucket").groupBy("bucket").applyInArrow(run, ANSWERED).repartition(parts, "block")


def texts_in_order(table: pa.Table) -> pa.Table:
    """The same order in every pass, whatever order the rows came in."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def first_pass(blocks: DataFrame, ask: Callable[[pa.Table, int], pa.Table]) -> DataFrame:
    return blocks.groupBy("block").applyInArrow(lambda t: ask(texts_in_order(t), t["block"][0].as_py()), ASKED)


def next_pass(
    blocks: DataFrame, answers: list[DataFrame], ask: Callable, schema: str | T.StructType, in_order: bool = True
) -> DataFrame:
    """A pass over the blocks with the answers of earlier rounds. `in_order`: sort the rows as texts first."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    empty = to_arrow_schema(schema).empty_table()
    told, count = None, len(answers)
    for number, df in enumerate(answers):
        df = df.withColumn("round", F.lit(number))
        told = df if told is None else told.unionByName(df)

    def run(texts: pa.Table, said: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return empty
        rounds = said["round"].to_numpy()
        parts = [answers_by_bucket(said.filter(pa.array(rounds == k))) for k in range(count)]
        return ask(texts_in_order(texts) if in_order else texts, texts["block"][0].as_py(), *parts)

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)
