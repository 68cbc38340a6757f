"""Scores texts with a smoothed two-gram model laid out as a weighted backoff automaton.

States are the root and one state for each token, meaning "this token came last". A token that followed that
state's token in training has an arc; any other token takes the failure arc to the root, whose weight the
state's count sets, and leaves from there:

    p(w)      = (c(w) + 1) / (N + V + 1)
    arc       = (c(h w) + mu p(w)) / (c(h) + mu)            if c(h w) > 0
    failure   = mu / (c(h) + mu)                            and then p(w) from the root

so every state's weights sum to one. One walk from left to right carries the state and adds up log10
weights. Tokens are words, A-Z lower-cased, then one end token per text; the walk starts in a state of its own.

Counts are taken over all training documents, without a cut-off. Every block asks for the counts of its distinct tokens
and pairs, giving its own training counts with the question; the block's part of the automaton is built from
the answers. A token in a third of all places is one entry a block.

Held-out documents are those whose crc32 of the id as text leaves `remainder` modulo `modulus`. Null text is empty: its
only token is the end. A document without id is a training document. Repeated rows count as often as they occur. Texts are read whole, a longer
one than a block as a block of its own. Columns beyond id and text go. Tables without rows give none. Tokens and pairs are told apart by 64 bits of hash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .buffers import chunks, column_buffer, mix, text_hashes, word_spans
from .rounds import blocks_of, first_pass, split, texts_in_order

BLOCK_BYTES = 8 << 20
MODULUS, REMAINDER = 7, 2
MU = 300.0

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_END, _START = (np.uint64(x) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def is_held_out(doc_id: int | None, modulus: int, remainder: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == remainder


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys: the first, then the gaps in as few bytes each as the widest needs."""
    gaps = np.diff(keys)
    width = max(1, -(-int(gaps.max(initial=0)).bit_length() // 8))
    rest = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].tobytes() + rest.tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    width = raw[0]
    rest = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(rest), 8), np.uint8)
    gaps[:, :width] = rest
    return np.cumsum(np.append(np.frombuffer(raw, np.uint64, 1, 1), gaps.view(np.uint64).reshape(-1)), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """A byte for each count; those of 255 and more follow in full."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype(np.int64).tobytes()


def unpacked_counts(raw: bytes, size: int) -> np.ndarray:
    counts = np.frombuffer(raw, np.uint8, size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw[size:], np.int64)
    return counts


def _asked(block: int, bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    """One row for each bucket, from ascending keys."""
    firsts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    cuts = [*zip(firsts, np.append(firsts[1:], len(bucket)), strict=True)]
    return pa.table(
        {
            "bucket": pa.array(bucket[firsts], pa.int64()),
            "block": pa.array(np.full(len(firsts), block, np.int64)),
            "keys": pa.array([packed_keys(keys[a:b]) for a, b in cuts], pa.binary()),
            "notes": pa.array([packed_counts(counts[a:b]) for a, b in cuts], pa.binary()),
        }
    )


class _Tokens:
    """Tokens of a block's documents: distinct tokens and pairs, and the index of each place's token and pair."""

    def __init__(self, table: pa.Table, modulus: int, remainder: int):
        data, offsets = column_buffer(table["text"])
        data = data + np.where((data >= 0x41) & (data <= 0x5A), np.uint8(32), np.uint8(0))
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for a, b in chunks(offsets):
            part = data[offsets[a] : offsets[b]]
            starts, ends, firsts = word_spans(part, offsets[a : b + 1] - offsets[a])
            hashes.append(np.insert(text_hashes(part, starts, ends), firsts[1:], _END))
            counts.append(np.diff(firsts) + 1)
        tokens, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.firsts = np.append(0, np.cumsum(self.counts))
        before = np.append(_START, tokens[:-1]) if len(tokens) else tokens
        before[self.firsts[:-1]] = _START
        self.held_out = np.array([is_held_out(i, modulus, remainder) for i in table["doc_id"].to_pylist()], bool)
        self.training = np.repeat(~self.held_out, self.counts)
        self.tokens, self.token = np.unique(tokens, return_inverse=True)
        self.pairs, self.pair = np.unique(mix(before) * np.uint64(0x9E3779B97F4A7C15) ^ tokens, return_inverse=True)

    def counted(self, which: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(which[self.training], minlength=size)


class Automaton:
    """Arcs that a block's texts can take, from the counts of its tokens and pairs."""

    def __init__(self, token_counts: np.ndarray, pair_counts: np.ndarray, n_start: int, total: int, kinds: int, mu: float):
        self.root = (token_counts + 1.0) / (total + kinds + 1.0)
        #: Counts of the states; the last is the state before a text's first token.
        self.state = np.append(token_counts, n_start).astype(np.float64)
        self.failure = mu / (self.state + mu)
        self.pair_counts, self.mu = pair_counts, mu

    def walk(self, tokens: np.ndarray, pairs: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """log10 of each step's weight. The state after a step is that of its token, so states are the tokens moved by one."""
        if not len(tokens):
            return np.zeros(0)
        states = np.append(len(self.root), tokens[:-1])
        states[firsts] = len(self.root)
        seen = self.pair_counts[pairs]
        by_failure = self.failure[states] * self.root[tokens]
        by_arc = seen / (self.state[states] + self.mu) + by_failure
        return np.log10(np.where(seen > 0, by_arc, by_failure))


def score(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    mu: float = MU,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (single tokens only) and score of every document."""
    blocks, number, parts = blocks_of(docs, doc_id, text, block_bytes)

    def ask(table: pa.Table, block: int) -> pa.Table:
        own = _Tokens(table, modulus, remainder)
        one = _asked(block, split(own.tokens, number), own.tokens, own.counted(own.token, len(own.tokens)))
        two = _asked(block, number + split(own.pairs, number), own.pairs, own.counted(own.pair, len(own.pairs)))
        return pa.concat_tables([one, two])

    def added_up(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        keys = [unpacked_keys(x) for x in table["keys"].to_pylist()]
        notes = [unpacked_counts(x, len(k)) for x, k in zip(table["notes"].to_pylist(), keys, strict=True)]
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        return keys, inverse, np.bincount(inverse, weights=np.concatenate(notes)).astype(np.int64)

    def answer(table: pa.Table) -> pa.Table:
        """Counts over all blocks for each key that a block asked about."""
        keys, inverse, sums = added_up(table)
        answers, ends = sums[inverse], np.cumsum(list(map(len, keys)))
        said = [packed_counts(answers[e - len(k) : e]) for k, e in zip(keys, ends, strict=True)]
        sizes = pa.array(list(map(len, keys)), pa.int64())
        return pa.table({"block": table["block"], "bucket": table["bucket"], "said": pa.array(said, pa.binary()), "size": sizes})

    def total(table: pa.Table) -> pa.Table:
        """Training tokens and kinds of tokens in a bucket of tokens."""
        if table["bucket"][0].as_py() >= number:
            return pa.table({"tokens": pa.array([], pa.int64()), "kinds": pa.array([], pa.int64())})
        sums = added_up(table)[2]
        return pa.table({"tokens": [int(sums.sum())], "kinds": [int((sums > 0).sum())]})

    def scored(table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return to_arrow_schema(schema).empty_table()
        table = texts_in_order(table)
        own = _Tokens(table, modulus, remainder)
        told = said.filter(pa.array(said["bucket"].to_numpy() < 0)).to_pylist()[0]
        total, kinds, texts = map(int, told["said"].decode().split(","))
        rows = said.filter(pa.array(said["bucket"].to_numpy() >= 0)).sort_by("bucket")
        every = np.concatenate([unpacked_counts(x, n) for x, n in zip(rows["said"].to_pylist(), rows["size"].to_pylist(), strict=True)])
        counts, pair_counts = every[: len(own.tokens)], every[len(own.tokens) :]
        automaton = Automaton(counts, pair_counts, texts, total, kinds, mu)
        sums = lambda x: np.add.reduceat(x, own.firsts[:-1]) if len(x) else np.zeros(0)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "held_out": pa.array(own.held_out),
                "n_tokens": pa.array(own.counts),
                "n_known": pa.array(sums((counts[own.token] > 0).astype(np.int64)).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(own.counts), total, np.int64)),
                "base_score": pa.array(sums(np.log10(automaton.root)[own.token])),
                "score": pa.array(sums(automaton.walk(own.token, own.pair, own.firsts[:-1]))),
            }
        )

    schema = T.StructType.fromDDL(RESULT)
    asked = first_pass(blocks, ask).repartition(parts, "bucket").groupBy("bucket")
    answers = asked.applyInArrow(answer, "block long, bucket long, said binary, size long")
    held = F.crc32(F.col(doc_id).cast("long").cast("string")) % modulus == remainder
    texts = docs.agg(F.count_if(~F.coalesce(held, F.lit(False))).alias("texts"))
    sums = asked.applyInArrow(total, "tokens long, kinds long").withColumn("texts", F.lit(0).cast("long"))
    sums = sums.unionByName(texts.select(F.lit(0).cast("long").alias("tokens"), F.lit(0).cast("long").alias("kinds"), "texts"))
    told = sums.agg(*[F.sum(c).alias(c) for c in ("tokens", "kinds", "texts")]).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias("block"),
        F.lit(-1).cast("long").alias("bucket"),
        F.encode(F.concat_ws(",", "tokens", "kinds", "texts"), "UTF-8").alias("said"),
        F.lit(0).cast("long").alias("size"),
    )
    said = answers.unionByName(told).repartition(parts, "block")
    return blocks.groupBy("block").cogroup(said.groupBy("block")).applyInArrow(scored, schema)
