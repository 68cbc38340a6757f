"""From raw documents to token ids: quality, near copies, repeated bytes, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next.
All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontamination, jaccard_join, quality_rules, sentence_pieces, suffix_dedup, workers
from orderlens.sources.sinks import work_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PIECES = "piece_bpe_32k.model"
#: Near copies share so many percent of their shingles of so many words; op4's contract has its own.
COPY_WORDS, COPY_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.kept(docs.select(*COLUMNS))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: the one of the least id."""
    workers.prepare_lean(spark)
    return jaccard_join.one_of_each(docs, percent=COPY_PERCENT, shingle=COPY_WORDS)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the bytes under a 50-byte string of an earlier document, and characters that a cut broke."""
    workers.prepare_lean(spark)
    kept = suffix_dedup.remove_repeated(docs, with_text=True, carry=("lang", "source"))
    text = F.col("kept_text")
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths or more of a benchmark item go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number, and whether they decode to the text."""
    workers.prepare_lean(spark)
    path = public_tokenizers.path(PIECES)
    coded = sentence_pieces.encode(docs.select("doc_id", "text"), path, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_copies),
    ("suffix_dedup", repeated_bytes),
    ("decontamination", benchmark),
    ("sentence_pieces", encoded),
]

#: Several stages are beyond SQL at this size; tests run the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
