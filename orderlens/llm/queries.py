"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import work_folder
from . import (
    centroid_clusters,
    decontamination,
    jaccard_join,
    lm_scoring,
    periodic_runs,
    quality_rules,
    sentence_pieces,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    url_filter,
    warc,
    workers,
)
from .native import let, words_of

BYTES = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words under a repeated window of 20, and the digest of the kept words."""
    kept = substring_dedup.remove_repeated(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds four fifths or more of a benchmark item's five-word shingles, with the item."""
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts, the base rule, and the verdict of the thresholds of its language and source."""
    found = quality_rules.verdicts(_table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: set size, least document reached by links, and least document with the same set."""
    return jaccard_join.join_groups(_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files read back: first position, ids with the end id, and their digest."""
    path = work_folder(spark, "token_files")
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTES), end_id=0)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url. A page's labels are those of its id; toxic or of low quality is bad."""
    labels = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    )
    return url_filter.judge(_table(spark, sf_dir, "pages"), labels)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, bytes under a 50-byte string of an earlier document, their runs, and the digest of the rest."""
    kept = suffix_dedup.remove_repeated(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, tokens known from training, and log10 probabilities by single tokens and by the model."""
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: ids by their count and a digest, and the decoded text by its digest; round_trip compares it with the text."""
    path = public_tokenizers.path(PIECES)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentence_pieces.encode(docs, path, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.crc32(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, exact tokens, whether they pass the limit, and how many characters fit it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(PIECES), TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, from the archives read back: its payload's size and digest, its record's type, and the page that holds the payload."""
    path = work_folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    found = warc.page_captures(warc.records(spark, path))
    return found.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: its cluster and squared distance, the sums over its cluster and over all, and its centroid's digest."""
    found, clusters = centroid_clusters.cluster(_table(spark, sf_dir, "embeddings"))
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    told = clusters.select("cluster", F.col("inertia").cast("long").alias("cluster_inertia"), F.sha2(text, 256).alias("centroid_sha256"))
    inertia = clusters.agg(F.sum("inertia").cast("long").alias("inertia"))
    # A row for each of 40 clusters.
    told = told.crossJoin(inertia)
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document by the hash of its id goes on, from some word on, with copies of the words there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def tail(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
        p = (F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))) + 1).cast("int")
        copies = F.transform(F.sequence(F.lit(0), F.greatest(n.cast("int") - a - 1, F.lit(0))), lambda i: F.get(words, a + F.pmod(i, p)))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), copies), " ")).otherwise("")

    text = F.when(F.pmod(h, F.lit(10)) == 0, let(words_of(F.coalesce("text", F.lit(""))), tail)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, some with a repeated tail: its runs by number, longest and digest, and the digest of the words left."""
    found = periodic_runs.find_runs(with_repeated_tails(_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.less")).alias("period"),
        F.expr("(1000 * longest.length) div (-longest.less)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_decontamination": op2_decontamination,
        "op3_quality_rules": op3_quality_rules,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_token_files": op5_token_files,
        "op6_url_filter": op6_url_filter,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_sentence_pieces": op9_sentence_pieces,
        "op10_token_counts": op10_token_counts,
        "op11_warc": op11_warc,
        "op12_centroid_clusters": op12_centroid_clusters,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    """SQL that DuckDB runs on whole tables; the other operators are tested against libraries and brute force."""
    return {
        "op1_substring_dedup": substring_dedup.ORACLE_SQL,
        "op2_decontamination": decontamination.ORACLE_SQL,
        "op3_quality_rules": quality_rules.ORACLE_SQL,
        "op4_jaccard_join": jaccard_join.ORACLE_SQL,
        "op7_suffix_dedup": suffix_dedup.ORACLE_SQL,
        "op11_warc": warc.ORACLE_SQL,
        "op12_centroid_clusters": centroid_clusters.oracle_sql(),
    }
