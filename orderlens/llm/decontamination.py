"""Finds benchmark items inside long documents by MinHash containment, partitioned by item size.

Texts are lower-cased and cut into runs of letters and digits; a shingle is five of them. An item's
signature is the least few of its hashed shingles: for a containment of `share` and an item of at most
q shingles, floor((1 - share) * q) + 1 of them, where q is the upper end of the item's size class. A
document that holds that share of an item lacks fewer shingles than the signature has, so it holds one of
them: no leak is missed, however long the document is. Candidates are then verified by the exact share of the item's distinct
shingles, compared as strings.

Built-in functions only. A document's shingles meet the signatures row by row and are not shuffled. What is sent to all
tasks is a hash, an item's number and a size for each entry of a signature, in slices of at most `SLICE_PROBES` entries,
dealt by hash, so one long item is no larger slice; each slice is a pass over the documents. A document is no candidate for
an item of a size that its number of shingles cannot hold. Candidates are made distinct by text and item, and then verified
once each: only their texts are read again, and equal texts are verified as one.

Null or short texts, and items of fewer than five words, have no shingles and match nothing. Equal documents and equal items
all match, also where ids are null, repeated or shared by different items. Tables without rows give none. Texts are cut whole,
however long. Other columns may have any name; a carried column that is named like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import broadcast_if_small, joined, let
from .scratch import landed

WORDS = 5
#: Percent of an item's shingles.
SHARE = 80
#: Items, and entries of signatures of about 50 bytes in memory, that are sent to every task at once.
SLICE_ITEMS = 20_000
SLICE_PROBES = 1_000_000
#: Keys of contaminated texts up to which they are sent to every task.
SMALL = 1_000_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _places(words: Column) -> Column:
    return F.slice(words, F.lit(1), F.greatest(F.size(words) - (WORDS - 1), F.lit(0)))


def _shingles(words: Column) -> Column:
    """Distinct shingles as strings."""
    join = lambda ws: F.transform(_places(ws), lambda w, k: F.array_join(F.slice(ws, k + 1, F.lit(WORDS)), " "))
    return F.array_distinct(let(words, join))


def _hashes(words: Column) -> Column:
    """Hashes of all shingles in order."""
    more = lambda ws, k: [F.get(ws, k + n) for n in range(1, WORDS)]
    hashed = lambda ws: F.transform(_places(ws), lambda w, k: F.xxhash64(w, *more(ws, k)))
    return let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def signatures(items: DataFrame, text: str = "text", item_id: str = "item_id", share: int = SHARE) -> DataFrame:
    """item_id, n_shingles, shingles, size class and signature of every item that has shingles."""
    rows = items.select(F.col(item_id).alias("item_id"), _words(F.col(text)).alias("words"))
    rows = rows.select("item_id", _shingles(F.col("words")).alias("shingles"), _hashes(F.col("words")).alias("hashes"))
    rows = rows.select("item_id", "shingles", F.size("shingles").alias("n_shingles"), F.array_distinct("hashes").alias("hashes"))
    size_class = F.ceil(F.log2("n_shingles")).cast("int")
    upper = F.call_function("shiftleft", F.lit(1), F.col("size_class"))
    many = F.floor((100 - share) * upper / 100).cast("int") + 1
    return rows.where("n_shingles > 0").withColumn("size_class", size_class).select(
        "item_id", "n_shingles", "shingles", "size_class", F.slice(F.sort_array("hashes"), F.lit(1), many).alias("signature")
    )


#: What is said about a document and an item.
RESULTS = ("item_id", "n_shared", "n_shingles")


def leaks(
    docs: DataFrame,
    items: DataFrame,
    carry: list[str],
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    share: int = SHARE,
) -> DataFrame:
    """The `carry` columns of each document with item_id, n_shared and n_shingles of each item in it, once."""
    signed = signatures(items, item_text, item_id, share).withColumn("item", F.monotonically_increasing_id())
    signed = landed(signed, "signatures")
    need = F.ceil(F.col("n_shingles") * share / 100).cast("int")
    probes = landed(signed.select("item", need.alias("need"), F.explode("signature").alias("__hash")), "probes")
    slices = max(1, -(-signed.count() // SLICE_ITEMS), -(-probes.count() // SLICE_PROBES))
    carry = [c for c in carry if c not in RESULTS]
    keyed = docs.select(
        *[F.col(c).alias(f"__{k}_{c}") for k, c in enumerate(carry)], F.col(text).alias("__text"),
        F.xxhash64(text).alias("__k1"), F.xxhash64(F.lit(1), F.col(text)).alias("__k2"),
    )
    cut = keyed.select("__k1", "__k2", _words(F.col("__text")).alias("__words")).where(F.size("__words") >= WORDS)
    cut = cut.select("__k1", "__k2", (F.size("__words") - (WORDS - 1)).alias("__most"), F.explode(_hashes(F.col("__words"))).alias("__hash"))
    found = None
    for k in range(slices):
        own = probes.where(F.pmod("__hash", F.lit(slices)) == k)
        hit = cut.join(F.broadcast(own), "__hash").where(F.col("__most") >= F.col("need")).select("__k1", "__k2", "item")
        found = hit if found is None else found.unionByName(hit)
    candidates = landed(found.distinct(), "candidates")
    keys = broadcast_if_small(candidates.select("__k1", "__k2").distinct(), SMALL)
    texts = keyed.join(keys, ["__k1", "__k2"], "left_semi").groupBy("__k1", "__k2").agg(F.first("__text").alias("__text"))
    pairs = texts.withColumn("__shingles", _shingles(_words(F.col("__text")))).drop("__text").join(candidates, ["__k1", "__k2"])
    verified = pairs.join(signed.select("item", "item_id", "n_shingles", "shingles"), "item")
    verified = verified.withColumn("n_shared", F.size(F.array_intersect("__shingles", "shingles")))
    verified = verified.where(F.col("n_shared") * 100 >= F.col("n_shingles") * share).select("__k1", "__k2", *RESULTS).distinct()
    out = keyed.drop("__text").join(broadcast_if_small(landed(verified, "verified"), SMALL), ["__k1", "__k2"])
    return out.select(*[F.col(f"__{k}_{c}").alias(c) for k, c in enumerate(carry)], *RESULTS).distinct()


def clean(docs: DataFrame, items: DataFrame, text: str = "text", share: int = SHARE) -> DataFrame:
    """The documents, all their columns, without those that hold an item.

    Equal texts share the verdict, so it is kept by two hashes of the text and needs no document id.
    """
    keys = {"__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(1), F.col(text))}
    bad = leaks(docs.select(text).withColumns(keys), items, list(keys), text, share=share)
    bad = landed(bad.select(*keys).distinct(), "contaminated")
    return joined(docs.withColumns(keys), broadcast_if_small(bad, SMALL), list(keys), "left_anti").select(*docs.columns)


_SPLIT = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
_CUT = f"unnest(list_distinct(list_transform(range(1, len(words) - {WORDS - 2}), lambda k: array_to_string(words[k:k + {WORDS - 1}], ' '))))"

ORACLE_SQL = f"""
WITH items AS (
  SELECT item_id, {_CUT} AS shingle FROM (SELECT item_id, {_SPLIT} AS words FROM benchmark) WHERE len(words) >= {WORDS}
), sizes AS (SELECT item_id, count(*)::INT AS n_shingles FROM items GROUP BY item_id),
docs AS (
  SELECT doc_id, {_CUT} AS shingle FROM (SELECT doc_id, {_SPLIT} AS words FROM documents) WHERE len(words) >= {WORDS}
)
SELECT doc_id, item_id, count(*)::INT AS n_shared, n_shingles
FROM docs JOIN items USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) * 100 >= n_shingles * {SHARE}
"""
