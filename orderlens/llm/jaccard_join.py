"""Size-aware Jaccard join of documents on word shingles, and the groups it links.

A document's set holds its distinct shingles of `shingle` words (four by default), A-Z lower-cased. Equal sets are one class from the
start. Two classes link at a Jaccard similarity of `percent` or more.

Small sets (up to a boundary): two linked sets share a subset that lacks few elements of either, so every
subset of every size that a link allows is enumerated. The sets that hold a subset link with the smallest
of them if any two of them link through it, so a star for each subset keeps all connections.

Large sets: in one global order of shingles the first `n - ceil(percent n) + 1` of two linked sets meet, so
inverted lists over those are enough. Lists are scanned twice. First each list's members are compared with its
least and its greatest member. Then only members of different components are compared, all with all, in chunks.
A parity sketch of each set bounds the symmetric difference from below without error, so most pairs
end there; the others are verified on the whole sets.

The boundary is the one with the least estimated cost, subsets against list entries, from the histogram of set
sizes. Shingles that are frequent in a sample of documents stand last in the order, which only keeps lists
short. Sets are compared by 64-bit hashes of shingles.

A text of fewer words than a shingle has its whole sequence as one. Null text, or one without words, has an
empty set, links with nothing and is a component by itself. A row without id gets no links and a null component. Rows
of one id are one document. Texts are read whole, one at a time beyond 1 MB. Tables without rows give none.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .buffers import chunks, column_buffer, mix, prefix_sums, ranges, span_hashes, text_hashes, word_spans
from .components import components
from .rounds import ASKED, judged, next_pass, packed_rows, split
from .scratch import landed
from .substring_dedup import _long, _short

SHINGLE = 4
PERCENT = 85
#: Sets whose subsets may be enumerated at all.
MOST_SMALL = 20
#: Cost of a list entry against that of a subset.
ENTRY_COST = 4.0
#: Documents (one in so many), and shingles kept, for the order of shingles.
SAMPLE_ONE_IN, MOST_FREQUENT, FREQUENT = 16, 500_000, 3
CHUNK = 20_000
BLOCK_ROWS = 2_000
LEAST_WORDS = 8

DIGEST = "doc_id long, n long, k1 long, k2 long, head binary, sketch binary"


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Elements that a set of n shares at least with any set it links to."""
    return -(-percent * n // 100)


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    data, offsets = column_buffer(column)
    for a, b in chunks(offsets):
        part = data[offsets[a] : offsets[b]]
        part = part + np.where((part >= 0x41) & (part <= 0x5A), np.uint8(32), np.uint8(0))
        starts, ends, firsts = word_spans(part, offsets[a : b + 1] - offsets[a])
        sums = prefix_sums(text_hashes(part, starts, ends))
        counts = np.diff(firsts)
        sizes = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
        at = ranges(firsts[:-1], sizes)
        width = np.repeat(np.minimum(counts, shingle), sizes)
        hashes = span_hashes(sums, at, at + width)
        owner = np.repeat(np.arange(b - a), sizes)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
        hashes, owner = hashes[new], owner[new]
        cut = np.searchsorted(owner, np.arange(b - a + 1))
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            yield hashes[x:y]


def sketch_of(values: np.ndarray) -> np.ndarray:
    """Parity of the elements in each of 64 * words cells; two sketches differ in no more cells than their sets in elements."""
    words = max(LEAST_WORDS, 1 << max(0, math.ceil(math.log2(max(1, len(values)) / 64))))
    cells = mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(words * 64 - 1)
    bits = (np.bincount(cells.astype(np.int64), minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(np.uint64)


def head_size(n: int, percent: int) -> int:
    return n if n <= MOST_SMALL else n - least_overlap(n, percent) + 1


def in_order(values: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The global order: frequent shingles last, else by another hash."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
        late = frequent[at] == values
    else:
        late = np.zeros(len(values), bool)
    return values[np.lexsort((mix(values), late))]


def frequent_shingles(docs: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """At most `MOST_FREQUENT` shingles that occur `FREQUENT` times or more in the sample, the most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [*shingle_sets(batch.column(0), shingle)]
            values = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], names=["shingle"])

    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(SAMPLE_ONE_IN)) == 0).select("text")
    counts = chosen.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle")
    return np.sort(top.toArrow()["shingle"].to_numpy().view(np.uint64))


def digests(docs: DataFrame, frequent: np.ndarray, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """Per document: set size, two hashes of the set, its first shingles in the global order, and its sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for values in shingle_sets(batch.column(1), shingle):
                n = len(values)
                keys = [int(mix(values * np.uint64(2 * k + 1) + np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) for k in (1, 2)]
                head = in_order(values, shared.value)[: head_size(n, percent)]
                rows.append((n, *keys, head.tobytes(), sketch_of(values).tobytes()))
            columns = [*zip(*rows, strict=True)] or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.binary()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n", "k1", "k2", "head", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, DIGEST)


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest set size to enumerate: least cost of subsets up to it and list entries beyond."""

    def subsets(n: int) -> int:
        return sum(math.comb(n, c) for c in range(max(1, least_overlap(n, percent)), n + 1))

    def cost(x: int) -> float:
        small = sum(count * subsets(n) for n, count in sizes.items() if 0 < n <= x)
        large = sum(count * (n - least_overlap(n, percent) + 1) for n, count in sizes.items() if n >= least_overlap(x + 1, percent))
        return small + ENTRY_COST * large

    return min(range(MOST_SMALL + 1), key=cost)


def subset_links(classes: DataFrame, x: int, percent: int) -> DataFrame:
    """Links (a, b) between sets of at most x elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for node, n, head in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                values = np.frombuffer(head, np.uint64)
                once = mix(values)
                twice = mix(once ^ np.uint64(0x5555555555555555))
                for c in range(max(1, least_overlap(n, percent)), n + 1):
                    picks = np.array([*itertools.combinations(range(n), c)], np.int64)
                    keys = zip(once[picks].sum(1).view(np.int64).tolist(), twice[picks].sum(1).view(np.int64).tolist(), strict=True)
                    out += [(k, check, c, n, node) for k, check in keys]
            columns = [*zip(*out, strict=True)] or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "check", "c", "n", "node"])

    small = classes.where((F.col("n") > 0) & (F.col("n") <= x)).select("node", "n", "head")
    rows = landed(small.mapInArrow(run, "key long, check long, c long, n long, node long"), "subsets")
    keys = ["key", "check", "c"]
    least = rows.groupBy(*keys).agg(F.min(F.struct("n", "node")).alias("least"), F.count(F.lit(1)).alias("many")).where("many > 1")
    stars = rows.join(landed(least, "least_subsets"), keys)
    linked = F.col("c") * 100 >= (F.col("least.n") + F.col("n") - F.col("c")) * percent
    stars = stars.where(linked & (F.col("node") != F.col("least.node")))
    return stars.select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct()


def postings(classes: DataFrame, x: int, percent: int) -> DataFrame:
    """token, node and n for every list entry of sets that may link with one larger than x, where the list has two entries or more."""
    spark = classes.sparkSession
    rows = classes.where(F.col("n") >= max(1, least_overlap(x + 1, percent)))
    count = rows.count()
    number = max(1, -(-count // BLOCK_ROWS))
    parts = max(1, min(number, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4))
    blocks = rows.select("node", "n", "head", F.pmod(F.xxhash64("node"), F.lit(number)).alias("block")).repartition(parts, "block")

    def entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = table.sort_by([("node", "ascending"), ("head", "ascending")])
        sizes = table["n"].to_numpy()
        heads = [np.frombuffer(h, np.uint64)[: n - least_overlap(n, percent) + 1] for h, n in zip(table["head"].to_pylist(), sizes, strict=True)]
        lengths = np.array(list(map(len, heads)), np.int64)
        return np.concatenate(heads), np.repeat(table["node"].to_numpy(), lengths), np.repeat(sizes, lengths)

    def ask(table: pa.Table) -> pa.Table:
        keys, counts = np.unique(entries(table)[0], return_counts=True)
        return packed_rows(table["block"][0].as_py(), split(keys, number), _short(keys), (counts > 1).astype(np.uint8))

    def judge(keys: np.ndarray, notes: np.ndarray, _: np.ndarray) -> np.ndarray:
        _, inverse, counts = np.unique(_long(keys), return_inverse=True, return_counts=True)
        return (counts[inverse] > 1) | (notes > 0)

    def shared(table: pa.Table, block: int, said: np.ndarray) -> pa.Table:
        tokens, nodes, sizes = entries(table)
        _, inverse = np.unique(tokens, return_inverse=True)
        keep = said[inverse] > 0
        return pa.table({"token": tokens[keep].view(np.int64), "node": nodes[keep], "n": sizes[keep]})

    asked = blocks.groupBy("block").applyInArrow(ask, ASKED)
    said = judged(asked, np.dtype("V6"), np.dtype(np.uint8), judge, parts)
    return next_pass(blocks, [said], shared, "token long, node long, n long", in_order=False)


def _alike(n: str, m: str, percent: int):
    """Whether two set sizes can be those of linked sets."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of each list's least and greatest node with its other nodes of like size."""
    ends = lists.groupBy("token").agg(F.min(F.struct("node", "n")).alias("low"), F.max(F.struct("node", "n")).alias("high"))
    ends = landed(ends.where("low.node <> high.node"), "list_ends")
    rows = lists.join(ends, "token")
    found = None
    for end in ("low", "high"):
        some = rows.select(F.col("node"), F.col("n"), F.col(f"{end}.node").alias("other"), F.col(f"{end}.n").alias("m"))
        some = some.where((F.col("node") != F.col("other")) & _alike("n", "m", percent))
        some = some.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        found = some if found is None else found.union(some)
    return found.distinct()


def _far_apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cells in which rows of sketches differ."""
    return np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def sketched(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave a link possible."""
    rows = classes.select("node", "n", "sketch")
    left = rows.withColumnsRenamed({"node": "a", "n": "na", "sketch": "sa"})
    right = rows.withColumnsRenamed({"node": "b", "n": "nb", "sketch": "sb"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (batch.column(k) for k in range(6))
            keep = np.zeros(batch.num_rows, bool)
            total = na.to_numpy() + nb.to_numpy()
            for k, (x, y) in enumerate(zip(sa.to_pylist(), sb.to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                apart = int(np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum())
                keep[k] = apart * (100 + percent) <= int(total[k]) * (100 - percent)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], names=["a", "b"])

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
    return both.mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of documents whose whole sets link."""
    pairs = landed(pairs, "pairs")
    ids = landed(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair_ids")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [v.tobytes() for v in shingle_sets(batch.column(1), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "set"])

    ids = F.broadcast(ids) if ids.count() <= SMALL_IDS else ids
    own = landed(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, set binary"), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(x, y), max(0, len(x) - 1))
                both = int((x[at] == y).sum()) if len(x) and len(y) else 0
                keep[k] = both > 0 and both * 100 >= (len(x) + len(y) - both) * percent
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in (0, 1)], names=["a", "b"])

    rows = pairs.join(own.withColumnsRenamed({"doc_id": "a", "set": "sa"}), "a")
    rows = rows.join(own.withColumnsRenamed({"doc_id": "b", "set": "sb"}), "b").select("a", "b", "sa", "sb")
    return rows.mapInArrow(run, "a long, b long").distinct()


#: Ids of documents in pairs up to which they are sent to every task.
SMALL_IDS = 1_000_000


def cross_pairs(lists: DataFrame, groups: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes in one list, of like size and of different components, whose sketches leave a link possible."""
    rows = lists.join(groups.withColumnRenamed("component", "own"), "node", "left").withColumn("own", F.coalesce("own", "node"))
    mixed = rows.groupBy("token").agg(F.min("own").alias("x"), F.max("own").alias("y")).where("x <> y").select("token")
    rows = landed(rows.join(landed(mixed, "mixed_lists"), "token"), "mixed_entries")
    place = F.row_number().over(Window.partitionBy("token").orderBy("n", "node"))
    rows = rows.withColumn("chunk", F.floor((place - 1) / CHUNK))
    rows = rows.withColumn("chunks", F.max("chunk").over(Window.partitionBy("token")) + 1)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    part = F.struct("token", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    rows = rows.withColumn("part", F.xxhash64(part)).join(classes.select("node", "sketch"), "node")
    parts = max(1, int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4)
    rows = rows.select("part", "node", "n", "own", "chunk", "other", "sketch", F.pmod("part", F.lit(parts)).alias("bucket"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("n", "ascending"), ("node", "ascending")])
        part, node, n, own, chunk, other = (table[c].to_numpy() for c in ("part", "node", "n", "own", "chunk", "other"))
        raw = table["sketch"].to_pylist()
        words = np.array([len(x) // 8 for x in raw], np.int64)
        whole = np.frombuffer(b"".join(raw), np.uint64)
        at = np.cumsum(words) - words
        half_words = np.maximum(words // 2, LEAST_WORDS)
        half = np.concatenate([_folded(whole[a : a + w], h) for a, w, h in zip(at, words, half_words, strict=True)])
        half_at = np.cumsum(half_words) - half_words
        last = np.searchsorted(part, part, "right")
        # partners are later entries of the part, no larger than a link allows
        reach = np.minimum(last, _first_over(part, n, percent))
        many = np.maximum(reach - np.arange(len(part)) - 1, 0)
        found = [np.zeros((0, 2), np.int64)]
        ends = np.cumsum(many)
        first = 0
        while first < len(part):
            stop = max(first + 1, int(np.searchsorted(ends, (ends[first] - many[first]) + (1 << 19), "right")))
            i = np.repeat(np.arange(first, stop), many[first:stop])
            j = ranges(np.arange(first, stop) + 1, many[first:stop])
            keep = own[i] != own[j]
            cross = (chunk[i] != chunk[j]) | (chunk[i] == other[i]) & (chunk[j] == other[j])
            i, j = i[keep & cross], j[keep & cross]
            for width in np.unique(np.minimum(words[i], words[j])).tolist():
                own_width = np.minimum(words[i], words[j]) == width
                a, b = i[own_width], j[own_width]
                for k in range(0, len(a), max(1, (1 << 20) // width)):
                    x, y = a[k : k + (1 << 20) // width], b[k : k + (1 << 20) // width]
                    apart = _far_apart(_rows(whole, at, half, half_at, words, x, width), _rows(whole, at, half, half_at, words, y, width))
                    near = apart * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
                    found.append(np.stack([node[x[near]], node[y[near]]], axis=1))
            first = stop
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return rows.groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


def _first_over(part: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """For each entry, the first place in its part whose size is too large for it; entries are sorted by part and size."""
    most = n * 100 // percent
    _, group = np.unique(part, return_inverse=True)
    span = int(max(n.max(initial=0), most.max(initial=0))) + 1
    return np.searchsorted(group * span + n, group * span + np.minimum(most, span - 1), "right")


def _rows(whole, at, half, half_at, words, which, width) -> np.ndarray:
    """Sketches of some entries at a width that is theirs or half of it."""
    exact = words[which] == width
    start = np.where(exact, at[which], half_at[which])[:, None] + np.arange(width)
    flat = np.concatenate([whole, half])
    return flat[start + np.where(exact, 0, len(whole))[:, None]]


def linked_classes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, shingle: int = SHINGLE
) -> tuple[DataFrame, DataFrame]:
    """Digests of all documents, and node and component of every class in a link. Classes bear their least document id."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    digest = landed(digests(docs, frequent_shingles(docs, shingle), percent, shingle), "digests")
    named = digest.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = named.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("node"), F.min("n").alias("n"), F.min("head").alias("head"), F.min("sketch").alias("sketch")
    )
    classes = landed(classes.select("node", "n", "head", "sketch"), "classes")
    sizes = {r["n"]: r["many"] for r in _histogram(classes)}
    x = boundary(sizes, percent)
    lists = landed(postings(classes, x, percent), "postings")
    small = subset_links(classes, x, percent)
    large = verified(sketched(star_pairs(lists, percent), classes, percent), docs, percent, shingle)
    links = landed(small.union(large), "links")
    groups = landed(components(links), "components")
    rest = verified(cross_pairs(lists, groups, classes, percent), docs, percent, shingle)
    return digest, landed(components(links.union(rest)), "components")


def _histogram(classes: DataFrame) -> list:
    """Set sizes and how many classes have them; sizes beyond the enumerable ones together by powers of two."""
    size = F.when(F.col("n") <= 2 * MOST_SMALL, F.col("n")).otherwise(F.pow(F.lit(2), F.floor(F.log2("n"))).cast("long"))
    return classes.groupBy(size.alias("n")).agg(F.count(F.lit(1)).alias("many")).collect()


def join_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (least id with the same set) of every document."""
    digest, groups = linked_classes(docs, text, doc_id, percent, shingle)
    rows = digest.select("doc_id", "n", "k1", "k2")
    named = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    classes = classes.join(groups, "node", "left").select("k1", "k2", "node", F.coalesce("component", "node").alias("component"))
    out = rows.join(landed(classes, "class_components"), ["k1", "k2"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("node")).alias("class_id"),
    )


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The documents, all their columns, without those that a smaller document id reaches by links.

    Rows without id stay. Of several rows of one id the first by text stays.
    """
    groups = landed(join_groups(docs, text, doc_id, percent, shingle), "groups")
    gone = landed(groups.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    rest = _without(docs, gone, doc_id)
    twice = landed(groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated_ids")
    if twice.isEmpty():
        return rest
    own = rest.join(twice.withColumnRenamed("doc_id", "__id"), F.col(doc_id).cast("long") == F.col("__id"), "left_semi")
    place = F.row_number().over(Window.partitionBy(F.col(doc_id).cast("long")).orderBy(text))
    return _without(rest, twice, doc_id).unionByName(own.withColumn("__place", place).where("__place = 1").drop("__place"))


def _without(docs: DataFrame, ids: DataFrame, doc_id: str) -> DataFrame:
    ids = ids.withColumnRenamed("doc_id", "__id")
    ids = F.broadcast(ids) if ids.count() <= SMALL_IDS else ids
    return docs.join(ids, F.col(doc_id).cast("long") == F.col("__id"), "left_anti")


ORACLE_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos:pos + {SHINGLE - 1}], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {SHINGLE - 2}, 2))) AS pos FROM docs WHERE len(words) > 0)
), sets AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS same FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  JOIN sets s ON s.doc_id = x.doc_id JOIN sets t ON t.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, s.n, t.n HAVING 100 * count(*) >= {PERCENT} * (s.n + t.n - count(*))
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM docs
  UNION SELECT node, b FROM reached JOIN links ON a = other
), least AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, component_id,
       CASE WHEN s.n IS NULL THEN d.doc_id ELSE min(d.doc_id) OVER (PARTITION BY s.same) END AS class_id
FROM docs d JOIN least ON node = d.doc_id LEFT JOIN sets s ON s.doc_id = d.doc_id
"""
