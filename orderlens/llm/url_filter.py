"""URL verdicts from rules and, where no rule fits, from a tree of path templates per host.

Every path becomes a shape: numbers and long hexadecimal segments are wildcards, digits inside other
segments become `#`. Whole shapes are counted per host. Level by
level, segments whose share of bad labels does not differ from their siblings' by a two-proportion test at `z` merge
into `*`, however many siblings there are; the others stand by themselves, as does an only child. From
`depth` segments on, the tree goes on only below nodes with good and bad labels, in steps from branch to branch; what lies
below others is one `**`. Each node of the resulting tree sums the labels below it. From the root down, a node whose share of bad labels
does not differ from its siblings' by the same test merges with them and takes its parent's
estimate; another node gets its own share, smoothed by `weight` pseudo-labels at the parent's estimate. A
template is rejected if its estimate reaches `reject`.

Shapes are summed in every task before they move, so a host with a third of all pages costs no more than its
distinct shapes; only rejected shapes are joined back to the pages.

Null url, or one without `://`: empty host and path, which are a host like any other. Pages without label
count as pages only. Repeated rows count as often as they occur; several labels of one page all count; labels that
are null, or of no page, do not. Urls are read whole, however long; a path of many segments costs as many rounds as the
mixed part of the tree has branches above one another. Only the named columns are read, so others may have any name, and
go. Tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import broadcast_if_small, joined
from .scratch import landed

DEPTH = 4
Z = 1.96
WEIGHT = 10.0
REJECT = 0.5
#: Rejected (host, shape) rows up to which they are sent to every task.
SMALL = 500_000

#: (verdict, host and path); fixed values of the contract.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: len(r[1])):
        own_host, _, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(f"/{own_path}")
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def shape_of(path: Column, depth: int | None = DEPTH) -> Column:
    """Segments of the path with wildcards for numbers and long hexadecimal runs, at most depth + 1 if depth is given."""

    def general(part: Column) -> Column:
        return (
            F.when(part.rlike("^[0-9]+$"), "{n}")
            .when(part.rlike("^[0-9a-fA-F-]{12,}$"), "{x}")
            .otherwise(F.regexp_replace(part, "[0-9]+", "#"))
        )

    parts = F.transform(F.array_remove(F.split(path, "/"), ""), general)
    if depth is None:
        return parts
    head = F.slice(parts, 1, depth)
    return F.when(F.size(parts) > depth, F.concat(head, F.array(F.lit("**")))).otherwise(head)


def _prefix(level: int, column: str = "template") -> Column:
    return F.slice(column, 1, level)


def _alike(labelled: Column, bad: Column, all_labelled: Column, all_bad: Column, z: float) -> Column:
    """Whether a node's share of bad labels does not differ from that of its siblings, which with it sum to `all`."""
    others = F.greatest(all_labelled - labelled, F.lit(0))
    other_bad = F.greatest(all_bad - bad, F.lit(0))
    pooled = all_bad / F.greatest(all_labelled, F.lit(1))
    gap = F.abs(bad / F.greatest(labelled, F.lit(1)) - other_bad / F.greatest(others, F.lit(1)))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(labelled, F.lit(1)) + 1 / F.greatest(others, F.lit(1))))
    return (labelled == 0) | (others == 0) | (gap <= error * z)


def _starred(rows: DataFrame, level: int, z: float) -> DataFrame:
    """Segments at this level become `*`, but for those whose labels tell them from their siblings, and for only children."""
    rows = rows.withColumns({"prefix": F.array_join(_prefix(level), "/"), "child": F.get("template", F.lit(level))})
    sums = [F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")]
    each = landed(rows.where(F.col("child").isNotNull()).groupBy("host", "prefix", "child").agg(*sums), "url_children")
    places = each.groupBy("host", "prefix").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
    )
    places = broadcast_if_small(landed(places.where(F.col("kinds") > 1), "url_places"), SMALL)
    alike = _alike(F.col("labelled"), F.col("bad"), F.col("all_labelled"), F.col("all_bad"), z)
    merged = joined(each, places, ["host", "prefix"], "inner").where(alike)
    merged = landed(merged.select("host", "prefix", "child", F.lit(True).alias("merged")), "url_merged")
    if merged.isEmpty():
        return rows.drop("prefix", "child")
    rows = joined(rows, broadcast_if_small(merged, SMALL), ["host", "prefix", "child"])
    star = F.concat(_prefix(level), F.array(F.lit("*")), F.slice("template", F.lit(level + 2), F.size("template")))
    rows = rows.withColumn("template", F.when(F.col("merged"), star).otherwise(F.col("template")))
    return landed(rows.drop("prefix", "child", "merged"), "url_starred")


def templates(shapes: DataFrame, depth: int = DEPTH, z: float = Z) -> DataFrame:
    """Adds each shape's template: its segments, with `*` for siblings that their labels do not tell apart.

    Below `depth` segments, `**` stands for all that follows a node whose labels are all good, all bad or none, since
    nothing below it can differ, and segments without a branch between them are one.
    """
    rows = shapes.withColumn("template", F.col("shape"))
    if "labelled" not in rows.columns:
        rows = rows.withColumns({"labelled": F.lit(0), "bad": F.lit(0)})
    for level in range(depth):
        rows = _starred(rows, level, z)
    level, rows = depth, rows.withColumn("closed", F.lit(False))
    while True:
        rows = landed(_closed(rows, level), "url_closed")
        if rows.where(~F.col("closed") & (F.size("template") > level)).isEmpty():
            return rows.drop("closed")
        ended = rows.where("closed")
        rows = _starred(_chained(rows.where("NOT closed"), level), level, z).unionByName(ended)
        level += 1


def _chained(rows: DataFrame, level: int) -> DataFrame:
    """Segments from this level on that all rows below a node share become one, so a long path is few levels."""
    rows = rows.withColumns({"prefix": F.array_join(_prefix(level), "/"), "rest": F.slice("template", level + 1, F.size("template"))})
    # What the first and the last of some arrays share, all of them share.
    ends = rows.where(F.size("rest") > 0).groupBy("host", "prefix").agg(F.min("rest").alias("first"), F.max("rest").alias("last"))
    same = F.zip_with("first", "last", lambda a, b: a.eqNullSafe(b))
    until = F.array_position(same, False).cast("int")
    shared = F.when(until > 0, until - 1).otherwise(F.size("first"))
    chains = landed(ends.select("host", "prefix", shared.alias("shared")).where("shared > 1"), "url_chains")
    if chains.isEmpty():
        return rows.drop("prefix", "rest")
    rows = joined(rows, broadcast_if_small(chains, SMALL), ["host", "prefix"])
    chain = F.array(F.array_join(F.slice("rest", 1, F.col("shared")), "/"))
    whole = F.concat(_prefix(level), chain, F.slice("rest", F.col("shared") + 1, F.size("rest")))
    template = F.when(F.col("shared").isNotNull() & (F.size("rest") > 0), whole).otherwise(F.col("template"))
    return rows.withColumn("template", template).drop("prefix", "rest", "shared")


def _closed(rows: DataFrame, level: int) -> DataFrame:
    """Rows that go on below level under a node whose labels there are of one kind or none end in `**`."""
    rows = rows.withColumn("prefix", F.array_join(_prefix(level), "/"))
    below = ~F.col("closed") & (F.size("template") > level)
    mixed = rows.where(below).groupBy("host", "prefix").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    mixed = mixed.where((F.col("bad") > 0) & (F.col("bad") < F.col("labelled"))).select("host", "prefix", F.lit(True).alias("mixed"))
    rows = joined(rows, broadcast_if_small(landed(mixed, "url_mixed"), SMALL), ["host", "prefix"])
    ends = below & F.col("mixed").isNull()
    end = F.concat(_prefix(level), F.array(F.lit("**")))
    rows = rows.withColumns({"template": F.when(ends, end).otherwise(F.col("template")), "closed": F.col("closed") | ends})
    return rows.drop("prefix", "mixed")


def estimates(rows: DataFrame, z: float = Z, weight: float = WEIGHT) -> DataFrame:
    """Adds each shape's estimate, the smoothed share of bad labels of its template's node."""
    root = rows.agg(F.sum("labelled"), F.sum("bad"), F.max(F.size("template"))).first()
    labelled, bad, deepest = (int(x or 0) for x in root)
    rows, above, nodes = rows.withColumn("node", F.lit("")), None, None
    top = {"parent_labelled": labelled, "parent_bad": bad, "estimate": bad / max(labelled, 1)}
    for level in range(-1, deepest):
        # level -1 is the host; below it the first segments of the template
        name = F.concat_ws("/", F.lit("h:"), "host", F.array_join(_prefix(level + 1), "/"))
        deep = F.size("template") > level
        step = rows.where(deep).groupBy("node", name.alias("next")).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        # the root is one row, so its values need no join
        step = step.withColumns({k: F.lit(v) for k, v in top.items()}) if above is None else joined(step, above, ["node"])
        alike = _alike(F.col("labelled"), F.col("bad"), F.col("parent_labelled"), F.col("parent_bad"), z)
        own = (F.col("bad") + F.col("estimate") * weight) / (F.col("labelled") + weight)
        step = step.select(
            F.col("next").alias("node"),
            F.col("labelled").alias("parent_labelled"),
            F.col("bad").alias("parent_bad"),
            F.when(alike, F.col("estimate")).otherwise(own).alias("estimate"),
        )
        # a longer chain of joins is cut by a written table at each level
        above = step if level < DEPTH else landed(step, "url_nodes")
        nodes = above if nodes is None else nodes.unionByName(above)
        rows = rows.withColumn("node", F.when(deep, name).otherwise(F.col("node")))
    return joined(rows, nodes.select("node", "estimate"), ["node"]).drop("node")


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules=RULES,
    url: str = "url",
    page_id: str = "page_id",
    depth: int = DEPTH,
    z: float = Z,
    weight: float = WEIGHT,
    reject: float = REJECT,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page. `labels` has page_id and bad (boolean)."""
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("shape", shape_of(F.col("path"), None))
    known = labels.groupBy("page_id").agg(F.count("bad").alias("labelled"), F.count_if("bad").alias("bad"))
    counted = rows.select("page_id", "host", "shape").join(known, "page_id", "left").groupBy("host", "shape")
    shapes = landed(
        counted.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("labelled"), F.lit(0)).alias("labelled"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        ),
        "url_shapes",
    )
    tree = estimates(templates(shapes, depth, z), z, weight)
    bad = tree.where(F.col("estimate") >= reject).select("host", F.array_join("shape", "/").alias("key"), F.lit(True).alias("rejected"))
    bad = broadcast_if_small(landed(bad, "url_rejected"), SMALL)
    out = joined(rows.withColumn("key", F.array_join("shape", "/")), bad, ["host", "key"])
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("rejected"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, learned).alias("verdict"))
