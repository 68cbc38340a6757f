"""Quality rules with thresholds that follow each language and source.

Every document gets four signals as whole numbers. A sketch keeps, for each (language, source) and signal,
how many documents fall into each log-linear bin (64 to the octave, so a quantile is at most 1/64 too low).
Bin counts add up, so sketches of parts, days or groups merge by a sum; a third of all rows in one source
is summed in every task before anything moves. Quartiles of the sketch give the thresholds:

    upper = q75 + reach * max(q75 - q25, slack)         lower = q25 - reach * max(q75 - q25, slack)

No group decides its tolerance alone. Its spread q75 - q25 is held against that of its language, where each source
weighs as many documents as it has, `least` at most. Where it is wider, the limits are no further than

    anchor +- (reach + 1) * max(wider level's spread, slack)

from q25 for the rates, which have upper limits only, and from the median for word length. So junk up to three quarters of a
source (half, for word length) does not widen its limits, and a source that is uniformly unlike the others keeps limits about
itself. A source that has its language to itself is held, but for word length, against all groups.

A (language, source) with fewer than `least` documents takes the merged sketch of its language, and a
language with fewer that of all documents. The documents are then joined with the thresholds.

Built-in functions only. The repeated-window count compares 64-bit hashes of three words within one document.

Null text: no words, so the base rule rejects it. Texts are measured whole, however long. Null language or source is a group of its own. Repeated rows
count as often as they occur. Tables without rows give none. Columns of the results replace columns of their names;
names that begin with two underscores are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .native import BLANK, BLANKS, broadcast_if_small, joined, let, words_of
from .scratch import landed

#: Signal, slack of its spread.
SLACK = {"symbol_rate": 50, "dup_line_rate": 150, "repeat_rate": 100, "word_length": 40}
REACH = 3
LEAST = 50
SUB_BITS = 6
SYMBOLS = "#*$%&|<>"
#: Rows of thresholds up to which they are sent to every task.
SMALL = 200_000

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more."""

    def starts(windows: Column) -> Column:
        def repeated(pairs: Column) -> Column:
            def hit(pair: Column, k: Column) -> Column:
                here = pair["h"]
                before = (k > 0) & (F.get(pairs, k - 1)["h"] == here)
                return before | F.coalesce(F.get(pairs, k + 1)["h"] == here, F.lit(False))

            return F.transform(F.filter(pairs, hit), lambda pair: pair["at"])

        ordered = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.array().cast("array<int>")).otherwise(
            let(ordered, repeated)
        )

    def windows(hashes: Column) -> Column:
        three = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0)))
        return F.transform(three, lambda h, k: F.xxhash64(h, F.get(hashes, k + 1), F.get(hashes, k + 2)))

    at = let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), starts)
    return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures as long columns."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumn("__text", whole).withColumns({"__words": words_of(F.col("__text")), "__lines": lines})
    chars = F.length("__text")
    found = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.translate("__text", BLANKS, "")),
        "n_symbols": chars - F.length(F.translate("__text", SYMBOLS, "")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": _repeat_words(F.col("__words")),
    }
    return split.withColumns({k: v.cast("long") for k, v in found.items()}).drop("__text", "__words", "__lines")


def signals() -> dict[str, Column]:
    """Whole-number signals: per thousand words or lines, and hundredths of a character."""

    def rate(part: str, whole: str, times: int, more: int = 0) -> Column:
        return F.floor(F.col(part) * times / F.greatest(F.col(whole) + more, F.lit(1))).cast("long")

    return {
        "symbol_rate": rate("n_symbols", "n_words", 1000),
        "dup_line_rate": rate("n_dup_lines", "n_lines", 1000, more=4),
        "repeat_rate": rate("n_repeat_words", "n_words", 1000),
        "word_length": rate("word_chars", "n_words", 100),
    }


def _bin(value: Column) -> Column:
    """Lower end of the value's bin: its leading seven bits."""
    drop = F.greatest(F.length(F.bin(value)) - (SUB_BITS + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketch(rows: DataFrame, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """keys, signal, bin and n, the number of documents. `rows` has the measures."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), _bin(v).alias("bin")) for k, v in signals().items()]))
    return rows.select(*keys, each.alias("s")).groupBy(*keys, "s.signal", "s.bin").agg(F.count(F.lit(1)).alias("n"))


def merge(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows that the given sketches hold."""
    every = sketches[0]
    for one in sketches[1:]:
        every = every.unionByName(one)
    return every.groupBy(*[c for c in every.columns if c != "n"]).agg(F.sum("n").alias("n"))


def quartiles(bins: DataFrame, keys: list[str]) -> DataFrame:
    """keys, signal, n, q25, q50 and q75 of a sketch, as lower ends of bins."""
    group = Window.partitionBy(*keys, "signal")
    upto = F.sum("n").over(group.orderBy("bin"))
    total = F.sum("n").over(group)
    ranked = bins.select(*keys, "signal", "bin", upto.alias("upto"), total.alias("total"))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("bin"))).alias(f"q{q}")
    return ranked.groupBy(*keys, "signal").agg(F.max("total").alias("n"), at(25), at(50), at(75))


def spreads(bins: DataFrame, own: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, signal and bound, the spread at the wider level, null where there is none. `own` has the groups' quartiles."""
    votes = lambda n: F.least(F.col(n), F.lit(least)).cast("long")
    total = F.sum("n").over(Window.partitionBy("lang", "source", "signal"))
    equal = bins.withColumn("total", total)
    # thousandths of a vote keep the sums whole
    equal = equal.withColumn("n", F.floor(F.col("n") * votes("total") * 1000 / F.col("total")).cast("long")).drop("total")
    spread = (F.col("q75") - F.col("q25")).alias
    by_lang = quartiles(merge(equal.drop("source")), ["lang"]).select("lang", "signal", spread("s1"))
    overall = quartiles(merge(equal.drop("lang", "source")), []).select("signal", spread("s2"))
    cast = own.groupBy("lang", "signal").agg(F.sum(votes("n")).alias("cast"))
    rows = joined(joined(joined(own, by_lang, ["lang", "signal"]), cast, ["lang", "signal"]), overall, ["signal"])
    others = F.col("cast") - votes("n") >= least
    bound = F.when(others, F.col("s1")).when(F.col("signal") != "word_length", F.col("s2"))
    return rows.select("lang", "source", "signal", bound.alias("bound"))


def thresholds(bins: DataFrame, least: int = LEAST, reach: int = REACH) -> DataFrame:
    """One row for each (lang, source): lower and upper limit of every signal. `bins` is a sketch by lang and source."""
    own = quartiles(bins, ["lang", "source"])
    by_lang = quartiles(merge(bins.drop("source")), ["lang"]).withColumnsRenamed({"n": "n1", "q25": "a1", "q75": "b1", "q50": "c1"})
    overall = quartiles(merge(bins.drop("lang", "source")), []).select(
        "signal", F.col("q25").alias("a2"), F.col("q75").alias("b2"), F.col("q50").alias("c2")
    )
    rows = joined(joined(own, by_lang, ["lang", "signal"]), overall, ["signal"])
    pick = lambda a, b, c: F.when(F.col("n") >= least, F.col(a)).when(F.col("n1") >= least, F.col(b)).otherwise(F.col(c))
    rows = rows.withColumns({"low": pick("q25", "a1", "a2"), "high": pick("q75", "b1", "b2"), "mid": pick("q50", "c1", "c2")})
    slack = F.element_at(F.create_map(*[F.lit(x) for pair in SLACK.items() for x in pair]), F.col("signal"))
    reached = F.greatest(F.col("high") - F.col("low"), slack.cast("long")) * reach
    rows = joined(rows, spreads(bins, own, least), ["lang", "source", "signal"])
    # null without a bound, which least and greatest pass over
    held = F.when(F.col("bound").isNotNull(), F.greatest(F.col("bound"), slack.cast("long")) * (reach + 1))
    anchor = F.when(F.col("signal") == "word_length", F.col("mid")).otherwise(F.col("low"))
    lower = F.greatest(F.col("low") - reached, anchor - held)
    rows = rows.withColumns({"lower": lower, "upper": F.least(F.col("high") + reached, anchor + held)})
    limits = []
    for name in SLACK:
        mine = F.col("signal") == name
        limits += [F.max(F.when(mine, F.col(x))).alias(f"__{name}_{x}") for x in ("lower", "upper")]
    return rows.groupBy("lang", "source").agg(*limits)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds base_failed and kept to rows with the measures."""
    out = joined(rows, broadcast_if_small(limits, SMALL), ["lang", "source"])
    values = signals()
    inside = F.lit(True)
    for name in ("symbol_rate", "dup_line_rate", "repeat_rate"):
        inside = inside & (values[name] <= F.col(f"__{name}_upper"))
    length = values["word_length"]
    inside = inside & length.between(F.col("__word_length_lower"), F.col("__word_length_upper"))
    out = out.withColumns({"base_failed": base_failed()}).withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
    return out.drop(*[f"__{name}_{x}" for name in SLACK for x in ("lower", "upper")])


def verdicts(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, lang, source, the measures, base_failed and kept for every document. Texts are read once."""
    rows = landed(measured(docs.select("doc_id", "lang", "source", text), text).drop(text), "quality_measures")
    return judged(rows, landed(thresholds(sketch(rows)), "quality_limits"))


def kept(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents, all their columns, that the rules keep. Texts are read twice and not shuffled.

    Writing them once with their measures would spare the second measuring, but Parquet writers of whole texts took 500 MB
    more of each executor's memory.
    """
    narrow = docs.select("lang", "source", text)
    limits = landed(thresholds(sketch(measured(narrow, text))), "quality_limits")
    return judged(measured(docs, text), limits).where("kept").select(*docs.columns)


ORACLE_SQL = f"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{BLANK}+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, words[pos], words[pos + 1], words[pos + 2]) AS times
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS pos FROM split WHERE len(words) > 2)
), repeats AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (
    SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS word FROM windows WHERE times > 1) GROUP BY doc_id
), measures AS (
  SELECT s.doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '{BLANK}', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN repeats r ON r.doc_id = s.doc_id
), rates AS (
  SELECT *, n_symbols * 1000 // greatest(n_words, 1) AS symbol_rate,
         n_dup_lines * 1000 // greatest(n_lines + 4, 1) AS dup_line_rate,
         n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_rate,
         word_chars * 100 // greatest(n_words, 1) AS word_length
  FROM measures
), bins AS (
  SELECT lang, source, signal, (x >> d) << d AS bin, count(*) AS n
  FROM (SELECT lang, source, signal, x, greatest(length(bin(x)) - {SUB_BITS + 1}, 0) AS d
        FROM rates UNPIVOT (x FOR signal IN (symbol_rate, dup_line_rate, repeat_rate, word_length)))
  GROUP BY ALL
), voted AS (
  SELECT lang, source, signal, bin, n * least(total, {LEAST}) * 1000 // total AS n
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, signal) AS total FROM bins)
), ranked AS (
  SELECT 0 AS level, lang, source, signal, bin, sum(n) AS n FROM bins GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, signal, bin, sum(n) FROM bins GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, signal, bin, sum(n) FROM bins GROUP BY ALL
  UNION ALL SELECT 3, lang, NULL, signal, bin, sum(n) FROM voted GROUP BY ALL
  UNION ALL SELECT 4, NULL, NULL, signal, bin, sum(n) FROM voted GROUP BY ALL
), quart AS (
  SELECT level, lang, source, signal, max(total) AS n,
         min(bin) FILTER (upto * 100 >= total * 25) AS q25, min(bin) FILTER (upto * 100 >= total * 50) AS q50,
         min(bin) FILTER (upto * 100 >= total * 75) AS q75
  FROM (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, signal ORDER BY bin) AS upto,
               sum(n) OVER (PARTITION BY level, lang, source, signal) AS total FROM ranked)
  GROUP BY level, lang, source, signal
), picked AS (
  SELECT a.lang, a.source, a.signal,
         CASE WHEN a.n >= {LEAST} THEN a.q25 WHEN b.n >= {LEAST} THEN b.q25 ELSE c.q25 END AS low,
         CASE WHEN a.n >= {LEAST} THEN a.q75 WHEN b.n >= {LEAST} THEN b.q75 ELSE c.q75 END AS high,
         CASE WHEN a.n >= {LEAST} THEN a.q50 WHEN b.n >= {LEAST} THEN b.q50 ELSE c.q50 END AS mid,
         CASE a.signal {" ".join(f"WHEN '{k}' THEN {v}" for k, v in SLACK.items())} END AS slack,
         CASE WHEN sum(least(a.n, {LEAST})) OVER (PARTITION BY a.lang, a.signal) - least(a.n, {LEAST}) >= {LEAST} THEN d.q75 - d.q25
              WHEN a.signal <> 'word_length' THEN e.q75 - e.q25 END AS bound
  FROM (SELECT * FROM quart WHERE level = 0) a
  JOIN (SELECT * FROM quart WHERE level = 1) b ON b.lang IS NOT DISTINCT FROM a.lang AND b.signal = a.signal
  JOIN (SELECT * FROM quart WHERE level = 2) c ON c.signal = a.signal
  JOIN (SELECT * FROM quart WHERE level = 3) d ON d.lang IS NOT DISTINCT FROM a.lang AND d.signal = a.signal
  JOIN (SELECT * FROM quart WHERE level = 4) e ON e.signal = a.signal
), held AS (
  SELECT *, CASE signal WHEN 'word_length' THEN mid ELSE low END AS anchor, {REACH} * greatest(high - low, slack) AS reached,
         CASE WHEN bound IS NOT NULL THEN {REACH + 1} * greatest(bound, slack) END AS held FROM picked
), limits AS (
  SELECT lang, source, signal, greatest(low - reached, anchor - held) AS lower, least(high + reached, anchor + held) AS upper FROM held
), failed AS (
  SELECT doc_id FROM (SELECT doc_id, lang, source, signal, x
                      FROM rates UNPIVOT (x FOR signal IN (symbol_rate, dup_line_rate, repeat_rate, word_length))) r
  JOIN limits l ON l.lang IS NOT DISTINCT FROM r.lang AND l.source IS NOT DISTINCT FROM r.source AND l.signal = r.signal
  WHERE x > upper OR (r.signal = 'word_length' AND x < lower)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM measures
"""
