"""CSV readers: a lenient one by header name, a strict one with a quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..once import with_column_once
from .contract import COLUMNS, HEADER_PREFIX

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}

# A whole quoted field (doubled quotes are adjacent quoted runs) is cut down to a pair of quotes, which no
# other field can begin with. Possessive, so a long field does not make the matcher recurse.
_QUOTED_FIELD = '(^|,)(?:"[^"]*+")++'
_BAD_QUOTING = '(^|,)(?:"(?!")|""\\s*+[^,\\s])'


def read_permissive(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] = COLUMNS
) -> DataFrame:
    """Headered CSV with the given columns in order, all text; short rows are padded and long ones cut.

    Every file's own header must name the columns in that order, else reading it fails.
    """
    schema = ", ".join(f"`{name}` STRING" for name in columns)
    options = {**CSV_OPTIONS, "header": True, "enforceSchema": False}
    return spark.read.schema(schema).options(**options).csv(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines in column `value`, blank ones included."""
    return spark.read.text(path)


def _mask_quoted(line: Column) -> Column:
    masked = F.regexp_replace(line, _QUOTED_FIELD, '$1""')
    return F.when(line.contains('"'), masked).otherwise(line)


def _line_fault(line: Column, masked: Column, width: int) -> Column:
    commas = F.length(masked) - F.length(F.replace(masked, F.lit(","), F.lit("")))
    return (
        F.when(line.startswith(HEADER_PREFIX), "header")
        .when((line == "") | (line.contains('"') & masked.rlike(_BAD_QUOTING)), "bad_csv")
        .when(commas != width - 1, "wrong_column_count")
    )


def classify_lines(lines: DataFrame, width: int = len(COLUMNS)) -> DataFrame:
    """value and `fault`: header, bad_csv, wrong_column_count, or NULL for a usable record.

    Headers are recognised on any line, so concatenated or split files are fine.
    """
    line = F.col("value")
    masked = with_column_once(lines.select("value"), "masked", _mask_quoted(line))
    judged = with_column_once(masked, "fault", _line_fault(line, F.col("masked"), width))
    return judged.drop("masked")


def parse_lines(classified: DataFrame) -> DataFrame:
    """`fault` and the 24 text columns, which are NULL where there is a fault."""
    schema = ", ".join(f"`{name}` STRING" for name in COLUMNS)
    record = F.when(F.col("fault").isNull(), F.from_csv(F.col("value"), schema, CSV_OPTIONS))
    return with_column_once(classified, "record", record).select("fault", "record.*")


def read_strict(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Usable records, and the quarantined lines with their fault."""
    classified = classify_lines(read_lines(spark, path))
    good = parse_lines(classified).filter(F.col("fault").isNull()).drop("fault")
    rejected = classified.filter(F.col("fault").isin("bad_csv", "wrong_column_count"))
    return good, rejected
