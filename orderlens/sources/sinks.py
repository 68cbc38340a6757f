"""Writers. Output is replaced if it exists; one single file only on request."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SETTING = "spark.checkpoint.dir"
LOCAL_SHARED = "/tmp/checkpoints"


def write_text(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Comma-joined lines without a header, in key order when asked.

    The order holds across part files (a range-partitioned sort), not just within one.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.write.mode("overwrite").csv(path, header=False)


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Parquet; `single_file` passes the result through one task, for small reports only.

    A repartition leaves the stages before it as wide as they are; coalesce would not.
    """
    (df.repartition(1) if single_file else df).write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str], order_by: Sequence[str] = ()) -> None:
    """Parquet in a folder for each value of `by`; of an earlier output only folders that the rows have values for are replaced.

    Rows of one value are sorted within each of its files. They are dealt by the value, and values with many rows into several
    files (adaptive execution splits and merges what is rebalanced). Values keep their files until the job commits. Blank and
    missing values would share a folder, so blank ones are refused. No rows replace nothing.
    """
    for name in by:
        if df.schema[name].dataType.typeName() == "string":
            blank = F.raise_error(F.lit(f"A blank {name} cannot name a folder")).cast("string")
            df = df.withColumn(name, F.when(F.col(name) == "", blank).otherwise(F.col(name)))
    dealt = df.hint("rebalance", *by).sortWithinPartitions(*by, *order_by)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What `write_partitions` wrote, with the types it was written with; a filter on the folders' values prunes them."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def land(df: DataFrame, path: str) -> DataFrame:
    """Write once as Parquet and read back.

    For text input that several scans will use: later reads are column-pruned
    and the lineage back to the text is cut.
    """
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder; every call gives another one.

    A local session without that setting gets `LOCAL_SHARED` as its setting: driver and executors share one
    disk there.
    """
    shared = spark.conf.get(SETTING, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"Set {SETTING} to a folder all executors share.")
        shared = LOCAL_SHARED
        spark.conf.set(SETTING, shared)
    return f"{shared.rstrip('/')}/orderlens/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
