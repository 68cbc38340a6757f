"""Tables written between jobs, below the cluster's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.sinks import work_folder


def landed(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once and read again; cuts the lineage at files that outlive an executor."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
