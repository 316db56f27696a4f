"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` over twice as many partitions as there are cores, for Python work that costs far more than moving its rows."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *by)
