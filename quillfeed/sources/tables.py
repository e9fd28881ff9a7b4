"""SRC9: table scans (parquet by default; any format Spark reads)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read ``{base}/{name}.{fmt}``; column pruning and filters reach the scan."""
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}.{fmt}")
