"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contrail.session import scratch_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
