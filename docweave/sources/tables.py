"""Parquet tables of a data folder (the store the jobs read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Tables whose rows carry long texts: per-row work on them is heavy.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")

#: Optional setting for small tables written as one row group, which a scan cannot split: deal
#: text tables to this many partitions after the scan.  Unset by default; a table of many row
#: groups needs no such shuffle.
SCAN_PARTITIONS = "spark.docweave.scanPartitions"


def read_table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one parquet table; selecting columns here lets the scan prune."""
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    parts = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(parts)) if parts and name in TEXT_TABLES else df
