"""Shared work folder and column hygiene for the text-corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the storage that driver and
    executors share.  Only a local session (tests) may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docweave-work-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/docweave-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Write once as Parquet to the shared folder and read back: cuts the lineage,
    survives lost executors, and lets several consumers read one result."""
    spark = df.sparkSession
    path = work_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Whole texts go to Python a few hundred rows and 16 MB at a time (Spark's default is 10,000 rows), and a
#: query's shuffle files go when it ends, not when the driver's garbage collection comes round.
LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256", "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
          "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def session_limits(spark: SparkSession) -> None:
    for key, value in LIMITS.items():
        spark.conf.set(key, value)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so no other column of the input can clash; null text is empty."""
    session_limits(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does it for pure ASCII texts (a fast path);
    other texts go through ``translate``, which leaves e.g. an upper-case E acute."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def crc_bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id counts as bucket 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))
