"""The document store on shared storage (S12): hash buckets, versions, one commit per write.

Rows lie in ``data/write=<id>/bucket=<b>/collection_name=<c>``; a row's bucket is a hash of its link, so
buckets are even, a move between collections stays in its bucket, and a batch concerns only the
buckets of its own links.  ``log`` is a small table of (version, bucket, write): the write
that holds a bucket's rows from that version on.  A write first puts the touched buckets into a new
folder and then appends one file to the log, which is the commit: until then readers see the
old version, and a run that failed leaves only an unread folder behind.  Older versions stay readable.
One writer at a time; ``buckets`` is fixed when the store is created.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from ..session import saved
from . import merge as M

BUCKETS = 64
LOG_SCHEMA = "version long, bucket int, write string, buckets int"


def bucket_of(buckets: int, link="link") -> Column:
    return F.pmod(F.xxhash64(link), F.lit(buckets)).cast("int")


def _log(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def current_version(spark: SparkSession, root: str) -> int:
    """The last committed version; 0 before the first one."""
    return _log(spark, root).agg(F.max("version")).first()[0] or 0


def bucket_count(spark: SparkSession, root: str) -> int:
    return _log(spark, root).agg(F.max("buckets")).first()[0]


def bucket_folders(spark: SparkSession, root: str, version: int | None = None, only: list[int] | None = None) -> list[str]:
    """Folders of a version's buckets (at most one per bucket)."""
    log = _log(spark, root)
    if version is not None:
        log = log.filter(F.col("version") <= version)
    if only is not None:
        log = log.filter(F.col("bucket").isin(only))
    rows = log.groupBy("bucket").agg(F.max_by("write", "version").alias("write")).collect()
    return [f"{root}/data/write={r.write}/bucket={r.bucket}" for r in rows if r.write is not None]


def read_store(spark: SparkSession, root: str, schema: TY.StructType, version: int | None = None,
               only: list[int] | None = None) -> DataFrame:
    """The store's rows (columns of ``schema``) at a version, of all buckets or ``only`` some."""
    folders = bucket_folders(spark, root, version, only)
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*folders)
    return found.select(*schema.names)


def _commit(spark: SparkSession, root: str, df: DataFrame, version: int, touched: list[int], buckets: int) -> None:
    """Write the new rows of the touched buckets, then append their log rows as one file."""
    write = f"v{version}-{uuid.uuid4().hex}"
    path = f"{root}/data/write={write}"
    (df.withColumn("bucket", bucket_of(buckets)).repartition("bucket").write
     .partitionBy("bucket", "collection_name").parquet(path))
    filled = {r.bucket for r in spark.read.schema("bucket int, link string").option("basePath", path).parquet(path).select("bucket").distinct().collect()}
    rows = [(version, b, write if b in filled else None, buckets) for b in touched]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")


def create_store(df: DataFrame, root: str, buckets: int = BUCKETS) -> int:
    """Write a first version with the rows of ``df`` (link, collection_name, ...)."""
    _commit(df.sparkSession, root, df, 1, list(range(buckets)), buckets)
    return 1


def _buckets_in(df: DataFrame, buckets: int) -> list[int]:
    return sorted(r.bucket for r in df.select(bucket_of(buckets).alias("bucket")).distinct().collect())  # at most ``buckets``


def merge_batch(spark: SparkSession, root: str, schema: TY.StructType, candidates: DataFrame, outcome: str | None = None,
                now: Column | None = None) -> tuple[int, DataFrame]:
    """M1 + M2 against the store; rewrites only buckets that change.  Returns (version, actions).

    Only the buckets of the batch's links are read.  A batch that changes nothing (a repeated run)
    writes nothing and keeps the version."""
    buckets = bucket_count(spark, root)
    offered = candidates if outcome is None else candidates.filter(F.col(outcome) == "candidate")
    stored = read_store(spark, root, schema, only=_buckets_in(offered, buckets))
    keys = candidates.select("seq", "link", "collection_name", *([outcome] if outcome else []))
    actions = saved(M.merge_actions(keys, stored, outcome=outcome))
    changed = actions.filter(F.col("action").isin("inserted", "moved"))
    touched = _buckets_in(changed, buckets)
    version = current_version(spark, root)
    if not touched:
        return version, actions
    state = M.new_state(stored.filter(bucket_of(buckets).isin(touched)), changed, candidates, now=now)
    _commit(spark, root, state.select(*[F.col(c.name).cast(c.dataType) for c in schema]), version + 1, touched, buckets)
    return version + 1, actions
