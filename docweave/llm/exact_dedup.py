"""Operator 1, exact dedup by content sort (DataFrame functions only).

Texts (A-Z lower-cased, null as empty) are range-partitioned with sampled
splitters, sorted externally so equal texts are adjacent, and neighbouring
full texts are compared (a window over the sort order; the exchange and the
sort are shared).  Splitters are sampled on a short key, the text's first 64
characters and its hash, so what the driver samples does not grow with text
length; the sort and the comparisons always use whole texts.

Hot texts: a first pass counts hashes with map-side partial aggregation; a
hash with more than 1/1000 of the rows (so at most 1000 of them, which is what
is broadcast) is cut into slices of about that size by id.  Slices are deduplicated
like any other group, and the slice winners (a few thousand rows) are compared
once more.

Defined results: the row with the largest id stays; a null id ranks lowest;
of rows repeated with the same id and text exactly one stays; null and empty
texts form one group; an empty table gives an empty result; other columns are
untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import ascii_lower, saved

HOT_SHARE = 1000
LEAST_HOT = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    With ``carry`` the rows that stay also hold the whole input row in ``row``."""
    source = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("raw"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []),
    )
    limit = max(LEAST_HOT, docs.count() // HOT_SHARE)
    # Equal normalised texts have equal lower(text), so this count never misses a hot text.
    key = F.xxhash64(F.lower("raw"))
    hot = (source.groupBy(key.alias("hot_key")).agg(F.count("*").alias("copies"))
           .filter(F.col("copies") > limit))
    slices = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("copies") / limit)), F.lit(0))
    keyed = (source.withColumn("hot_key", key)
             .join(F.broadcast(hot), "hot_key", "left")
             .withColumn("norm", ascii_lower(F.col("raw")))
             .withColumn("slice", slices)
             .withColumn("is_hot", F.col("copies").isNotNull())
             .withColumn("head", F.substring("norm", 1, 64))
             .drop("copies", "raw"))
    ranged = keyed.repartitionByRange("head", "hot_key", "slice")
    run = Window.partitionBy("head", "norm", "hot_key", "slice").orderBy(F.col("doc_id").desc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.col("place") == 1
    decided = (ranged
               .withColumn("place", F.row_number().over(run))
               .withColumn("slice_keep", F.first("doc_id").over(whole))
               .withColumn("slice_size", F.count("*").over(whole)))
    level1 = saved(decided.select(
        "doc_id", "is_hot", (F.col("place") == 1).alias("leads"), "slice_keep", "slice_size",
        F.unhex(F.sha2(F.col("norm"), 256)).alias("sha"),
        F.when(first & F.col("is_hot"), F.col("norm")).alias("norm"),
        *([F.when(first, F.col("row")).alias("row")] if carry else [])))
    # Slice winners of the hot texts: at most a few slices of each of <= 1000 texts.
    merged = (level1.filter("is_hot AND leads")
              .groupBy("norm", "sha").agg(F.max("slice_keep").alias("hot_keep"), F.sum("slice_size").alias("hot_size"))
              .select("sha", "hot_keep", "hot_size", F.lit(True).alias("merged")))
    keep = F.when(F.col("merged"), F.col("hot_keep")).otherwise(F.col("slice_keep"))
    return (level1.drop("norm").join(F.broadcast(merged), "sha", "left")
            .withColumn("keep_id", keep)
            .select("doc_id", "keep_id",
                    F.coalesce("hot_size", "slice_size").alias("group_size"),
                    (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256"),
                    *(["row"] if carry else [])))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    return exact_groups(docs, id_col, text_col, carry=True).filter("kept").select("row.*")


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
