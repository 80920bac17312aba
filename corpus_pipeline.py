"""Corpus cleaning pipeline: toxicity, exact dedup, near dedup, decontamination, packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes each
stage's result as Parquet to the shared folder and rereads it as the next
one's input, so a lost executor never costs more than one stage.  All stages but the
last return rows of ``docs`` with all their columns, whatever their names.

Defined results of every stage: null texts count as empty, texts of any length are read whole, an empty
table gives an empty result, and columns besides doc_id and text are passed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from docweave.llm.work import saved

#: Near duplicates of the pipeline are judged on five-word shingles.
SHINGLE = 5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score below 0.5).

    Null ids and ids without a label are scored but not learned from; repeated rows are judged each;
    without labels of both kinds nothing is rejected."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, keep_rows=True).filter("predicted = 0").select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (A-Z lower-cased): the one with the largest id.

    A null id ranks lowest; of rows that repeat id and text one stays; empty texts are one group."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id.

    Rows with a null id and texts without words always stay; rows that repeat an id are kept or dropped together."""
    return near_dedup.drop_near_copies(docs, k=SHINGLE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage (a window of 0.8 weighted shingle similarity).

    Rows are judged by their own text, also where ids repeat or are null; null and empty items match nothing."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of training sequences.

    An empty text is one piece, the closing id; rows that repeat an id are packed as documents of their own."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned scores, near-duplicate classes and packing are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for step, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if step < len(STAGES) - 1:
            docs = saved(docs)
    return docs
