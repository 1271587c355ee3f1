"""Corpus pipeline over ``documents``: each stage is written as Parquet and read again by the next.

1. quality: documents that the quality classifier rejects go.
2. toxicity: documents that the toxicity classifier rejects go.
3. near_duplicates: one document of each group of near-copies stays.
4. packing: the rest becomes token sequences, one row for each piece of a document.

The classifiers learn from the tables ``documents`` and ``labels`` and judge what the stage is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import packing, quality, simhash, toxicity
from contrail.llm.staging import staged


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.score(docs, quality.train(*_labelled(spark, sf_dir)))
    return scored.filter("kept").select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, toxicity.train(*_labelled(spark, sf_dir)))
    return scored.filter(~F.col("is_toxic")).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("packing", packing_stage),
]

#: Trained models, hash-based near-duplicates and token packing can't be written as SQL;
#: tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
