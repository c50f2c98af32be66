"""The corpus pipeline: each stage applies one operator of ``voxloom.llm`` to what is left.

Quality classifier -> SimHash near-duplicates -> benchmark decontamination -> secret scans ->
packing. A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the shared
folder and read again as the next one's ``docs``. All but the last return the columns of documents,
and further ones of any name where ``docs`` has them.

In every stage null texts count as empty, very long texts are read whole, and an empty table gives
no rows. What a stage does with null ids, repeated rows and ties is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import decontamination, packing, quality, secrets, simhash
from voxloom.llm.components import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Rows are judged by their text alone, so repeated rows and rows without an id stay or go alike.
    Without labels of both classes every score is 0.5 and all stay.
    """
    return quality.keep(docs, quality.learn(docs, _table(spark, sf_dir, "labels")))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates.

    Of several texts under that id the one with the smallest hash stays, of repeated rows one. Empty
    texts are near-duplicates of each other. Rows without an id stay.
    """
    return simhash.keep_first(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Rows are told apart by id and text, repeated rows are judged alike, ids may be null. Items of the
    benchmark that are null or empty leak nowhere.
    """
    return decontamination.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind; equal rows alike, with ids or without."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence; each row is a document of its own."""
    return packing.pack(docs)


STAGES = [("quality", keep_quality), ("near_duplicates", keep_first), ("decontamination", keep_uncontaminated),
          ("secrets", without_secrets), ("packing", packed)]
#: Models and tokenizers are beyond SQL; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
