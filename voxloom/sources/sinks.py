"""Sinks. Parquet is the form between stages; CSV is for people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.operators.dedup import keep_first
from voxloom.operators.shaping import union_by_name
from voxloom.schema import empty_frame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), replace: str = "table") -> str:
    """Overwriting Parquet sink, optionally partitioned for pruning.

    With ``replace="partitions"`` only the partitions that have rows here are overwritten: a rerun
    of one source leaves the files of the others untouched. Rows keep their task: each task writes
    one file per partition value, so a source that holds a third of the rows is written by many tasks.
    """
    mode = {"table": "static", "partitions": "dynamic"}[replace]
    if mode == "dynamic" and not partition_by:
        raise ValueError("only a partitioned table can be replaced by partitions")
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_new(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Write unless the target exists: a labelled sheet is never overwritten."""
    writer = df.write.mode("ignore")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)
    return path


def existing_partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column below a folder, as the file system lists them."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return sorted(utils.unescapePathName(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def write_new_sheets(df: DataFrame, path: str, sheet: str) -> list[str]:
    """Write the sheets (values of a column) that are not there yet; labelled ones are never touched.

    Returns the sheets that were kept. A sheet is a partition of Parquet files.
    """
    kept = existing_partitions(df.sparkSession, path, sheet)
    new = df.filter(~F.col(sheet).cast("string").isin(kept)) if kept else df
    new.write.mode("append").partitionBy(sheet).parquet(path)
    return kept


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(text, translated): the last answer for each text; no row before the first run."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "text string, translated string")
    rows = spark.read.schema("text string, translated string, run long").parquet(path)
    return (keep_first(rows.withColumn("_age", -F.col("run")), ["text"], ["_age", "translated"])
            .select("text", "translated"))


def add_to_cache(answers: DataFrame, path: str) -> int:
    """Upsert of (text, translated) into a cache: rows of a new run, of which readers see the last per text.

    Nothing is rewritten, so a run that fails leaves the cache as it was. A null translation says
    that the text was asked for in vain. Returns the number of the run.
    """
    spark = answers.sparkSession
    runs = existing_partitions(spark, path, "run")
    run = max(map(int, runs), default=0) + 1
    answers.select("text", "translated").withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(path)
    return run


def write_quarantine(records: DataFrame, path: str) -> str:
    """Malformed records (file, reason, record) of a run, added to those of earlier runs."""
    records.write.mode("append").partitionBy("reason").parquet(path)
    return path


def results_or_empty(spark: SparkSession, frames: list[DataFrame],
                     schema: T.StructType) -> DataFrame:
    """All result frames in one typed table, header-only when there is none."""
    return union_by_name([empty_frame(spark, schema), *frames])
