"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a table in the shared folder; it goes when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above u is linked to the smallest of u and its neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """u and every neighbour below it are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def roots(links: DataFrame) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, with that smallest node.

    ``links`` has two comparable columns u, v. Each round is an aggregation to minima and a join on
    a key that is unique on one side; rounds grow with the logarithm of the longest chain. Nodes
    without links, and links to themselves, are not in the result.
    """
    links = written(links.filter("u <> v").distinct(), "links")
    state = None
    while True:
        links = written(_small_star(_large_star(links)).filter("u <> v").distinct(), "links")
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return links
        state = seen
