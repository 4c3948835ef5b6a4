"""Connected components of a distributed edge list, by alternating large-star and small-star steps.

Each step aggregates a vertex's smallest neighbour (combined before the shuffle) and joins it back, so a hub
with a third of all edges is split by the adaptive skew join. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import drop_table, write_table


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v). large: link larger neighbours to the smallest; else link smaller ones and the vertex."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``edges`` (u, v bigint, no nulls) but the smallest of each component.

    A component is named by its smallest vertex. No edges give no rows; self-loops are ignored.
    """
    return read_components(edges.sparkSession, write_components(edges))


def read_components(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_components` wrote."""
    return spark.read.parquet(path).select(F.col("u").alias("vertex"), F.col("v").alias("component"))


def write_components(edges: DataFrame) -> str:
    """The path of a table of the components, for callers that delete it."""
    spark = edges.sparkSession
    path = write_table(edges.filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        now = spark.read.parquet(path)
        new = now.agg(
            F.count("*"), F.sum(F.hash("u", "v").cast("bigint")), F.sum(F.xxhash64("u", "v") % 1000003)
        ).first()
        if new[0] == 0 or new == mark:
            break
        mark = new
        after = write_table(_step(_step(now, True), False), "edges")
        drop_table(spark, path)
        path = after
    return path
