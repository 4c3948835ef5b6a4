"""Line dedup with DataFrame functions only.

Lines are keyed by their text without white space at the ends and with A-Z in lower case; keys of at least
``least`` characters are hashed (96 bits), the documents of each hash are counted (its smallest and largest
doc_id differ if there are two) and every line of such a key goes, but in the smallest doc_id. What is left
is put together by position.

Null and empty texts are one empty line. Rows that share a doc_id are one document when documents are counted, and
are told apart by their texts when lines are dropped. Rows without doc_id keep all their lines and count for none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import ascii_lower, materialize

BLANKS = " \t\n\x0b\x0c\r"


def line_dedup(
    docs: DataFrame, least: int = 10, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept (the text left over) and the columns of ``carry``."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *carry
    )
    lines = F.split("text", "\n", -1)
    exploded = rows.filter("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("own"), F.posexplode(lines).alias("at", "line")
    )
    # A key is no longer than its line, and lower-casing A-Z changes no length.
    keyed = exploded.filter(F.length("line") >= least).withColumn("line", F.btrim("line", F.lit(BLANKS)))
    keyed = keyed.filter(F.length("line") >= least).withColumn("line", ascii_lower(F.col("line")))
    keyed = keyed.select("doc_id", "own", "at", F.xxhash64("line").alias("k1"), F.hash("line").alias("k2"))
    shared = keyed.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    # Written, so that the join's two sides come straight from an exchange and a hot line's rows can be split.
    shared = materialize(shared.filter("least < most").drop("most"), "shared-lines")
    dropped = keyed.join(shared, ["k1", "k2"]).filter("doc_id <> least")
    dropped = dropped.groupBy("doc_id", "own").agg(F.collect_set("at").alias("gone"))
    joined = rows.withColumn("own", F.xxhash64("text")).join(dropped, ["doc_id", "own"], "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(places, lambda k: F.get(F.col("lines"), k)), "\n")
    joined = joined.select("doc_id", "text", *carry, "gone", F.split("text", "\n", -1).alias("lines"))
    return joined.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"),
        *carry,
    )
