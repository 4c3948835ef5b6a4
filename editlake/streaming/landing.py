"""Guide counts kept up to date from a folder where read files land. An extra: the batch operators don't need it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READS = "sample string, read_id bigint, seq string, qual string"


def read_landing(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of reads from Parquet files as they come."""
    return spark.readStream.schema(READS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def running_counts(reads: DataFrame, library: DataFrame, offset: int, length: int) -> DataFrame:
    """(guide, gene, sample, count) of a stream of reads; the state is one row for each guide and sample."""
    cut = reads.select("sample", F.substring("seq", offset + 1, length).alias("sequence"))
    return cut.join(library, "sequence").groupBy("guide", "gene", "sample").count()


def start(counts: DataFrame, name: str, checkpoint: str):
    """Keep the counts in a table in memory, complete after each batch."""
    return counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()
