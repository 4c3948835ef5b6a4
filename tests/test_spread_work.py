"""Work that a small file holds much of is dealt out; a file's name is not searched in every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from editlake.operators import align
from editlake.sources import fastx


def test_votes_of_one_small_file_go_to_all_partitions(spark):
    rows = spark.range(0, 40, 1, 1).select(
        F.lit("x").alias("sample"), F.col("id").alias("cluster"), F.lit("ACGTTGCA").alias("seq"), F.lit("IIIIIIII").alias("qual"), F.lit("ACGTTGCA").alias("centre")
    )
    votes = align.quality_votes(rows)
    assert "RepartitionByExpression" in votes._jdf.queryExecution().optimizedPlan().toString()
    assert {x.consensus for x in align.consensus_by_quality(rows).collect()} == {"ACGTTGCA"}


def test_a_large_cluster_is_dealt_out(spark):
    rows = spark.range(400).select(
        F.lit("x").alias("sample"), F.lit("c").alias("cluster"), F.concat(F.lit("ACGT"), F.substring(F.md5(F.col("id").cast("string")), 1, 3)).alias("seq"),
        F.lit("IIIIIII").alias("qual"), F.lit("ACGTAAA").alias("centre"),
    )
    plan = align.quality_votes(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(seq" in plan


def test_sample_of_a_sam_file(spark, tmp_path):
    line = "r\t0\tref\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\n"
    for name in ("a.sam", "b.c.sam", "sam", "d.txt", ".sam"):
        (tmp_path / name).write_text(line)
        made = fastx.read_sam(spark, str(tmp_path / name)) if name != ".sam" else None
        if made is not None:
            assert [x.sample for x in made.collect()] == [name.removesuffix(".sam")]
            assert "regexp" not in made._jdf.queryExecution().optimizedPlan().toString()
    names = spark.createDataFrame([("a.sam.gz",), ("a.gz",), (".sam",), (".gz",), ("a.gz.sam",)], "x string")
    both = names.select(fastx._stem(F.col("x"), ".sam"), F.regexp_extract("x", r"([^/]+?)(\.sam)?(\.gz)?$", 1))
    assert all(a == b for a, b in both.collect())
