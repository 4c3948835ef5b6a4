"""Sequence, quality and CIGAR expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CIGAR_OP = r"(\d+)([MIDNSHP=X])"


def revcomp(seq: Column) -> Column:
    """Reverse complement, case kept."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def phred(qual: Column) -> Column:
    """Array of quality values (offset 33)."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def bases(seq: Column) -> Column:
    """Array of single bases."""
    return F.filter(F.split(seq, ""), lambda c: c != "")


def mask_low_quality(seq: Column, qual: Column, least: int = 20, mask: str = "N") -> Column:
    """Bases of quality below ``least`` become ``mask``."""
    pairs = F.zip_with(bases(seq), phred(qual), lambda b, q: F.when(q < least, F.lit(mask)).otherwise(b))
    return F.array_join(pairs, "")


def strip_clips(cigar: Column) -> Column:
    """Without one leading and one trailing S or H operation."""
    return F.regexp_replace(F.regexp_replace(cigar, r"^\d+[SH]", ""), r"\d+[SH]$", "")


def leading_soft_clip(cigar: Column) -> Column:
    """Length of a leading soft clip, 0 if there is none."""
    return F.coalesce(F.try_to_number(F.regexp_extract(cigar, r"^(\d+)S", 1), F.lit("9999999999")).cast("int"), F.lit(0))


def cigar_lengths(cigar: Column) -> Column:
    """Array of operation lengths."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(CIGAR_OP), F.lit(1)), lambda x: x.cast("int"))


def cigar_ops(cigar: Column) -> Column:
    """Array of operation letters."""
    return F.regexp_extract_all(cigar, F.lit(CIGAR_OP), F.lit(2))


def array_sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b)


def aligned_parts(rows: DataFrame) -> DataFrame:
    """One row for each stretch of aligned bases of ``rows`` (pos, seq, qual, raw_cigar, ...), with its own pos, seq and qual."""
    ops = F.arrays_zip(cigar_ops(F.col("raw_cigar")).alias("kind"), cigar_lengths(F.col("raw_cigar")).alias("n"))
    part = "array<struct<ref:int,read:int,n:int>>"
    start = F.struct(F.lit(0).alias("ref"), F.lit(0).alias("read"), F.array().cast(part).alias("parts"))

    def step(a: Column, o: Column) -> Column:
        on_both = o["kind"].isin("M", "=", "X")
        ref = a["ref"] + F.when(on_both | o["kind"].isin("D", "N"), o["n"]).otherwise(0)
        read = a["read"] + F.when(on_both | o["kind"].isin("I", "S"), o["n"]).otherwise(0)
        here = F.array(F.struct(a["ref"].alias("ref"), a["read"].alias("read"), o["n"].alias("n")))
        parts = F.when(on_both, F.concat(a["parts"], here)).otherwise(a["parts"])
        return F.struct(ref.alias("ref"), read.alias("read"), parts.alias("parts"))

    parts = rows.withColumn("_p", F.explode(F.aggregate(ops, start, step, lambda a: a["parts"])))
    cut = lambda c: F.col(c).substr(F.col("_p.read") + 1, F.col("_p.n"))
    return parts.withColumns({"pos": F.col("pos") + F.col("_p.ref"), "seq": cut("seq"), "qual": cut("qual")}).drop("_p")
