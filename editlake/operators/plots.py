"""The tables behind the plots: hierarchies, indel locations and sizes, allele logos, volcano, ranks, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def edit_hierarchy(edits: DataFrame) -> DataFrame:
    """(sample, class, parent, n) of an edit summary: each class and the one that holds it, '' for the outermost."""
    c = F.col
    ins, dels = c("ins_inframe") + c("ins_outframe"), c("dels_inframe") + c("dels_outframe")
    rows = [
        ("Wt", "", c("wt")), ("Template-based", "", c("template_based")), ("Indels", "", c("delins") + ins + dels),
        ("Delins", "Indels", c("delins")), ("Insertions", "Indels", ins), ("Deletions", "Indels", dels),
        ("Dels inframe", "Deletions", c("dels_inframe")), ("Dels outframe", "Deletions", c("dels_outframe")),
        ("Ins inframe", "Insertions", c("ins_inframe")), ("Ins outframe", "Insertions", c("ins_outframe")),
    ]
    parts = F.array(*[F.struct(F.lit(name).alias("class"), F.lit(parent).alias("parent"), n.cast("bigint").alias("n")) for name, parent, n in rows])
    return edits.select("sample", F.explode(parts).alias("x")).select("sample", "x.*")


def stage_hierarchy(summary: DataFrame, stages: list[str]) -> DataFrame:
    """(sample, class, parent, n) of a stage summary (sample, stage, n): each stage inside the one before it, of those that have reads."""
    rows = summary.filter("n > 0").withColumn("k", F.array_position(F.array(*[F.lit(x) for x in stages]), F.col("stage"))).filter("k > 0")
    before = F.lag("stage", 1, "").over(Window.partitionBy("sample").orderBy("k"))
    return rows.select("sample", F.col("stage").alias("class"), before.alias("parent"), "n")


def location_size(rows: DataFrame, kind: str) -> DataFrame:
    """(sample, start, length, kind, n, percent): reads by place, size and a third column, and their share of the sample's."""
    n = rows.groupBy("sample", "start", "length", kind).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("sample")))


def junction_class(deletions: DataFrame) -> DataFrame:
    """``deletions`` with patterns of a single base called NHEJ: no homology to speak of."""
    return deletions.withColumn("pattern", F.when(F.length("pattern") == 1, "NHEJ").otherwise(F.col("pattern")))


def allele_logo(alleles: DataFrame, start: int, near: float = 0.00001) -> DataFrame:
    """(sample, k, pos, A, C, G, T): for each place of an allele 1 - ``near`` for its base and ``near`` for all others."""
    rows = alleles.select("sample", "k", F.posexplode(F.filter(F.split("allele", ""), lambda c: c != "")).alias("at", "base"))
    return rows.select("sample", "k", (F.col("at") + start).alias("pos"), *[F.when(F.col("base") == c, 1 - near).otherwise(near).alias(c) for c in "ACGT"])


def volcano(genes: DataFrame, score: str, fdr: str, top: int = 5) -> DataFrame:
    """(gene, score, log_fdr, labelled): -log10 of the FDR, and whether the gene is one of the ``top`` of least FDR of either sign."""
    rows = genes.select("gene", F.col(score).alias("score"), (-F.log10(F.col(fdr))).alias("log_fdr"))
    order = Window.partitionBy(F.col("score") > 0).orderBy(F.desc("log_fdr"), F.desc(F.abs("score")), "gene")  # one row a gene
    return rows.withColumn("labelled", F.row_number().over(order) <= top)


def score_ranks(genes: DataFrame, score: str, top: int = 5) -> DataFrame:
    """(gene, score, rank, side): the average rank of ties, and the ``top`` genes of either end."""
    w = Window.orderBy(score)
    tied = F.count(F.lit(1)).over(Window.partitionBy(score))
    rows = genes.select("gene", F.col(score).alias("score"), (F.rank().over(w) + (tied - 1) / 2.0).alias("rank"))
    first, last = Window.orderBy("rank", "gene"), Window.orderBy(F.desc("rank"), "gene")
    side = F.when(F.row_number().over(first) <= top, "bottom").when(F.row_number().over(last) <= top, "top")
    return rows.withColumn("side", side)


def histogram(rows: DataFrame, value: str, bins: int = 50, low: float = -100, high: float = 100) -> DataFrame:
    """(bin, low, high, n) of values between ``low`` and ``high``, the latter in the last bin; empty bins have 0."""
    width = (high - low) / bins
    at = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    n = rows.filter(F.col(value).between(low, high)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = every.join(n, "bin", "left").fillna(0, ["n"])
    return out.select("bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "n")


def reanchor_insertions(insertions: DataFrame, cut_site: int, guide: str) -> DataFrame:
    """Insertions (start, length, seq, raw_cigar, ...) that span the cut site and read there as the guide does, moved behind it.

    The read's three bases before and after the insertion, shifted to the cut, must be those of the guide around its cut (places
    15 to 17 and 18 to 20). Others stay as they are.
    """
    from editlake.operators.targeted import before_operation

    spans = (F.col("start") <= cut_site) & (F.col("start") + F.col("length") >= cut_site)
    at = before_operation("I") + cut_site - F.col("start") + 1
    cut = lambda first, n: F.col("seq").substr(first.cast("int"), n if not isinstance(n, int) else F.lit(n))
    fits = (cut(at - 2, 3) == guide[14:17]) & (cut(at + 1 + F.col("length"), 3) == guide[17:20])
    return insertions.withColumn("start", F.when(spans & fits, F.lit(cut_site + 1)).otherwise(F.col("start")).cast("bigint"))
