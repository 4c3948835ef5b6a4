"""Quality control of reads: quantiles of qualities, composition, tables over whole reads, duplication, contaminants.

Reads are rows (sample, seq, qual); every table is keyed by sample. Bases are counted in Arrow batches before a shuffle, so no base is a row.
Rows of null sequence or quality count nowhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editlake.functions import seq as q
from editlake.operators.targeted import _spread
from editlake.scratch import materialize

#: Lower ends of the duplication levels that hold more than one number of copies.
LEVELS = (10, 50, 100, 500, 1000, 5000, 10000)
QUANTILES = (10, 25, 50, 75, 90)
#: Places of a contaminant that are cut into words together.
PIECE = 64


def known(reads: DataFrame) -> DataFrame:
    return reads.filter("seq is not null and qual is not null").select("sample", "seq", "qual")


def level_counts(reads: DataFrame) -> DataFrame:
    """(sample, cycle, base, quality, n): how many bases of a kind and quality each cycle has."""
    sample = reads.schema["sample"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).dictionary_encode(null_encoding="encode")
            row, at, base, quality = _spread(batch.column(1), batch.column(2))
            code = ((np.asarray(names.indices)[row].astype(np.int64) << 32 | at) << 8 | base) << 8 | quality
            keys, n = np.unique(code, return_counts=True)
            columns = [names.dictionary.take(pa.array(keys >> 48)), pa.array((keys >> 16 & ((1 << 32) - 1)) + 1)]
            columns += [pa.array([chr(k) for k in (keys >> 8 & 255).tolist()]), pa.array((keys & 255).astype(np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["sample", "cycle", "base", "quality", "n"])

    rows = known(reads).mapInArrow(run, f"sample {sample}, cycle bigint, base string, quality int, n bigint")
    return rows.groupBy("sample", "cycle", "base", "quality").agg(F.sum("n").alias("n"))


def cycle_quantiles(levels: DataFrame, percents: tuple[int, ...] = QUANTILES) -> DataFrame:
    """(sample, cycle, reads, p10, p25, p50, p75, p90) of :func:`level_counts`: the least quality that so many percent of the cycle's reads,
    rounded down, don't exceed."""
    rows = levels.groupBy("sample", "cycle", "quality").agg(F.sum("n").alias("n"))
    cycle = Window.partitionBy("sample", "cycle")  # as many rows as there are qualities
    rows = rows.withColumn("below", F.sum("n").over(cycle.orderBy("quality"))).withColumn("all", F.sum("n").over(cycle))
    picks = [F.min(F.when(F.col("below") >= F.floor(F.col("all") * p / 100), F.col("quality"))).alias(f"p{p}") for p in percents]
    return rows.groupBy("sample", "cycle").agg(F.max("all").alias("reads"), *picks)


def base_content(levels: DataFrame) -> DataFrame:
    """(sample, cycle, a, c, g, t, other) of :func:`level_counts`: shares of the cycle's bases."""
    base = F.upper("base")
    share = lambda *of: F.sum(F.when(base.isin(*of), F.col("n")).otherwise(0)) / F.sum("n")
    return levels.groupBy("sample", "cycle").agg(*[share(x.upper()).alias(x) for x in "acgt"], (1 - share("A", "C", "G", "T")).alias("other"))


def read_tables(reads: DataFrame) -> DataFrame:
    """(sample, measure, value, n): how many reads have a length, a whole percentage of G and C (halves up), a mean quality (rounded down).

    An empty read has a length and nothing else.
    """
    rows, size = known(reads), F.length("seq")
    # 2 * (G or C) * 100 / (2 * size), halves up, in whole numbers
    gc = (size - F.length(F.translate("seq", "GCgc", ""))).cast("bigint")
    score = F.aggregate(F.split("qual", ""), F.lit(0).cast("bigint"), lambda a, x: a + F.when(x == "", 0).otherwise(F.ascii(x) - 33))
    full = lambda x: F.when(size > 0, x)
    rows = rows.select("sample", F.map_from_arrays(
        F.array(F.lit("length"), F.lit("gc"), F.lit("quality")),
        F.array(size.cast("bigint"), full(F.floor((200 * gc + size) / (2 * size))), full(F.floor(score / size))),
    ).alias("m"))
    return rows.select("sample", F.explode("m").alias("measure", "value")).filter("value is not null").groupBy("sample", "measure", "value").agg(F.count(F.lit(1)).alias("n"))


def duplication_levels(reads: DataFrame, longest: int = 75, prefix: int = 50) -> DataFrame:
    """(sample, level, sequences, reads, sequence_share, read_share): different sequences by their number of copies.

    Levels are 1 to 9 copies and from each of :data:`LEVELS` on; reads beyond ``longest`` bases count by their first ``prefix``. All reads are
    counted, none is estimated. Copies are counted with partial sums, so that a sequence that is a third of all reads is no task's burden.
    """
    seq = F.when(F.length("seq") > longest, F.substring("seq", 1, prefix)).otherwise(F.col("seq"))
    copies = known(reads).groupBy("sample", seq.alias("seq")).agg(F.count(F.lit(1)).alias("n"))
    level = F.when(F.col("n") < LEVELS[0], F.col("n").cast("int"))
    for least, beyond in zip(LEVELS, [*LEVELS[1:], None], strict=True):
        level = level.otherwise(least) if beyond is None else level.when(F.col("n") < beyond, least)
    rows = copies.groupBy("sample", level.alias("level")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("reads"))
    whole = Window.partitionBy("sample")  # at most sixteen rows
    return rows.select(
        "*", (F.col("sequences") / F.sum("sequences").over(whole)).alias("sequence_share"), (F.col("reads") / F.sum("reads").over(whole)).alias("read_share")
    )


def contaminant_hits(found: DataFrame, contaminants: DataFrame, least: int = 20, errors: int = 1, shortest: int = 8) -> DataFrame:
    """(sample, seq, contaminant, strand, size, wrong): the best hit of each sequence of ``found`` (sample, seq, ...) that has one.

    A hit is a gap-free stretch of at least ``least`` bases shared with a sequence of ``contaminants`` (name, sequence) or its reverse
    complement (strand -), with at most ``errors`` mismatches; a sequence of ``shortest`` to ``least`` - 1 bases must occur as a whole. The best is the
    longest, then the one of fewest mismatches, the first name, and + before -. Mismatches at a stretch's ends count to it: it ends where
    a further one would be too many.

    Every such stretch has ``least // (errors + 1)`` bases without a mismatch, so sequences and contaminants are joined on words of that
    length, and only the diagonals found are looked at.
    """
    word = least // (errors + 1)
    items = contaminants.filter("sequence is not null").select(F.col("name").alias("contaminant"), F.upper("sequence").alias("c"))
    items = items.withColumn("strand", F.lit("+")).unionByName(items.withColumn("c", q.revcomp(F.col("c"))).withColumn("strand", F.lit("-")))
    items = materialize(items.distinct().withColumn("id", F.md5("c")), "contaminants")  # read by four steps
    # Words are cut from pieces: a place in a whole sequence is found from its beginning, and every row of a word would carry it.
    starts = F.when(F.length("c") > 0, F.sequence(F.lit(1), F.length("c"), F.lit(PIECE))).otherwise(F.array().cast("array<int>"))
    parts = items.withColumn("at", F.explode(starts)).select("contaminant", "strand", "id", "at", F.col("c").substr(F.col("at"), F.lit(PIECE + least - 1)).alias("p"))
    found = materialize(found, "found")  # likewise
    seqs = found.filter("seq is not null").select(F.upper("seq").alias("s"), F.col("seq").alias("written")).distinct()
    places = lambda x, k: F.when(F.length(x) >= k, F.sequence(F.lit(1), F.length(x) - k + 1)).otherwise(F.array().cast("array<int>"))
    cut = lambda x, at, k: F.col(x).substr(F.col(at), F.lit(k))

    # Diagonals: the sequence's place less the contaminant's.
    left = seqs.filter(F.length("s") >= least).withColumn("i", F.explode(places(F.col("s"), word))).withColumn("w", cut("s", "i", word))
    begins = lambda k: F.slice(places(F.col("p"), k), 1, PIECE)
    right = parts.withColumn("j", F.explode(begins(word))).select("contaminant", "strand", "id", (F.col("at") + F.col("j") - 1).alias("j"), cut("p", "j", word).alias("w"))
    lines = left.join(right, "w").select("s", "written", "contaminant", "strand", "id", (F.col("i") - F.col("j")).alias("d")).distinct()
    lines = lines.join(items, ["contaminant", "strand", "id"])
    lo, hi = F.greatest(F.lit(1), F.col("d") + 1), F.least(F.length("s"), F.length("c") + F.col("d"))
    differ = F.filter(F.sequence(lo, hi), lambda i: F.col("s").substr(i, F.lit(1)) != F.col("c").substr(i - F.col("d"), F.lit(1)))
    lines = lines.withColumn("ends", F.concat(F.array(lo - 1), differ, F.array(hi + 1)))
    ends, many = F.col("ends"), F.size("ends") - errors - 1
    # A stretch lies between two ends that have ``errors`` others between them, or is the whole diagonal.
    runs = F.when(many >= 1, F.transform(F.sequence(F.lit(0), many - 1), lambda k: F.struct(
        (ends[k + errors + 1] - ends[k] - 1).alias("size"), F.lit(-errors).alias("right"))
    )).otherwise(F.array(F.struct((hi - lo + 1).alias("size"), (2 - F.size("ends")).alias("right"))))
    long = lines.withColumn("top", F.array_max(runs)).select("written", "contaminant", "strand", F.col("top.size").alias("size"), (-F.col("top.right")).alias("wrong"))

    sizes = F.sequence(F.lit(shortest), F.lit(least - 1))
    short = parts.withColumn("k", F.explode(sizes)).withColumn("i", F.explode(begins(F.col("k")))).select("contaminant", "strand", F.col("p").substr(F.col("i"), F.col("k")).alias("s")).distinct()
    short = seqs.filter(F.length("s").between(shortest, least - 1)).join(short, "s").select("written", "contaminant", "strand", F.length("s").alias("size"), F.lit(0).alias("wrong"))

    rows = long.filter(F.col("size") >= least).unionByName(short)
    key = F.struct(-F.col("size"), F.col("wrong"), F.col("contaminant"), F.col("strand"))
    best = rows.groupBy("written").agg(F.min(key).alias("b")).select(
        F.col("written").alias("seq"), F.col("b.contaminant").alias("contaminant"), F.col("b.strand").alias("strand"), (-F.col("b.col1")).alias("size"), F.col("b.wrong").alias("wrong")
    )
    return found.select("sample", "seq").distinct().join(best, "seq").select("sample", "seq", "contaminant", "strand", "size", "wrong")
