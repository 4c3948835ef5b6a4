"""Registered queries of the tables behind the plots, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from editlake.operators import plots as p
from editlake.operators import targeted as t

from . import bindings as b
from .screening import BF_SQL, Screen
from .targeted import A, CONTEXT_SQL, EDIT_SQL, READ_SQL, edits, indel_reads, insertions, stage_summary

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {EDIT_SQL} SELECT sample, unnest(['Wt', 'Template-based', 'Indels', 'Delins', 'Insertions', 'Deletions', 'Dels inframe', 'Dels outframe', 'Ins inframe', 'Ins outframe']) AS class,
  unnest(['', '', '', 'Indels', 'Indels', 'Indels', 'Deletions', 'Deletions', 'Insertions', 'Insertions']) AS parent,
  unnest([wt, template_based, delins + ins_inframe + ins_outframe + dels_inframe + dels_outframe, delins, ins_inframe + ins_outframe, dels_inframe + dels_outframe, dels_inframe, dels_outframe, ins_inframe, ins_outframe]) AS n FROM edits""")
def edit_sunburst(spark, sf_dir):
    return p.edit_hierarchy(edits(spark, sf_dir))


@query(f"""WITH {b.READS_SQL}, s AS (SELECT sample, 'raw-reads' AS class, '' AS parent, count(*) AS n FROM reads GROUP BY 1 UNION ALL SELECT sample, 'quality-filtered-reads', 'raw-reads', count(*) FROM reads WHERE len(seq) >= 80 GROUP BY 1
  UNION ALL SELECT sample, 'reads-with-adapters', 'quality-filtered-reads', count(*) FROM reads WHERE len(seq) >= 80 AND instr(seq, 'ACGT') > 0 GROUP BY 1) SELECT * FROM s""")
def reads_sunburst(spark, sf_dir):
    return p.stage_hierarchy(stage_summary(spark, sf_dir), ["raw-reads", "quality-filtered-reads", "reads-with-adapters"])


@query(f"""WITH {CONTEXT_SQL}, c AS (SELECT sample, start, length, ins_nt, count(*) AS n FROM context GROUP BY ALL)
SELECT *, round(n * 100.0e0 / sum(n) OVER (PARTITION BY sample), 6) AS percent FROM c""")
def insertion_locations(spark, sf_dir):
    return p.location_size(insertions(spark, sf_dir), "ins_nt").withColumn("percent", F.round("percent", 6))


HOMOLOGY_SQL = READ_SQL + f""",
hd AS (SELECT DISTINCT start, length, substr('{A}', start, length) AS gone, substr('{A}', 1, start - 1) AS l, substr('{A}', start + length) AS r FROM geno WHERE modification = 'del'),
hh AS (SELECT *, len(list_filter(range(1, least(len(l), length) + 1), lambda k: right(l, k) = right(gone, k))) AS n, len(list_filter(range(1, least(len(r), length) + 1), lambda k: left(r, k) = left(gone, k))) AS m FROM hd),
hc AS (SELECT *, greatest(n - CASE WHEN n = len(l) THEN 1 ELSE 0 END, 0) AS n2, greatest(m - CASE WHEN m = len(r) THEN 1 ELSE 0 END, 0) AS m2 FROM hh),
hom AS (SELECT start, length, CASE WHEN n2 = 0 AND m2 = 0 THEN 'NHEJ' WHEN m2 > n2 THEN left(r, m2) ELSE right(l, n2) END AS pattern FROM hc)"""


@query(f"""WITH {HOMOLOGY_SQL}, x AS (SELECT sample, g.start, g.length, CASE WHEN length(pattern) = 1 THEN 'NHEJ' ELSE pattern END AS pattern, sum(freq) AS n FROM geno g JOIN hom USING (start, length) WHERE modification = 'del' GROUP BY ALL)
SELECT sample, start, length, pattern, CAST(n AS BIGINT) AS n, round(n * 100.0e0 / sum(n) OVER (PARTITION BY sample), 6) AS percent FROM x""")
def deletion_locations(spark, sf_dir):
    """Deletions by place, size and the homology at their junction; single bases count as none."""
    dels = indel_reads(spark, sf_dir).filter("modification = 'del'")
    found = p.junction_class(t.homology(dels.select("start", "length").distinct(), A))
    return p.location_size(dels.join(found, ["start", "length"]), "pattern").withColumn("percent", F.round("percent", 6))


@query(f"""WITH {READ_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY freq DESC, modification, start, length) AS k FROM geno WHERE modification IN ('del', 'ins')),
al AS (SELECT sample, CAST(k AS INTEGER) AS k, CASE WHEN modification = 'del' THEN substr('{A}', 1, start - 1) || repeat('-', length) || substr('{A}', start + length) ELSE substr('{A}', 1, start - 1) || repeat('N', length) || substr('{A}', start) END AS allele FROM o WHERE k <= 10),
bs AS (SELECT sample, k, CAST(i AS INTEGER) AS pos, substr(allele, i, 1) AS base FROM al, range(1, 500) r(i) WHERE i <= len(allele))
SELECT sample, k, pos, {', '.join(f"CASE WHEN base = '{c}' THEN 0.99999e0 ELSE 0.00001e0 END AS {c}" for c in 'ACGT')} FROM bs""")
def allele_logo(spark, sf_dir):
    return p.allele_logo(t.alleles(t.genotypes(indel_reads(spark, sf_dir)), A), 1)


@query(f"""WITH {BF_SQL}, h AS (SELECT least(CAST(floor((bf + 100) / 4) AS BIGINT), 49) AS bin, count(*) AS n FROM bf WHERE bf BETWEEN -100 AND 100 GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, -100.0e0 + i * 4 AS low, -96.0e0 + i * 4 AS high, coalesce(n, 0) AS n FROM range(50) r(i) LEFT JOIN h ON bin = i""")
def bf_histogram(spark, sf_dir):
    return p.histogram(Screen(spark, sf_dir).bf(), "bf")


PARTS_SQL = "parts AS (SELECT p_brand || '_' || p_type || '_' || p_partkey AS gene, CAST(p_size - 25 AS DOUBLE) AS score, CAST(1 + p_partkey % 97 AS DOUBLE) / 100 AS fdr FROM part)"


def gene_scores(spark, sf_dir):
    """Scores with ties and FDRs, a part a gene."""
    text = F.concat_ws("_", "p_brand", "p_type", F.col("p_partkey").cast("string"))
    return b.table(spark, sf_dir, "part").select(text.alias("gene"), (F.col("p_size") - 25).cast("double").alias("score"), ((1 + F.col("p_partkey") % 97).cast("double") / 100).alias("fdr"))


@query(f"WITH {PARTS_SQL} SELECT gene, score, round(-log10(fdr), 6) AS log_fdr, row_number() OVER (PARTITION BY score > 0 ORDER BY fdr, abs(score) DESC, gene) <= 5 AS labelled FROM parts")
def volcano_table(spark, sf_dir):
    return p.volcano(gene_scores(spark, sf_dir), "score", "fdr").withColumn("log_fdr", F.round("log_fdr", 6))


@query(f"""WITH {PARTS_SQL}, r AS (SELECT gene, score, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0 AS rank FROM parts)
SELECT *, CASE WHEN row_number() OVER (ORDER BY rank, gene) <= 5 THEN 'bottom' WHEN row_number() OVER (ORDER BY rank DESC, gene) <= 5 THEN 'top' END AS side FROM r""")
def rank_table(spark, sf_dir):
    return p.score_ranks(gene_scores(spark, sf_dir), "score")


CUT = 60
G20 = A[CUT - 17 : CUT + 3]


@query(f"""WITH x AS (SELECT s_suppkey, CAST(s_suppkey % 4 AS BIGINT) AS off, CAST(2 + s_suppkey % 5 AS BIGINT) AS length FROM supplier)
SELECT s_suppkey, CASE WHEN {CUT} - off + length >= {CUT} AND s_suppkey % 3 <> 0 THEN {CUT + 1} ELSE {CUT} - off END AS start FROM x""")
def insertion_reanchor(spark, sf_dir):
    """Insertions reported up to three bases before the cut; two of three reads have the guide's bases on either side of the cut."""
    off, size = (F.col("s_suppkey") % 4).cast("int"), (2 + F.col("s_suppkey") % 5).cast("int")
    start = F.lit(CUT) - off
    true = F.concat(F.lit(A[:CUT]), F.repeat(F.lit("T"), size), F.lit(A[CUT:]))
    other = F.repeat(F.lit("T"), F.length(true).cast("int"))
    cigar = F.concat((start - 1).cast("string"), F.lit("M"), size.cast("string"), F.lit("I50M"))
    rows = b.table(spark, sf_dir, "supplier").select(
        "s_suppkey", start.alias("start"), size.alias("length"), F.when(F.col("s_suppkey") % 3 == 0, other).otherwise(true).alias("seq"), cigar.alias("raw_cigar")
    )
    return p.reanchor_insertions(rows, CUT, G20).select("s_suppkey", "start")
