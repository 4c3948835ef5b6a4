"""Registered queries of alignment, UMIs and fitted models; SQL where the binding allows an exact restatement."""

from __future__ import annotations

from pyspark.sql import functions as F

from editlake.functions import seq as q
from editlake.operators import align, models
from editlake.operators import screening as s
from editlake.scratch import materialize

from . import bindings as b
from .screening import NORM_SQL, changes, counts, rounded

QUERIES: dict = {}
SQL: dict[str, str] = {}
A = b.AMPLICON
UMI = align.UmiDesign("ACGTACGT", "TTGCATGC", "NNNNRYNN", "NNNNYRNN", adapter_length=60, max_error=2)


def query(sql: str | None = None):
    """Register a query under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH g AS (SELECT s_suppkey, substr('{A}', CAST(s_suppkey % {len(A) - 19} + 1 AS BIGINT), 20) AS guide FROM supplier)
SELECT s_suppkey, guide, 580.0e0 AS score, CAST(instr('{A}', guide) AS INTEGER) AS start, '20M' AS cigar FROM g""")
def pairwise_align(spark, sf_dir):
    """Guides cut from the amplicon, found again with a perfect score."""
    at = (F.col("s_suppkey") % (len(A) - 19) + 1).cast("int")
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", F.lit(A).substr(at, F.lit(20)).alias("guide"), F.lit(A).alias("amplicon"))
    return align.align_pairs(rows, "guide", "amplicon").select("s_suppkey", "guide", "score", "start", "cigar")


@query()
def read_align(spark, sf_dir):
    """Every read against the amplicon with the default profile."""
    rows = b.reads(spark, sf_dir).withColumn("amplicon", F.lit(A))
    return align.align_pairs(rows, "seq", "amplicon", "local", align.PROFILES["minimap2"]).select("sample", "read_id", "score", "start", "end", "cigar")


@query(f"""WITH {b.READS_SQL} SELECT read_id, seq AS merged FROM reads WHERE len(seq) > 60""")
def pear_merge(spark, sf_dir):
    """Mates of one beginning, the second the whole read and the first its beginning, put together again."""
    r = b.reads(spark, sf_dir).filter(F.length("seq") > 60)
    mates = r.select(
        "read_id", F.substring("seq", 1, 60).alias("seq1"), F.substring("qual", 1, 60).alias("qual1"),
        q.revcomp(F.col("seq")).alias("seq2"), F.reverse("qual").alias("qual2"),
    )
    return align.merge_pairs(mates, 40, level=1.0).select("read_id", "merged")  # some reads are one letter: no test holds for them


PAST = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"


@query(f"""SELECT s_suppkey, CASE WHEN s_suppkey % 7 > 0 THEN substr('{A}', CAST(1 + s_suppkey % 20 AS BIGINT), CAST(50 + s_suppkey % 40 AS BIGINT)) END AS merged FROM supplier""")
def pear_merge_tested(spark, sf_dir):
    """Mates of 70 bases of pieces of the amplicon, some shorter than a mate, put together again; mates of two pieces without overlap are not."""
    n = F.col("s_suppkey")
    piece = F.lit(A).substr((1 + n % 20).cast("int"), (50 + n % 40).cast("int"))
    left, right = F.concat(piece, F.lit(PAST)), F.concat(q.revcomp(piece), F.lit(PAST))
    apart = n % 7 == 0
    seq1 = F.when(apart, F.lit(A[:30])).otherwise(F.left(left, F.lit(70)))
    seq2 = F.when(apart, q.revcomp(F.lit(A[80:110]))).otherwise(F.left(right, F.lit(70)))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", seq1.alias("seq1"), seq2.alias("seq2"))
    rows = rows.withColumns({"qual1": F.repeat(F.lit("I"), F.length("seq1")), "qual2": F.repeat(F.lit("I"), F.length("seq2"))})
    return align.merge_pairs(rows).select("s_suppkey", "merged")


@query()
def umi_extract(spark, sf_dir):
    return align.extract_umis(b.reads(spark, sf_dir), UMI).drop("seq")


@query()
def umi_stats(spark, sf_dir):
    return align.umi_statistics(align.seek_both(b.reads(spark, sf_dir), UMI))


@query(f"""WITH {b.READS_SQL},
s56 AS (SELECT sample, substr(seq, 1, 56) AS umi, 2 * count(*) AS n FROM reads WHERE len(seq) >= 56 GROUP BY 1, 2),
s57 AS (SELECT sample, substr(seq, 1, 20) || 'A' || substr(seq, 21, 36) AS umi, count(*) AS n FROM reads WHERE len(seq) >= 56 GROUP BY 1, 2),
cut AS (SELECT *, substr(umi, 1, CAST(i AS BIGINT) - 1) || substr(umi, CAST(i AS BIGINT) + 1) AS less FROM s57, range(1, 58) r(i)),
near AS (SELECT c.sample, c.umi, c.n, s.umi AS cluster, row_number() OVER (PARTITION BY c.sample, c.umi ORDER BY s.n DESC, s.umi) AS k FROM cut c JOIN s56 s ON s.sample = c.sample AND s.umi = c.less)
SELECT sample, umi, umi AS cluster, n FROM s56 UNION ALL SELECT sample, umi, cluster, n FROM near WHERE k = 1""")
def umi_cluster(spark, sf_dir):
    """The first 56 bases of each read, twice, and once with a base inserted, which then joins the commonest UMI it is near to."""
    r = b.reads(spark, sf_dir).filter("length(seq) >= 56").groupBy("sample", F.substring("seq", 1, 56).alias("umi")).count()
    more = F.concat(F.substring("umi", 1, 20), F.lit("A"), F.substring("umi", 21, 36))
    both = F.array(F.struct("umi", (2 * F.col("count")).alias("n")), F.struct(more.alias("umi"), F.col("count").alias("n")))
    return align.cluster_umis(r.select("sample", F.explode(both).alias("u")).select("sample", "u.*"))


@query(f"""WITH {b.READS_SQL}, m AS (SELECT sample, substr(seq, 1, 2) || '_' || len(seq) AS cluster, seq AS s FROM reads),
v AS (SELECT sample, cluster, i, substr(s, i, 1) AS b, count(*) AS n FROM m, range(1, 151) r(i) WHERE i <= len(s) GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY sample, cluster, i ORDER BY n DESC, b) AS k FROM v)
SELECT sample, cluster, string_agg(b, '' ORDER BY i) AS consensus FROM w WHERE k = 1 GROUP BY sample, cluster""")
def consensus(spark, sf_dir):
    """Reads of one beginning and length are a cluster."""
    cluster = F.concat_ws("_", F.substring("seq", 1, 2), F.length("seq").cast("string"))
    return align.consensus(b.reads(spark, sf_dir).select("sample", cluster.alias("cluster"), F.col("seq").alias("projected")))


@query()
def consensus_aligned(spark, sf_dir):
    """Members laid over their cluster's commonest read before the vote."""
    rows = b.reads(spark, sf_dir).select("sample", F.substring("seq", 1, 3).alias("cluster"), "seq")
    return align.consensus(align.project(align.with_centre(rows), "seq", "centre"))


@query("""SELECT s_suppkey, 'TTGACCATTG' || repeat('GATC', CAST(1 + s_suppkey % 9 AS BIGINT)) AS consensus FROM supplier""")
def polish(spark, sf_dir):
    """Three true members and two with an error each, laid and voted on twice."""
    true = F.concat(F.lit("TTGACCATTG"), F.expr("repeat('GATC', cast(1 + s_suppkey % 9 as int))"))
    swap = F.concat(F.left(true, F.lit(3)), F.lit("C"), F.substring(true, 5, 100))
    gap = F.concat(F.left(true, F.lit(6)), F.substring(true, 8, 100))
    rows = b.table(spark, sf_dir, "supplier").select(F.lit("s").alias("sample"), F.col("s_suppkey").alias("cluster"), F.explode(F.array(true, true, true, swap, gap)).alias("seq"))
    return align.polish(rows).select(F.col("cluster").alias("s_suppkey"), "consensus")


@query("""SELECT s_suppkey, profile, CAST(bases * each_one AS DOUBLE) AS score, CAST(first_base AS INTEGER) AS start, CAST(first_base + bases - 1 AS INTEGER) AS "end", bases || 'M' AS cigar
FROM (SELECT s_suppkey, CAST(30 + s_suppkey % 40 AS BIGINT) AS bases, CAST(1 + s_suppkey % 37 AS BIGINT) AS first_base FROM supplier), (VALUES ('minimap2', 29), ('bwa', 1), ('bowtie2', 2)) v(profile, each_one)""")
def read_align_profiles(spark, sf_dir):
    """Stretches of the amplicon as reads, under each score profile."""
    size, at = (30 + F.col("s_suppkey") % 40).cast("int"), (1 + F.col("s_suppkey") % 37).cast("int")
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", F.lit(A).substr(at, size).alias("seq"), F.lit(A).alias("amplicon"))
    parts = None
    for profile in ("minimap2", "bwa", "bowtie2"):
        one = align.align_pairs(rows, "seq", "amplicon", "local", align.PROFILES[profile]).withColumn("profile", F.lit(profile))
        parts = one if parts is None else parts.unionByName(one)
    return parts.select("s_suppkey", "profile", "score", "start", "end", "cigar")


GAP_SQL = f"""g AS (SELECT s_suppkey, CAST(s_suppkey % 10 AS BIGINT) AS o, CAST(35 + s_suppkey % 11 AS BIGINT) AS p, CAST(1 + s_suppkey % 8 AS BIGINT) AS n, s_suppkey % 2 AS missing FROM supplier),
planted AS (SELECT *, p + 40 AS bases, CASE missing WHEN 1 THEN o + p + n + 40 ELSE o + p + 40 END AS last FROM g)"""


@query(f"""WITH {GAP_SQL} SELECT s_suppkey, profile, CAST(bases * each_one - opens - n * extends AS DOUBLE) AS score, CAST(o + 1 AS INTEGER) AS start, CAST(last AS INTEGER) AS "end"
FROM planted, (VALUES ('minimap2', 29, 25, 2), ('bwa', 1, 6, 1), ('bowtie2', 2, 5, 3)) v(profile, each_one, opens, extends)""")
def read_align_gaps(spark, sf_dir):
    """Stretches of the amplicon with 1 to 8 bases missing or more, under each score profile."""
    k, whole = F.col("s_suppkey"), F.lit(A)
    o, p, n = (k % 10).cast("int"), (35 + k % 11).cast("int"), (1 + k % 8).cast("int")
    left = whole.substr(o + 1, p)
    more = F.concat(left, F.lit("GCGCGCGC").substr(F.lit(1), n), whole.substr(o + p + 1, F.lit(40)))
    less = F.concat(left, whole.substr(o + p + n + 1, F.lit(40)))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 2 == 1, less).otherwise(more).alias("seq"), whole.alias("amplicon"))
    parts = None
    for profile in ("minimap2", "bwa", "bowtie2"):
        one = align.align_pairs(rows, "seq", "amplicon", "local", align.PROFILES[profile]).withColumn("profile", F.lit(profile))
        parts = one if parts is None else parts.unionByName(one)
    return parts.select("s_suppkey", "profile", "score", "start", "end")


#: The window of either strand with fewest mismatches.
SITE_SQL = f"""WITH ref AS (SELECT '{A}' AS a, reverse(translate('{A}', 'ACGT', 'TGCA')) AS z),
g AS (SELECT s_suppkey, substr(CASE WHEN s_suppkey % 2 = 0 THEN a ELSE z END, s_suppkey % {len(A) - 19} + 1, 20) AS whole, a, z FROM supplier, ref),
c AS (SELECT s_suppkey, a, z, left(whole, 9) || translate(substr(whole, 10, 1), 'ACGT', 'CGTA') || substr(whole, 11) AS guide FROM g),
w AS (SELECT s_suppkey, guide, i, hamming(substr(a, i, 20), guide) AS f, hamming(substr(z, i, 20), guide) AS r FROM c, range(1, {len(A) - 18}) t(i)),
m AS (SELECT s_suppkey, guide, min(f) AS f, arg_min(i, f) AS at_f, min(r) AS r, arg_min(i, r) AS at_r FROM w GROUP BY ALL)
SELECT s_suppkey, guide, CAST(CASE WHEN f < r THEN at_f + 20 - 3 - 1 ELSE {len(A)} - (at_r + 19) + 3 END AS INTEGER) AS cut_site FROM m"""


@query(SITE_SQL)
def cut_site_mismatch(spark, sf_dir):
    """Guides with one base changed cut where they align best."""
    at = (F.col("s_suppkey") % (len(A) - 19) + 1).cast("int")
    whole = F.when(F.col("s_suppkey") % 2 == 0, F.lit(A)).otherwise(q.revcomp(F.lit(A))).substr(at, F.lit(20))
    changed = F.concat(F.left(whole, F.lit(9)), F.translate(F.substring(whole, 10, 1), "ACGT", "CGTA"), F.substring(whole, 11, 10))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", changed.alias("guide"), F.lit(A).alias("reference"))
    return align.cut_sites(rows, "reference").drop("reference")


PLANT_SQL = """planted AS (SELECT s_suppkey, CAST(s_suppkey % 3 AS BIGINT) AS sample, CAST(4 + s_suppkey % 9 AS BIGINT) AS k, CAST(5 + s_suppkey % 7 AS BIGINT) AS m,
    CASE WHEN s_suppkey % 4 = 0 THEN '-' ELSE '+' END AS strand FROM supplier),
heads AS (SELECT *, left(repeat('TCT', 4), k) || 'A' || repeat('CTT', 5) AS h, reverse(left(repeat('GAA', 4), m) || 'C' || repeat('AGA', 6)) AS t FROM planted),
umis AS (SELECT s_suppkey, sample, strand, substr(h, k - 3, 8) AS f, substr(t, CAST(len(t) - m - 4 AS BIGINT), 8) AS r FROM heads),
extracted AS (SELECT *, CASE WHEN strand = '+' THEN f || r ELSE reverse(translate(r, 'ACGT', 'TGCA')) || reverse(translate(f, 'ACGT', 'TGCA')) END AS umi FROM umis)"""


def planted_reads(spark, sf_dir):
    """Reads with one place for each UMI: only there does a purine meet a pyrimidine."""
    k, m = (4 + F.col("s_suppkey") % 9).cast("int"), (5 + F.col("s_suppkey") % 7).cast("int")
    head = F.concat(F.left(F.lit("TCT" * 4), k), F.lit("A" + "CTT" * 5))
    tail = F.reverse(F.concat(F.left(F.lit("GAA" * 4), m), F.lit("C" + "AGA" * 6)))
    context = F.when(F.col("s_suppkey") % 4 == 0, F.lit(UMI.rev_context)).otherwise(F.lit(UMI.fwd_context))
    seq = F.concat(F.rpad(F.concat(head, context), 60, "T"), F.lit("GATTACA"), F.lpad(tail, 60, "A"))
    return b.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 3).cast("bigint").alias("sample"), F.col("s_suppkey").alias("read_id"), seq.alias("seq"))


@query(f"WITH {PLANT_SQL} SELECT s_suppkey AS read_id, sample, strand, f AS fwd_seq, r AS rev_seq, umi FROM extracted")
def umi_extract_planted(spark, sf_dir):
    made = align.extract_umis(planted_reads(spark, sf_dir), UMI)
    return made.filter("fwd_dist = 0 and rev_dist = 0").select("read_id", "sample", "strand", "fwd_seq", "rev_seq", "umi")


@query(f"""WITH {PLANT_SQL}, n AS (SELECT sample, count(*) FILTER (WHERE strand = '+') AS fwd, count(*) FILTER (WHERE strand = '-') AS rev FROM extracted GROUP BY sample)
SELECT sample, fwd, rev, CASE WHEN rev = 0 THEN -1.0e0 ELSE round(fwd / CAST(rev AS DOUBLE), 6) END AS ratio FROM n""")
def umi_stats_planted(spark, sf_dir):
    made = align.umi_statistics(align.extract_umis(planted_reads(spark, sf_dir), UMI))
    return made.select("sample", "fwd", "rev", F.round("ratio", 6).alias("ratio"))


@query(f"""WITH {PLANT_SQL}, n AS (SELECT sample, count(*) AS n_reads, count(*) FILTER (WHERE strand = '+' AND s_suppkey % 5 > 0) AS fwd, count(*) FILTER (WHERE strand = '-' AND s_suppkey % 5 > 0) AS rev FROM planted GROUP BY sample)
SELECT sample, n_reads, fwd, rev, CASE WHEN rev = 0 THEN -1.0e0 ELSE round(fwd / CAST(rev AS DOUBLE), 6) END AS ratio, fwd + rev AS both, round((fwd + rev) * 100.0e0 / n_reads, 6) AS pct FROM n""")
def umi_report(spark, sf_dir):
    """Planted reads, a fifth of them too short to be searched."""
    rows = planted_reads(spark, sf_dir)
    short = F.when(F.col("read_id") % 5 == 0, F.left("seq", F.lit(UMI.adapter_length))).otherwise(F.col("seq"))
    return rounded(rounded(align.extraction_report(rows.withColumn("seq", short), UMI), "ratio"), "pct")


@query(f"""SELECT s_suppkey, substr('{A}', 1, 30) || 'GATTACA' || substr('{A}', 41) AS template_reference FROM supplier""")
def template_reference(spark, sf_dir):
    """A template whose arms lie 10 bases apart in the amplicon, every other one on the reverse strand."""
    t = A[18:30] + "GATTACA" + A[40:52]
    template = F.when(F.col("s_suppkey") % 2 == 0, F.lit(t)).otherwise(q.revcomp(F.lit(t)))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", template.alias("template"), F.lit(A).alias("reference"))
    return align.splice_template(rows, "template", "reference").select("s_suppkey", "template_reference")


@query(f"SELECT s_suppkey, '{A}' AS oriented FROM supplier")
def orient_reference(spark, sf_dir):
    """The amplicon or its reverse complement, turned so that it carries the guide."""
    ref = F.when(F.col("s_suppkey") % 2 == 0, F.lit(A)).otherwise(q.revcomp(F.lit(A)))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", F.lit(b.GUIDE).alias("guide"), ref.alias("reference"))
    return align.orient_reference(rows, "guide", "reference").select("s_suppkey", "oriented")


RHO_SQL = "WITH " + NORM_SQL + """,
f AS (SELECT guide, gene, log2((avg(norm) FILTER (WHERE sample IN ('RF', 'RO')) + 5) / (avg(norm) FILTER (WHERE sample IN ('AF', 'AO')) + 5)) AS fc FROM norm GROUP BY guide, gene),
r AS (SELECT *, row_number() OVER (ORDER BY round(fc, 6), guide) / CAST(count(*) OVER () AS DOUBLE) AS u FROM f),
k AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY u) AS k, count(*) OVER (PARTITION BY gene) AS n FROM r),
t AS (SELECT gene, n, u, k, sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln(u) + (n - i) * ln(1 - u))) AS tail
  FROM k, range(1, 200) x(i) WHERE i BETWEEN k AND n AND u < 1 GROUP BY ALL)
SELECT k.gene, max(k.n) AS num, count(*) FILTER (WHERE k.u <= 0.25) AS good, round(coalesce(min(t.tail) FILTER (WHERE k.u <= 0.25), 1), 6) AS rho
FROM k LEFT JOIN t ON t.gene = k.gene AND t.k = k.k GROUP BY k.gene"""


@query(RHO_SQL)
def rra_rho(spark, sf_dir):
    fc = s.unpaired_changes(counts(spark, sf_dir), b.CONTROL, b.TREATMENT).withColumn("x", F.round("fc", 6))
    return rounded(models.rank_scores(fc, "x"), "rho")


@query()
def rra(spark, sf_dir):
    x = materialize(counts(spark, sf_dir), "counts")  # totals, their mean and the tests all read them
    return models.rra(x, b.CONTROL, b.TREATMENT)


@query(f"""SELECT s_suppkey, substr('{A}', CAST(1 + s_suppkey % 20 AS BIGINT), CAST(60 + s_suppkey % 30 AS BIGINT)) AS consensus FROM supplier""")
def consensus_quality(spark, sf_dir):
    """Four reads of a piece of the amplicon against a centre that lacks a base; three have one wrong base in common, of low quality."""
    n = F.col("s_suppkey")
    piece = F.lit(A).substr((1 + n % 20).cast("int"), (60 + n % 30).cast("int"))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", piece.alias("t"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    wrong = F.concat(F.substring("t", 1, 10), F.translate(F.substring("t", 11, 1), "ACGT", "CATG"), F.expr("substr(t, 12)"))
    marks = F.concat(F.repeat(F.lit("I"), F.lit(10)), F.lit("#"), F.repeat(F.lit("I"), F.length("t") - 11))
    rows = rows.select(
        F.lit("x").alias("sample"), F.col("s_suppkey").alias("cluster"), F.when(F.col("k") < 3, wrong).otherwise(F.col("t")).alias("seq"),
        F.when(F.col("k") < 3, marks).otherwise(F.repeat(F.lit("I"), F.length("t"))).alias("qual"),
        F.concat(F.substring("t", 1, 30), F.expr("substr(t, 32)")).alias("centre"),
    )
    return align.consensus_by_quality(rows).select(F.col("cluster").alias("s_suppkey"), "consensus")


ARMS = {"AF": [1, 0, 0], "AO": [1, 0, 0], "RF": [1, 1, 0], "RO": [1, 1, 0], "NF": [1, 0, 1], "NO": [1, 0, 1]}


@query()
def mle(spark, sf_dir):
    """Genes' effects with the guides' dispersions by the trend of all and efficiencies of their own."""
    x = counts(spark, sf_dir)
    design = {"AF": [1, 0], "AO": [1, 0], "RF": [1, 1], "RO": [1, 1]}
    return models.mle(x, design, s.median_ratio(x))


@query()
def mle_efficiency(spark, sf_dir):
    """How likely each guide works as its gene's others do."""
    x = counts(spark, sf_dir)
    return models.guide_efficiency(models.mle_fits(x, {"AF": [1, 0], "AO": [1, 0], "RF": [1, 1], "RO": [1, 1]}, s.median_ratio(x)))


def guide_effects(spark, sf_dir):
    """Counts plus one, of equal sizes, a guide a gene; its regression on two arms has a closed form. Counted once: sizes, the trend and the fits all read them."""
    x = counts(spark, sf_dir).filter(F.col("sample").isin(list(ARMS))).select("guide", F.col("guide").alias("gene"), "sample", (F.col("count") + 1).alias("count"))
    x = materialize(x, "guide-counts")
    sizes = x.select("sample").distinct().withColumn("size_factor", F.lit(1.0))
    return x, sizes


TREND_SQL = f"""{b.COUNTS_SQL},
x AS (SELECT guide, part_type, CASE left(sample, 1) WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS kind, count + 1.0e0 AS x FROM counts),
sets AS (SELECT guide, part_type, kind, count(*) AS n, avg(x) AS m, var_samp(x) AS v, sum(x) AS total FROM x GROUP BY ALL),
seen AS (SELECT 1 / m AS h, (v - m) / (m * m) AS y, (n - 1) * pow(m / (m + 10), 2) AS w FROM sets WHERE n > 1),
sums AS (SELECT sum(w) AS w, sum(w * h) AS wh, sum(w * y) AS wy, sum(w * h * h) AS whh, sum(w * h * y) AS why FROM seen),
line AS (SELECT *, coalesce((w * why - wh * wy) / nullif(w * whh - wh * wh, 0), 0) AS b FROM sums),
ends AS (SELECT *, (wy - b * wh) / w AS a FROM line),
kept AS (SELECT CASE WHEN b < 0 THEN wy / w WHEN a < 0 THEN 0 ELSE a END AS a, CASE WHEN b < 0 THEN 0 WHEN a < 0 THEN why / whh ELSE b END AS b FROM ends),
trend AS (SELECT guide, part_type, sum(total) / sum(n) AS mean, greatest(max(a) + max(b) / (sum(total) / sum(n)), 1e-4) AS dispersion FROM sets CROSS JOIN kept GROUP BY guide, part_type)"""


@query(f"WITH {TREND_SQL} SELECT guide, round(mean, 6) AS mean, round(dispersion, 8) AS dispersion FROM trend")
def mle_dispersion(spark, sf_dir):
    """Guides' dispersions by the trend over all guides' replicates."""
    x, sizes = guide_effects(spark, sf_dir)
    return models.dispersion_trend(x, ARMS, sizes).select("guide", F.round("mean", 6).alias("mean"), F.round("dispersion", 8).alias("dispersion"))


EFFECTS_SQL = f"""{TREND_SQL},
wide AS (SELECT guide, part_type, dispersion, max(m) FILTER (WHERE kind = 0) AS m0, max(n) FILTER (WHERE kind = 0) AS n0 FROM sets JOIN trend USING (guide, part_type) GROUP BY ALL),
info AS (SELECT w.*, s.kind AS coefficient, m, n0 * m0 / (1 + dispersion * m0) AS i0, n * m / (1 + dispersion * m) AS i1 FROM wide w JOIN sets s USING (guide, part_type) WHERE s.kind > 0),
effects AS (SELECT guide AS gene, part_type, coefficient, ln(m / m0) / ln(2.0e0) AS beta, ln(m / m0) * sqrt(i0 * i1 / (i0 + i1)) AS z FROM info)"""


@query(f"WITH {EFFECTS_SQL} SELECT gene, coefficient, round(beta, 6) AS beta, round(z, 6) AS z FROM effects")
def mle_closed_form(spark, sf_dir):
    """Effects in two arms at once, with dispersions by the trend."""
    x, sizes = guide_effects(spark, sf_dir)
    done = models.mle(x, ARMS, sizes, prior=None, ridge=0.0)
    return done.select("gene", "coefficient", F.round("beta", 6).alias("beta"), F.round("z", 6).alias("z"))


SELECTION_SQL = f"""WITH {EFFECTS_SQL},
arms AS (SELECT gene, part_type, round(max(beta) FILTER (WHERE coefficient = 2), 6) AS c, round(max(beta) FILTER (WHERE coefficient = 1), 6) AS t FROM effects GROUP BY ALL),
norm AS (SELECT abs(median(c)) AS mc, abs(median(t)) AS mt FROM arms WHERE part_type = '{b.ESSENTIAL}'),
scaled AS (SELECT gene, c / mc AS control, t / mt AS treatment, t / mt - c / mc AS diff FROM arms CROSS JOIN norm),
cuts AS (SELECT 2 * round(quantile_cont(abs(control), 0.68) / 0.994457883209753e0, 3) AS xc, 2 * round(quantile_cont(abs(treatment), 0.68) / 0.994457883209753e0, 3) AS yc,
         2 * round(quantile_cont(abs(diff), 0.68) / 0.994457883209753e0, 3) AS dc FROM scaled)
SELECT gene, round(control, 5) AS control, round(treatment, 5) AS treatment, round(diff, 5) AS diff, CASE WHEN diff > dc THEN 'up' WHEN diff < -dc THEN 'down' END AS selected,
  CASE WHEN control <= -xc AND abs(treatment) < yc AND diff > dc THEN 'midleft' WHEN control >= xc AND abs(treatment) < yc AND diff < -dc THEN 'midright'
       WHEN abs(control) < xc AND treatment >= yc AND diff > dc THEN 'topcenter' WHEN abs(control) < xc AND treatment <= -yc AND diff < -dc THEN 'bottomcenter' END AS square
FROM scaled CROSS JOIN cuts"""


@query(SELECTION_SQL)
def mle_selection(spark, sf_dir):
    """Guides whose effects differ between the arms, scaled by the essential ones."""
    x, sizes = guide_effects(spark, sf_dir)
    done = models.mle(x, ARMS, sizes, prior=None, ridge=0.0).withColumn("beta", F.round("beta", 6))
    essential = b.guides(spark, sf_dir).filter(F.col("part_type") == b.ESSENTIAL).select(F.col("guide").alias("gene"))
    out = models.beta_selection(done, 2, 1, essential)
    return out.select("gene", *[F.round(c, 5).alias(c) for c in ("control", "treatment", "diff")], "selected", "square")


@query()
def cnv_correct(spark, sf_dir):
    key = F.substring("guide", 2, 20).cast("bigint")
    rows = changes(spark, sf_dir).select("replicate", "guide", "gene", F.concat(F.lit("chr"), (key % 5).cast("string")).alias("chrom"), key.alias("pos"), "fc")
    return models.copy_number_correction(rows, by=["replicate"])


LEVELS_SQL = """part_rows AS (SELECT p_partkey AS pos, 'g' || p_partkey AS guide, p_brand AS gene, 'chr' || (p_partkey % 5) AS chrom, max(p_partkey) OVER () AS most, 10.0e0 + p_partkey % 50 AS control FROM part),
levels AS (SELECT *, CASE WHEN pos < 0.3e0 * most THEN 0 WHEN pos < 0.6e0 * most THEN 1 ELSE 2 END AS segment FROM part_rows),
changed AS (SELECT *, CASE segment WHEN 1 THEN 2.0e0 ELSE 0 END + 0.001e0 * (pos // 5 % 3) AS fc FROM levels),
centred AS (SELECT *, fc - avg(fc) OVER (PARTITION BY chrom, segment) AS corrected FROM changed)"""


@query(f"WITH {LEVELS_SQL} SELECT guide, chrom, segment, round(corrected, 9) AS corrected, round(greatest((control + 0.5e0) * pow(2.0e0, corrected) - 0.5e0, 0), 6) AS count FROM centred")
def cnv_levels(spark, sf_dir):
    """A stretch of each chromosome at another level: it is found to the guide, centred, and turned back into counts."""
    rows = b.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("guide"), F.col("p_brand").alias("gene"))
    most = rows.agg(F.max("pos").alias("most"))
    rows = rows.withColumn("chrom", F.concat(F.lit("chr"), (F.col("pos") % 5).cast("string"))).join(F.broadcast(most))
    inside = (F.col("pos") >= 0.3 * F.col("most")) & (F.col("pos") < 0.6 * F.col("most"))
    rows = rows.withColumn("fc", F.when(inside, 2.0).otherwise(0.0) + 0.001 * (F.floor(F.col("pos") / 5) % 3))
    done = models.copy_number_correction(rows.select("guide", "gene", "chrom", "pos", "fc"))
    count = models.corrected_count(10.0 + F.col("pos") % 50, F.col("corrected"))
    return done.select("guide", "chrom", "segment", F.round("corrected", 9).alias("corrected"), F.round(count, 6).alias("count"))


#: In genes of one or two guides the chance has a closed form.
PAIRS_SQL = """WITH g AS (SELECT l_partkey AS guide, l_partkey // 2 AS gene, CAST(sum(l_quantity) AS BIGINT) AS x FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (ORDER BY x, guide) / CAST(count(*) OVER () AS DOUBLE) AS u FROM g),
k AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY u) AS k, count(*) OVER (PARTITION BY gene) AS n FROM r),
s AS (SELECT gene, max(n) AS num, coalesce(min(CASE WHEN n = 1 THEN u WHEN k = 1 THEN 1 - (1 - u) * (1 - u) ELSE u * u END) FILTER (WHERE u <= 0.25), 1) AS rho FROM k GROUP BY gene),
c AS (SELECT *, least(1 - sqrt(1 - rho), 0.25) AS one, least(sqrt(rho), 0.25) AS two FROM s)
SELECT gene, num, round(rho, 9) AS rho, round(CASE WHEN rho = 1 THEN 1 WHEN num = 1 THEN least(rho, 0.25) ELSE 1 - (1 - one) * (1 - one) + (two - one) * (two - one) END, 9) AS pvalue FROM c"""


@query(PAIRS_SQL)
def rra_exact_p(spark, sf_dir):
    """The exact p of rho for genes of one or two guides."""
    rows = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("guide")).agg(F.sum("l_quantity").cast("bigint").alias("x"))
    scored = models.rho_p(models.rank_scores(rows.withColumn("gene", F.floor(F.col("guide") / 2)), "x"))
    return scored.select("gene", "num", F.round("rho", 9).alias("rho"), F.round("pvalue", 9).alias("pvalue"))
