"""Registered queries of readers and writers: tables are written in each format, read again by their readers and held against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlake.operators import targeted as t
from editlake.scratch import new_path
from editlake.sources import bam, fastx
from editlake.sources import tables as s

from . import bindings as b

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def text_file(df: DataFrame, label: str) -> str:
    """``df`` (value string) as text files; their folder."""
    path = new_path(df.sparkSession, label)
    df.write.text(path)
    return path


def csv_file(df: DataFrame, label: str, sep: str = ",", header: bool = True, files: int | None = None) -> str:
    """``df`` as delimited files, in as many as it has partitions; their folder."""
    path = new_path(df.sparkSession, label)
    (df.coalesce(files) if files else df).write.option("sep", sep).option("header", header).csv(path)
    return path


def supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "supplier")


GUIDES_SQL = "'g' || s_suppkey AS guide, 'gene' || s_nationkey AS gene"


def guide_gene() -> list:
    return [F.concat(F.lit("g"), F.col("s_suppkey").cast("string")).alias("guide"), F.concat(F.lit("gene"), F.col("s_nationkey").cast("string")).alias("gene")]


@query("""SELECT 's' || s_suppkey AS sample, 'f' || s_suppkey || '.fastq.gz' AS fastq_1, CASE WHEN s_suppkey % 2 = 0 THEN 'r' || s_suppkey || '.fastq.gz' END AS fastq_2,
  CASE WHEN s_suppkey % 3 = 0 THEN 'ACGTN' END AS reference, CAST(NULL AS VARCHAR) AS protospacer, CAST(NULL AS VARCHAR) AS template, 'c' || s_nationkey AS condition FROM supplier""")
def source_samplesheet(spark, sf_dir):
    k = F.col("s_suppkey")
    text = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    rows = supplier(spark, sf_dir).select(
        text("s", k).alias("sample"), text("f", k, ".fastq.gz").alias("fastq_1"), F.when(k % 2 == 0, text("r", k, ".fastq.gz")).alias("fastq_2"),
        F.when(k % 3 == 0, "ACGTN").alias("reference"), text("c", F.col("s_nationkey")).alias("condition"),
    )
    return s.read_samplesheet(spark, csv_file(rows, "sheet"))


@query("""SELECT 'RF_RO_vs_AF_AO' AS contrast, 'AF,AO' AS reference, 'RF,RO' AS treatment UNION ALL SELECT 'NO_vs_AF', 'AF', 'NO'""")
def source_contrasts(spark, sf_dir):
    rows = spark.createDataFrame([("AF,AO", "RF,RO"), ("AF", "NO")], "reference string, treatment string")
    out = s.read_contrasts(spark, csv_file(rows, "contrasts", ";"))
    return out.select("contrast", F.array_join("reference", ",").alias("reference"), F.array_join("treatment", ",").alias("treatment"))


@query(f"""SELECT guide, coalesce(gene, 'NO_GENE_NAME') AS gene, sample, coalesce(CASE sample WHEN 'a' THEN a ELSE z END, 0) AS count FROM (
  SELECT {GUIDES_SQL.replace("'gene' || s_nationkey", "CASE WHEN s_suppkey % 5 <> 0 THEN 'gene' || s_nationkey END")}, s_suppkey * 3.0e0 AS a, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey + 0.5e0 END AS z FROM supplier), (VALUES ('a'), ('z')) v(sample)""")
def source_counts(spark, sf_dir):
    """A wide count table with missing genes and counts."""
    k, (guide, gene) = F.col("s_suppkey"), guide_gene()
    rows = supplier(spark, sf_dir).select(guide.alias("sgRNA"), F.when(k % 5 != 0, gene).alias("Gene"), (k * 3.0).alias("a"), F.when(k % 4 != 0, k + 0.5).alias("z"))
    return s.read_counts(spark, csv_file(rows, "counts", "\t"))


@query(f"SELECT guide, gene, sample, CASE sample WHEN 'a' THEN a ELSE z END AS fc FROM (SELECT {GUIDES_SQL}, s_suppkey / 8.0e0 AS a, -s_suppkey / 4.0e0 AS z FROM supplier), (VALUES ('a'), ('z')) v(sample)")
def source_fold_changes(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = supplier(spark, sf_dir).select(*guide_gene(), (k / 8.0).alias("a"), (-k / 4.0).alias("z"))
    return s.read_fold_changes(spark, csv_file(rows, "changes", "\t"))


@query("SELECT DISTINCT 'gene' || s_nationkey AS gene FROM supplier")
def source_gene_set(spark, sf_dir):
    rows = supplier(spark, sf_dir).select(guide_gene()[1], F.lit("x").alias("more"))
    return s.read_gene_set(spark, csv_file(rows, "genes", "\t"))


@query("SELECT DISTINCT 'gene' || s_nationkey AS gene FROM supplier")
def source_gene_set_headerless(spark, sf_dir):
    rows = supplier(spark, sf_dir).select(guide_gene()[1], F.lit("x").alias("more"))
    return s.read_gene_set(spark, csv_file(rows, "genes", "\t", False), header=False)


@query("""WITH e AS (SELECT 'gene' || s_nationkey AS u, 'gene' || (s_nationkey + s_suppkey % 3) % 25 AS v FROM supplier), both_ways AS (SELECT u, v FROM e UNION SELECT v, u FROM e)
SELECT u, v FROM both_ways WHERE u IN (SELECT 'gene' || n_nationkey FROM nation WHERE n_regionkey < 4) AND v IN (SELECT 'gene' || n_nationkey FROM nation WHERE n_regionkey < 4)""")
def source_network(spark, sf_dir):
    """Edges given several times and in both directions, between known genes."""
    other = F.concat(F.lit("gene"), ((F.col("s_nationkey") + F.col("s_suppkey") % 3) % 25).cast("string"))
    rows = supplier(spark, sf_dir).select(guide_gene()[1].alias("u"), other.alias("v"))
    known = b.table(spark, sf_dir, "nation").filter("n_regionkey < 4").select(F.concat(F.lit("gene"), F.col("n_nationkey").cast("string")).alias("gene"))
    return s.read_network(spark, csv_file(rows, "network", "\t", False), known)


@query("SELECT 'g' || s_suppkey AS guide, s_suppkey % 3 AS perfect, s_suppkey % 2 AS mismatch FROM supplier")
def source_align_info(spark, sf_dir):
    k = F.col("s_suppkey")
    loci = lambda n: F.array_join(F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit("chr1_"), i.cast("string"))), ",")
    perfect, mismatch = loci((k % 3).cast("int")), loci((k % 2).cast("int"))
    rows = supplier(spark, sf_dir).select(guide_gene()[0], perfect.alias("p"), F.lit("x").alias("pg"), mismatch.alias("m"), F.lit("y").alias("mg"))
    return s.read_align_info(spark, csv_file(rows, "loci", "\t", False))


@query("""SELECT 'n' || s_nationkey AS guide, upper('acgt' || min(s_suppkey)) AS sequence, 'gene' || min(s_suppkey) AS gene FROM supplier GROUP BY s_nationkey""")
def source_library(spark, sf_dir):
    """A guide that stands several times has its first row's sequence and gene."""
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    rows = supplier(spark, sf_dir).orderBy("s_suppkey").coalesce(1).select(text("n", "s_nationkey").alias("id"), text("acgt", "s_suppkey").alias("seq"), text("gene", "s_suppkey").alias("gene"))
    return s.read_library(spark, csv_file(rows, "library", "\t"))


@query("SELECT 'HGNC:' || s_suppkey AS gene_id, 'S' || s_suppkey AS symbol, CASE WHEN s_suppkey % 2 = 0 THEN 'P' || s_suppkey END AS previous, CAST(NULL AS VARCHAR) AS aliases FROM supplier")
def source_gene_names(spark, sf_dir):
    text = lambda p: F.concat(F.lit(p), F.col("s_suppkey").cast("string"))
    rows = supplier(spark, sf_dir).select(text("HGNC:").alias("hgnc_id"), text("S").alias("symbol"), F.when(F.col("s_suppkey") % 2 == 0, text("P")).alias("prev_symbol"))
    return s.read_gene_names(spark, csv_file(rows, "names", "\t")).drop("ordinal")


@query("SELECT 'gene' || s_nationkey AS u, 'g' || s_suppkey AS v FROM supplier WHERE s_suppkey % 3 <> 0")
def source_interactions(spark, sf_dir):
    guide, gene = guide_gene()
    rows = supplier(spark, sf_dir).select(F.lit("BIO").alias("kind"), gene.alias("Official A"), F.when(F.col("s_suppkey") % 3 != 0, guide).alias("Official B"))
    return s.read_interactions(spark, csv_file(rows, "interactions"), ("Official A", "Official B"))


#: Small ranges, so that the test files are cut too.
CUT = 1 << 20


@query(f"WITH {b.READS_SQL} SELECT CAST(read_id AS VARCHAR) AS name, seq FROM reads")
def source_fasta(spark, sf_dir):
    """All reads written as FASTA and read again in ranges."""
    rows = b.reads(spark, sf_dir).select(F.col("read_id").cast("string").alias("name"), "seq")
    return fastx.read_fastx(spark, text_file(fastx.to_fasta(rows, "name", "seq"), "fasta"), CUT).select("name", "seq")


def named_reads(spark, sf_dir) -> DataFrame:
    """All reads; the comment is the sample, and there is none for every third read."""
    comment = F.when(F.col("read_id") % 3 != 0, F.col("sample"))
    return b.reads(spark, sf_dir).select(F.col("read_id").cast("string").alias("name"), comment.alias("comment"), "seq", "qual")


@query(f"WITH {b.READS_SQL} SELECT CAST(read_id AS VARCHAR) AS name, CASE WHEN read_id % 3 <> 0 THEN sample END AS comment, seq, qual FROM reads")
def source_fastq(spark, sf_dir):
    rows = named_reads(spark, sf_dir).withColumn("name", F.concat_ws(" ", "name", "comment"))
    return fastx.read_fastx(spark, text_file(fastx.to_fastq(rows, "name", "seq", "qual"), "fastq"), CUT).drop("file")


@query(f"WITH {b.READS_SQL} SELECT CAST(read_id AS VARCHAR) AS name, CASE WHEN read_id % 3 <> 0 THEN sample END AS comment, seq, qual FROM reads")
def source_fastq_blocks(spark, sf_dir):
    """Block-compressed files, read in ranges."""
    path = new_path(spark, "fastq-blocks")
    fastx.write_blocks(named_reads(spark, sf_dir), path)
    return fastx.read_fastx(spark, path, CUT // 8).drop("file")


@query(f"WITH {b.READS_SQL} SELECT count(*) AS records, CAST(sum(len(seq)) AS BIGINT) AS bases FROM reads")
def fastq_record_count(spark, sf_dir):
    rows = b.reads(spark, sf_dir).select(F.col("read_id").cast("string").alias("name"), "seq", "qual")
    found = fastx.read_fastx(spark, text_file(fastx.to_fastq(rows, "name", "seq", "qual"), "fastq"))
    return found.agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("seq")).alias("bases"))


def sam_lines(spark, sf_dir) -> str:
    """The alignments as SAM text: every tenth unmapped, every seventh secondary."""
    rows = b.alignments(spark, sf_dir)
    flag = F.when(F.col("l_partkey") % 10 == 0, 4).when(F.col("l_partkey") % 7 == 0, 256).otherwise(0)
    fields = ["qname", flag.cast("string"), F.lit("ref"), F.col("pos").cast("string"), F.lit("60"), "raw_cigar", *[F.lit(x) for x in ("*", "0", "0", "ACGT", "IIII")]]
    return text_file(rows.select(F.concat_ws("\t", *fields).alias("value")), "sam")


FLAG_SQL = f"{b.ALIGN_SQL}, sam AS (SELECT *, CASE WHEN l_partkey % 10 = 0 THEN 4 WHEN l_partkey % 7 = 0 THEN 256 ELSE 0 END AS flag FROM aligned)"


@query(f"WITH {FLAG_SQL} SELECT qname, pos, raw_cigar FROM sam WHERE flag = 0")
def source_sam(spark, sf_dir):
    return fastx.read_sam(spark, sam_lines(spark, sf_dir)).select("qname", "pos", "raw_cigar")


BAM_SQL = f"""{FLAG_SQL}, bam AS (SELECT qname, flag, CASE WHEN flag = 4 THEN '*' ELSE 'amplicon' || sample END AS ref, pos, 60 AS mapq, raw_cigar,
  repeat('ACGTNRY', CAST(1 + l_partkey % 20 AS INTEGER)) AS seq, CASE WHEN l_partkey % 9 = 0 THEN '*' ELSE repeat('I#5?~!A', CAST(1 + l_partkey % 20 AS INTEGER)) END AS qual FROM sam)"""


def bam_files(spark, sf_dir) -> str:
    """The alignments as BAM files: every tenth unmapped, every seventh secondary."""
    k = F.col("l_partkey")
    times, text = (1 + k % 20).cast("int"), lambda x: F.lit(x)
    flag = F.when(k % 10 == 0, 4).when(k % 7 == 0, 256).otherwise(0)
    rows = b.alignments(spark, sf_dir).select(
        "qname", flag.alias("flag"), F.when(k % 10 == 0, "*").otherwise(F.concat(F.lit("amplicon"), F.col("sample").cast("string"))).alias("ref"), "pos",
        F.lit(60).alias("mapq"), "raw_cigar", F.repeat(text("ACGTNRY"), times).alias("seq"), F.when(k % 9 == 0, "*").otherwise(F.repeat(text("I#5?~!A"), times)).alias("qual"),
    )
    path = new_path(spark, "bam")
    bam.write_bam(rows, path)
    return path


@query(f"WITH {BAM_SQL} SELECT qname, flag, ref, pos, mapq, raw_cigar, seq, qual FROM bam WHERE flag = 0")
def source_bam(spark, sf_dir):
    """Primary alignments of BAM files, written and read in ranges."""
    return bam.read_bam(spark, bam_files(spark, sf_dir), split_bytes=CUT // 8).drop("sample")


@query(f"WITH {BAM_SQL} SELECT ref, count(*) FILTER (WHERE flag <> 4) AS mapped, count(*) AS total, CAST(sum(len(seq)) AS BIGINT) AS bases FROM bam GROUP BY ref")
def bam_counts(spark, sf_dir):
    """Records of each reference, primary or not."""
    rows = bam.read_bam(spark, bam_files(spark, sf_dir), primary_only=False, split_bytes=CUT // 8)
    mapped = F.count_if(F.col("flag").bitwiseAND(F.lit(4)) == 0)
    return rows.groupBy("ref").agg(mapped.alias("mapped"), F.count(F.lit(1)).alias("total"), F.sum(F.length("seq")).alias("bases"))


@query(f"WITH {FLAG_SQL} SELECT count(*) FILTER (WHERE flag <> 4) AS mapped, count(*) AS total, round_even(count(*) FILTER (WHERE flag <> 4) * 100.0e0 / count(*), 1) AS pct FROM sam")
def mapped_counts(spark, sf_dir):
    """Aligned reads and their share, over all files of a run."""
    n = fastx.mapped_counts(fastx.read_sam(spark, sam_lines(spark, sf_dir), primary_only=False))
    n = n.agg(F.sum("mapped").alias("mapped"), F.sum("total").alias("total"))
    return n.withColumn("pct", F.bround(F.col("mapped") * 100.0 / F.col("total"), 1))


@query(f"WITH {b.ALIGN_SQL} SELECT qname, pos, raw_cigar, 'ACGT' AS seq FROM aligned")
def source_alignment_csv(spark, sf_dir):
    rows = b.alignments(spark, sf_dir).select("pos", F.col("raw_cigar").alias("cigar"), F.col("qname").alias("id"), F.lit("ACGT").alias("seq"))
    return s.read_alignment_csv(spark, csv_file(rows, "alignments")).drop("sample")


@query(f"""WITH {b.READS_SQL}, c AS (SELECT sample, substr(seq, 1, 8) AS seq, count(*) AS n FROM reads GROUP BY 1, 2), o AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY sample) AS total FROM c) WHERE n > 0.03 * total)
SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY n DESC, seq) || '-' || n AS name, seq FROM o""")
def overrepresented_fasta(spark, sf_dir):
    """Names of overrepresented sequences: their place by count, and the count."""
    found = t.overrepresented(b.reads(spark, sf_dir), 0.03, 8)
    return t.named_by_count(found)


@query("SELECT s_suppkey, s_name FROM supplier")
def sink_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    s.write_csv(supplier(spark, sf_dir).select("s_suppkey", "s_name"), path)
    return spark.read.csv(path, header=True, schema="s_suppkey bigint, s_name string")


@query("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier")
def sink_tsv_partitioned(spark, sf_dir):
    path = new_path(spark, "tsv")
    s.write_tsv(supplier(spark, sf_dir).select("s_suppkey", "s_name", "s_nationkey"), path, ["s_nationkey"])
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True).select("s_suppkey", "s_name", F.col("s_nationkey").cast("bigint").alias("s_nationkey"))


@query("SELECT s_suppkey, s_name FROM supplier")
def sink_json(spark, sf_dir):
    path = new_path(spark, "json")
    s.write_json(supplier(spark, sf_dir).select("s_suppkey", "s_name"), path)
    return spark.read.json(path, schema="s_suppkey bigint, s_name string")


@query("SELECT s_suppkey, format('{:.2f}', s_suppkey / 7.0e0) AS x FROM supplier")
def sink_fixed(spark, sf_dir):
    return s.fixed(supplier(spark, sf_dir).select("s_suppkey", (F.col("s_suppkey") / 7.0).alias("x")), {"x": 2})


STAGES_SQL = "old AS (SELECT 's' || s_nationkey AS sample, 'raw' AS stage, count(*) AS n, 100.0e0 AS pct FROM supplier GROUP BY 1 UNION ALL SELECT 's' || s_nationkey, 'merged', count(*) FILTER (WHERE s_suppkey % 2 = 0), 50.0e0 FROM supplier GROUP BY 1)"


@query(f"WITH {STAGES_SQL} SELECT sample, stage, CASE WHEN stage = 'merged' THEN n + 1 ELSE n END AS n, CASE WHEN stage = 'merged' THEN 51.0e0 ELSE pct END AS pct FROM old UNION ALL SELECT 'new', 'raw', 7, 100.0e0")
def summary_upsert(spark, sf_dir):
    """A later run's numbers replace those of equal sample and stage; new ones are added."""
    rows = supplier(spark, sf_dir).groupBy(F.concat(F.lit("s"), F.col("s_nationkey").cast("string")).alias("sample"))
    n = rows.agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("s_suppkey") % 2 == 0).alias("merged"))
    part = lambda c, pct, more=0: n.select("sample", F.lit(c).alias("stage"), (F.col(c) + more).alias("n"), F.lit(pct).alias("pct"))
    new = part("merged", 51.0, 1).unionByName(spark.createDataFrame([("new", "raw", 7, 100.0)], "sample string, stage string, n bigint, pct double"))
    return s.upsert_stage(part("raw", 100.0).unionByName(part("merged", 50.0)), new)


@query("SELECT 's_nationkey' AS a, 's_suppkey' AS z, count(*) AS n FROM supplier")
def columns_by_number(spark, sf_dir):
    """Columns asked for by number and by name."""
    rows = supplier(spark, sf_dir).select("s_suppkey", "s_name", "s_nationkey")
    a, z = s.columns_by(rows.columns, ["3", "s_suppkey"])
    return rows.select(a, z).agg(F.count(F.lit(1)).alias("n")).select(F.lit(a).alias("a"), F.lit(z).alias("z"), "n")


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '/ref/hg38.fa' WHEN 1 THEN '/ref/mm10.fa' END AS fasta FROM supplier")
def genome_catalogue(spark, sf_dir):
    catalogue = {"hg38": {"fasta": "/ref/hg38.fa"}, "mm10": {"fasta": "/ref/mm10.fa"}}
    found = [(k, s.genome_entry(catalogue, g, "fasta")) for k, g in enumerate(("hg38", "mm10", None))]
    known = spark.createDataFrame(found, "k int, fasta string")
    return supplier(spark, sf_dir).withColumn("k", (F.col("s_suppkey") % 3).cast("int")).join(known, "k").select("s_suppkey", "fasta")
