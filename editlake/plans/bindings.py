"""The driver's tables seen as screens and amplicon experiments, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL, TREATMENT = ["AF", "AO"], ["RF", "RO"]
ESSENTIAL, NONESSENTIAL = "ECONOMY", "SMALL"
HALF_WINDOW = 50
AMPLICON = "ACGTTGCAATGCCGATTACGGATCCTTAAGGCATCGATTGCCAGTACCGGTTAACGTAGCTAGGCTTACGATCGGATCTTAGGCCATATCGGCTAAGCTTGACCGTATGCAATCGG"
GUIDE = "CAGTACCGGTTAACGTAGCT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# X1: counts of a pooled screen


def guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(guide, gene, part_type) of the guides that were ever seen."""
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct()
    part = table(spark, sf_dir, "part").join(seen.hint("merge"), "p_partkey", "left_semi")  # a row a guide: never broadcast
    return part.select(
        F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("guide"),
        F.concat_ws("_", "p_brand", "p_type").alias("gene"),
        F.col("p_type").alias("part_type"),
    )


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(guide, sample, count) where there is one."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy(
        F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("guide"),
        F.concat("l_returnflag", "l_linestatus").alias("sample"),
    ).agg(F.sum("l_quantity").cast("bigint").alias("count"))


COUNTS_SQL = f"""
base AS (SELECT l_partkey, l_returnflag || l_linestatus AS sample, CAST(sum(l_quantity) AS BIGINT) AS c
         FROM lineitem GROUP BY 1, 2),
guides AS (SELECT p_partkey, 'g' || p_partkey AS guide, p_brand || '_' || p_type AS gene, p_type AS part_type
           FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)),
samples AS (SELECT DISTINCT sample FROM base),
counts AS (SELECT guide, gene, part_type, s.sample AS sample,
                  CAST(CASE WHEN part_type = '{ESSENTIAL}' AND s.sample IN ('RF', 'RO') THEN floor(coalesce(c, 0) / 2.0)
                            ELSE coalesce(c, 0) END AS BIGINT) AS count
           FROM guides CROSS JOIN samples s LEFT JOIN base b ON b.l_partkey = p_partkey AND b.sample = s.sample)
"""

# X2: reads

READS_SQL = """
lettered AS (SELECT source AS sample, doc_id, lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters FROM documents),
counted AS (SELECT *, CAST(ceil(len(letters) / 150.0) AS BIGINT) AS n_reads FROM lettered),
numbered AS (SELECT *, unnest(range(n_reads)) AS read_no FROM counted),
reads AS (SELECT sample, doc_id, read_no, n_reads, doc_id * 1000000 + read_no AS read_id,
    translate(substr(letters, read_no * 150 + 1, 150), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq,
    translate(substr(letters, read_no * 150 + 1, 150), 'abcdefghijklmnopqrstuvwxyz', '+5?I+5?I+5?I+5?I+5?I+5?I+5') AS qual FROM numbered)
"""
READ_LENGTH = 150


def letters(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """(sample, doc_id, letters, n_reads) of every document, or of those given: its letters, and how many reads they make."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    rows = docs.select(F.col("source").alias("sample"), "doc_id", F.lower(F.regexp_replace("text", "[^A-Za-z]", "")).alias("letters"))
    return rows.withColumn("n_reads", F.ceil(F.length("letters") / READ_LENGTH))


#: What letters become in a read's sequence and quality, in turn.
LETTERS_TO = {"seq": "ACGT", "qual": "+5?I"}


def turned(letters, name: str):
    """The sequence or quality that letters stand for."""
    return F.translate(letters, "abcdefghijklmnopqrstuvwxyz", (LETTERS_TO[name] * 7)[:26])


def read_at(read_no) -> dict:
    """seq and qual of a read of :func:`letters`."""
    cut = F.col("letters").substr((read_no * READ_LENGTH + 1).cast("int"), F.lit(READ_LENGTH))
    return {name: turned(cut, name) for name in LETTERS_TO}


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, read_id, seq, qual): all letters of the documents, in reads of 150. A document is gone through once, not for each read."""
    cuts = F.regexp_extract_all("letters", F.lit(f"[a-z]{{1,{READ_LENGTH}}}"), F.lit(0))
    rows = letters(spark, sf_dir).select("sample", "doc_id", F.posexplode(cuts).alias("read_no", "cut"))
    read_id = (F.col("doc_id") * 1000000 + F.col("read_no")).alias("read_id")
    return rows.select("sample", read_id, *[turned(F.col("cut"), name).alias(name) for name in LETTERS_TO])


# X3: alignments

ALIGN_SQL = """
keyed AS (SELECT *, CAST(20 + l_quantity AS BIGINT) AS a, 1 + l_partkey % 12 AS k, CAST(80 - l_quantity AS BIGINT) AS b FROM lineitem),
aligned AS (
  SELECT CAST(l_suppkey % 4 AS BIGINT) AS sample,
    concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT), l_returnflag, l_linestatus, CAST(round(l_extendedprice * 100) AS BIGINT)) AS qname,
    CAST(1 + l_suppkey % 3 AS BIGINT) AS pos,
    CASE WHEN l_linenumber = 1 AND NOT (l_returnflag = 'N' AND l_partkey % 17 = 0) THEN '5S' ELSE '' END ||
    CASE WHEN l_linenumber = 7 THEN a || 'M' || k || 'D1M2I' || b || 'M'
         WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN a || 'M' || k || 'D2I' || b || 'M'
         WHEN l_linenumber = 5 AND l_returnflag = 'R' THEN a || 'M1D5M1I5M1D' || b || 'M'
         WHEN l_returnflag = 'A' THEN a || 'M' || k || 'D' || b || 'M'
         WHEN l_returnflag = 'R' THEN a || 'M' || k || 'I' || b || 'M'
         WHEN l_returnflag = 'N' AND l_partkey % 17 = 0 THEN '60M'
         ELSE (a + b) || 'M' END AS raw_cigar,
    l_partkey, l_orderkey
  FROM keyed),
reads_aligned AS (SELECT *, regexp_replace(regexp_replace(raw_cigar, '^[0-9]+[SH]', ''), '[0-9]+[SH]$', '') AS cigar FROM aligned),
ops AS (SELECT *, list_transform(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1), lambda x: CAST(x AS BIGINT)) AS lens,
        regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2) AS kinds FROM reads_aligned)
"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, qname, pos, raw_cigar, l_partkey, l_orderkey): one alignment for each line item."""
    rows = table(spark, sf_dir, "lineitem")
    a, k, b = (F.col("l_quantity") + 20).cast("bigint"), 1 + F.col("l_partkey") % 12, (80 - F.col("l_quantity")).cast("bigint")
    number, flag, short = F.col("l_linenumber"), F.col("l_returnflag"), (F.col("l_returnflag") == "N") & (F.col("l_partkey") % 17 == 0)
    put = lambda *parts: F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])
    cigar = (
        F.when(number == 7, put(a, "M", k, "D1M2I", b, "M"))
        .when((number == 6) & (flag == "N"), put(a, "M", k, "D2I", b, "M"))
        .when((number == 5) & (flag == "R"), put(a, "M1D5M1I5M1D", b, "M"))
        .when(flag == "A", put(a, "M", k, "D", b, "M"))
        .when(flag == "R", put(a, "M", k, "I", b, "M"))
        .when(short, F.lit("60M"))
        .otherwise(put(a + b, "M"))
    )
    clip = F.when((number == 1) & ~short, F.lit("5S")).otherwise(F.lit(""))
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    key += [F.col("l_quantity").cast("bigint").cast("string"), flag, F.col("l_linestatus")]
    return rows.select(
        (F.col("l_suppkey") % 4).cast("bigint").alias("sample"),
        F.concat_ws("-", *key, F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")).alias("qname"),
        (1 + F.col("l_suppkey") % 3).cast("bigint").alias("pos"),
        F.concat(clip, cigar).alias("raw_cigar"),
        "l_partkey",
        "l_orderkey",
    )


# X4: gene network

EDGES_SQL = """
gene_orders AS (SELECT DISTINCT l_orderkey, p_brand || '_' || p_type AS gene FROM lineitem JOIN part ON p_partkey = l_partkey),
edges AS (SELECT x.gene AS u, y.gene AS v, count(*) AS n FROM gene_orders x JOIN gene_orders y
          ON x.l_orderkey = y.l_orderkey AND x.gene < y.gene GROUP BY 1, 2),
network AS (SELECT u, v FROM edges WHERE n > (SELECT 1.15 * avg(n) FROM edges))
"""


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(u, v), u < v: pairs of genes that share orders more often than most pairs do."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("_", "p_brand", "p_type").alias("gene"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    genes = rows.join(part, "p_partkey").select("l_orderkey", "gene").distinct()
    both = genes.withColumnRenamed("gene", "u").join(genes.withColumnRenamed("gene", "v"), "l_orderkey").filter("u < v")
    edges = both.groupBy("u", "v").count()
    mean = edges.agg(F.avg("count").alias("mean"))  # one row
    return edges.join(F.broadcast(mean)).filter("count > 1.15 * mean").select("u", "v")
