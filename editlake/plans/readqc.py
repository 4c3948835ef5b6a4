"""Registered queries of read QC over all reads of the documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from editlake.functions import seq as q
from editlake.operators import readqc, targeted

from . import bindings as b

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query and its SQL under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


BASES_SQL = f"""{b.READS_SQL},
bases AS (SELECT sample, CAST(i AS BIGINT) AS cycle, substr(seq, i, 1) AS base, CAST(ascii(substr(qual, i, 1)) - 33 AS INTEGER) AS quality FROM reads, range(1, 151) r(i) WHERE i <= len(seq))"""


@query(f"""WITH {BASES_SQL}, h AS (SELECT sample, cycle, quality, count(*) AS n FROM bases GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY sample, cycle ORDER BY quality) AS below, sum(n) OVER (PARTITION BY sample, cycle) AS total FROM h)
SELECT sample, cycle, CAST(max(total) AS BIGINT) AS reads, {", ".join(f"min(quality) FILTER (WHERE below >= CAST(total AS BIGINT) * {p} // 100) AS p{p}" for p in readqc.QUANTILES)} FROM c GROUP BY sample, cycle""")
def fastq_quantiles(spark, sf_dir):
    """Quantiles of the qualities at each cycle."""
    return readqc.cycle_quantiles(readqc.level_counts(b.reads(spark, sf_dir)))


@query(f"""WITH {BASES_SQL} SELECT sample, cycle, {", ".join(f"round(count(*) FILTER (WHERE base = '{x.upper()}') / count(*), 6) AS {x}" for x in "acgt")},
  round(count(*) FILTER (WHERE base NOT IN ('A', 'C', 'G', 'T')) / count(*), 6) AS other FROM bases GROUP BY sample, cycle""")
def fastq_content(spark, sf_dir):
    """Shares of the bases at each cycle."""
    rows = readqc.base_content(readqc.level_counts(b.reads(spark, sf_dir)))
    return rows.select("sample", "cycle", *[F.round(c, 6).alias(c) for c in ("a", "c", "g", "t", "other")])


@query(f"""WITH {b.READS_SQL},
m AS (SELECT sample, len(seq) AS size, len(regexp_replace(seq, '[^GC]', '', 'g')) AS gc, len(regexp_replace(qual, '[^+]', '', 'g')) * 10 + len(regexp_replace(qual, '[^5]', '', 'g')) * 20
        + len(regexp_replace(qual, '[^?]', '', 'g')) * 30 + len(regexp_replace(qual, '[^I]', '', 'g')) * 40 AS score FROM reads),
v AS (SELECT sample, 'length' AS measure, size AS value FROM m UNION ALL SELECT sample, 'gc', (200 * gc + size) // (2 * size) FROM m UNION ALL SELECT sample, 'quality', score // size FROM m)
SELECT sample, measure, CAST(value AS BIGINT) AS value, count(*) AS n FROM v GROUP BY ALL""")
def fastq_reads(spark, sf_dir):
    """Reads by length, share of G and C, and mean quality."""
    return readqc.read_tables(b.reads(spark, sf_dir))


@query(f"""WITH {b.READS_SQL}, c AS (SELECT sample, CASE WHEN len(seq) > 75 THEN left(seq, 50) ELSE seq END AS s, count(*) AS n FROM reads GROUP BY 1, 2),
l AS (SELECT sample, n, CASE WHEN n < 10 THEN n WHEN n < 50 THEN 10 WHEN n < 100 THEN 50 WHEN n < 500 THEN 100 WHEN n < 1000 THEN 500 WHEN n < 5000 THEN 1000 WHEN n < 10000 THEN 5000 ELSE 10000 END AS level FROM c),
t AS (SELECT sample, CAST(level AS INTEGER) AS level, count(*) AS sequences, CAST(sum(n) AS BIGINT) AS reads FROM l GROUP BY ALL)
SELECT *, round(sequences / sum(sequences) OVER (PARTITION BY sample), 6) AS sequence_share, round(reads / sum(reads) OVER (PARTITION BY sample), 6) AS read_share FROM t""")
def fastq_duplication(spark, sf_dir):
    """Sequences by their number of copies."""
    rows = readqc.duplication_levels(b.reads(spark, sf_dir))
    return rows.select("sample", "level", "sequences", "reads", F.round("sequence_share", 6).alias("sequence_share"), F.round("read_share", 6).alias("read_share"))


#: Contaminants: the items as bases, and each sample's first document with every 30th base exchanged.
HITS_SQL = f"""WITH {b.READS_SQL},
found AS (SELECT sample, seq FROM (SELECT *, sum(n) OVER (PARTITION BY sample) AS total FROM (SELECT sample, left(seq, 50) AS seq, count(*) AS n FROM reads GROUP BY 1, 2)) WHERE n > 0.001 * total AND n > 1),
named AS (SELECT 'item ' || item_id AS name, lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS l FROM benchmark
    UNION ALL SELECT 'sample ' || sample, left(min_by(letters, doc_id), 600) FROM lettered WHERE sample IS NOT NULL AND letters IS NOT NULL GROUP BY sample),
based AS (SELECT name, translate(l, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS t FROM named WHERE l IS NOT NULL),
items AS (SELECT name, CASE WHEN name LIKE 'sample%' THEN list_aggregate(list_transform(range(1, len(t) + 1), lambda i: CASE WHEN i % 30 = 0 THEN translate(substr(t, CAST(i AS INTEGER), 1), 'ACGT', 'CATG') ELSE substr(t, CAST(i AS INTEGER), 1) END), 'string_agg', '') ELSE t END AS c FROM based),
sides AS (SELECT name, '+' AS strand, c FROM items UNION ALL SELECT name, '-', reverse(translate(c, 'ACGT', 'TGCA')) FROM items),
seqs AS (SELECT DISTINCT seq FROM found WHERE len(seq) >= 20),
a AS (SELECT seq, i, substr(seq, i, 10) AS w FROM seqs, range(1, 42) r(i) WHERE i + 9 <= len(seq)),
z AS (SELECT name, strand, c, i AS j, substr(c, i, 10) AS w FROM (SELECT *, unnest(range(1, len(c) - 8)) AS i FROM sides)),
d AS (SELECT DISTINCT seq, name, strand, c, i - j AS d FROM a JOIN z USING (w)),
p AS (SELECT seq, name, strand, d, i, CAST(substr(seq, i, 1) <> substr(c, i - d, 1) AS INTEGER) AS bad FROM d, range(1, 51) r(i) WHERE i <= len(seq) AND i - d BETWEEN 1 AND len(c)),
g AS (SELECT *, sum(bad) OVER (PARTITION BY seq, name, strand, d ORDER BY i) AS k FROM p),
stretch AS (SELECT seq, name, strand, d, k AS until, count(*) AS n, max(bad) AS bad FROM g GROUP BY seq, name, strand, d, k),
two AS (SELECT seq, name, strand, n + coalesce(lag(n) OVER w, 0) - CASE WHEN lag(n) OVER w IS NOT NULL AND lag(bad) OVER w = 1 THEN 1 ELSE 0 END AS size, bad AS wrong
    FROM stretch WINDOW w AS (PARTITION BY seq, name, strand, d ORDER BY until)),
short AS (SELECT DISTINCT seq, name, strand, len(seq) AS size, 0 AS wrong FROM (SELECT DISTINCT seq FROM found WHERE len(seq) BETWEEN 8 AND 19) JOIN sides ON contains(c, seq)),
r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY size DESC, wrong, name, strand) AS k FROM (SELECT seq, name, strand, size, wrong FROM two WHERE size >= 20 UNION ALL SELECT * FROM short))
SELECT sample, seq, name AS contaminant, strand, CAST(size AS INTEGER) AS size, CAST(wrong AS INTEGER) AS wrong FROM found JOIN (SELECT * FROM r WHERE k = 1) USING (seq)"""


@query(HITS_SQL)
def contaminants(spark, sf_dir):
    """Overrepresented beginnings of reads, seen twice or more, that are found in a list of contaminants, with a mismatch or on the other strand."""
    bases = lambda c: F.translate(F.lower(F.regexp_replace(c, "[^A-Za-z]", "")), "abcdefghijklmnopqrstuvwxyz", ("ACGT" * 7)[:26])
    items = b.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("name"), bases(F.col("text")).alias("sequence"))
    docs = b.table(spark, sf_dir, "documents").filter("source is not null and text is not null")
    ids = docs.groupBy("source").agg(F.min("doc_id").alias("doc_id"))  # a row a sample; only those documents' letters are looked at
    first = b.letters(spark, sf_dir, docs.join(ids, ["doc_id", "source"], "left_semi")).groupBy("sample").agg(F.left(F.min_by("letters", "doc_id"), F.lit(600)).alias("l"))
    first = first.select("sample", q.bases(F.translate("l", "abcdefghijklmnopqrstuvwxyz", ("ACGT" * 7)[:26])).alias("b"))
    changed = F.transform("b", lambda x, i: F.when((i + 1) % 30 == 0, F.translate(x, "ACGT", "CATG")).otherwise(x))
    first = first.select(F.concat(F.lit("sample "), F.col("sample")).alias("name"), F.array_join(changed, "").alias("sequence"))
    return readqc.contaminant_hits(targeted.overrepresented(b.reads(spark, sf_dir), 0.001, 50).filter("n > 1"), items.unionByName(first))
