"""Registered amplicon queries over the bindings, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from editlake.functions import seq as q
from editlake.operators import targeted as t
from editlake.scratch import materialize

from . import bindings as b

QUERIES: dict = {}
SQL: dict[str, str] = {}
A = b.AMPLICON


def query(sql: str | None = None):
    """Register a query under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def aligned(spark, sf_dir):
    return b.alignments(spark, sf_dir).withColumn("cigar", q.strip_clips(F.col("raw_cigar")))


def called(spark, sf_dir):
    return t.call_variants(t.collapse(aligned(spark, sf_dir)))


class Calls:
    """What is called from the alignments. They are collapsed once: a row a sample, CIGAR and place is all that calling needs."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        self.collapsed = materialize(t.collapse(aligned(spark, sf_dir)), "collapsed")
        self.called = t.call_variants(self.collapsed)
        self.events = materialize(t.all_events(self.called), "events")

    def samples(self):
        return self.collapsed.select("sample").distinct()

    def genotypes(self):
        """The reads' different genotypes: every event has a read."""
        return self.events.select("sample", "start", "length", F.col("class").alias("modification")).distinct()

    def reads(self):
        return t.reads_of(self.events, aligned(self.spark, self.sf_dir))

    def wild_type(self):
        return t.wild_type_counts(self.called)


def indel_reads(spark, sf_dir, calls=None):
    return (calls or Calls(spark, sf_dir)).reads()


def read_of(rows, spark, sf_dir):
    """Sequence and quality of the read that a line item is bound to: one of the reads of one document.

    A document is cut into its reads before it meets its line items, of which each takes one by its number.
    """
    docs = b.letters(spark, sf_dir).select("doc_id", F.regexp_extract_all("letters", F.lit(f".{{1,{b.READ_LENGTH}}}"), F.lit(0)).alias("cuts"))
    every = lambda name: F.transform("cuts", lambda x: b.turned(x, name)).alias(f"{name}s")
    docs = docs.select("doc_id", F.size("cuts").cast("bigint").alias("n_reads"), *[every(c) for c in b.LETTERS_TO])
    n = b.table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_docs"))  # one row
    keyed = rows.join(F.broadcast(n)).withColumn("doc_id", F.col("l_partkey") % F.col("n_docs")).drop("n_docs")
    read_no = (F.col("l_orderkey") % F.when(F.col("n_reads") > 0, F.col("n_reads"))).cast("int")
    out = keyed.join(docs, "doc_id", "left").withColumns({c: F.get(f"{c}s", read_no) for c in b.LETTERS_TO})
    return out.drop("doc_id", "n_reads", *[f"{c}s" for c in b.LETTERS_TO])


COLL_SQL = b.ALIGN_SQL + """,
coll AS (SELECT sample, cigar, pos, any_value(lens) AS lens, any_value(kinds) AS kinds, count(*) AS n FROM ops GROUP BY sample, cigar, pos),
totals AS (SELECT sample, list_sum(lens) AS total, count(*) AS c FROM coll GROUP BY 1, 2),
modal AS (SELECT sample, CAST(arg_max(total, c * 100000 - total) AS BIGINT) AS main_length FROM totals GROUP BY sample),
called AS (SELECT coll.*, CASE WHEN len(kinds) = 1 AND kinds[1] = 'M' THEN CASE WHEN lens[1] > main_length - 10 THEN 'wt' ELSE 'bad_wt' END
    WHEN len(kinds) <> 3 THEN 'bad_alignment' WHEN kinds[2] = 'D' THEN 'del' WHEN kinds[2] = 'I' THEN 'ins' ELSE 'unknown' END AS class
  FROM coll JOIN modal USING (sample)),
mean_ins AS (SELECT sample, coalesce(sum(n * lens[2]) FILTER (WHERE class = 'ins') / sum(n) FILTER (WHERE class = 'ins'), 1.0) AS mean_ins FROM called GROUP BY sample)"""


def events_sql(mock: bool) -> str:
    more = """
  UNION ALL SELECT sample, cigar, pos, n, CASE WHEN kinds[2] = 'D' THEN 'del' ELSE 'ins' END, pos + lens[1], lens[2] FROM longer WHERE five = 0 AND len(kinds) IN (5, 7)
  UNION ALL SELECT sample, cigar, pos, n, CASE WHEN kinds[4] = 'D' THEN 'del' ELSE 'ins' END, pos + lens[1] + CASE WHEN kinds[2] = 'D' THEN lens[2] ELSE 0 END + lens[3], lens[4] FROM longer WHERE five = 0 AND len(kinds) IN (5, 7)
  UNION ALL SELECT sample, cigar, pos, n, CASE WHEN kinds[6] = 'D' THEN 'del' ELSE 'ins' END, pos + lens[1] + CASE WHEN kinds[2] = 'D' THEN lens[2] ELSE 0 END + lens[3] + CASE WHEN kinds[4] = 'D' THEN lens[4] ELSE 0 END + lens[5], lens[6] FROM longer WHERE len(kinds) = 7
  UNION ALL SELECT sample, cigar, pos, n, 'bad_alignment', NULL, NULL FROM longer WHERE len(kinds) NOT IN (4, 5, 7)"""
    less = """
  UNION ALL SELECT sample, cigar, pos, n, 'bad_alignment', NULL, NULL FROM longer WHERE five = 0 AND len(kinds) <> 4"""
    return COLL_SQL + """,
longer AS (SELECT c.*, CASE WHEN len(kinds) = 5 AND lens[2] + lens[4] > lens[3] AND lens[3] < mean_ins THEN 1 ELSE 0 END AS five FROM called c JOIN mean_ins USING (sample) WHERE len(kinds) > 3),
again AS (SELECT sample, cigar, pos, n, 'delin' AS class, pos + lens[1] AS start, lens[2] + lens[3] + lens[4] AS length FROM longer WHERE five = 1
  UNION ALL SELECT sample, cigar, pos, n, 'delin', pos + lens[1], lens[2] + lens[3] FROM longer WHERE len(kinds) = 4""" + (more if mock else less) + """),
events AS (SELECT sample, cigar, pos, n, class, pos + lens[1] AS start, lens[2] AS length FROM called WHERE class IN ('del', 'ins', 'unknown')
  UNION ALL SELECT sample, cigar, pos, n, class, start, length FROM again WHERE class <> 'bad_alignment')"""


READ_SQL = events_sql(False) + """,
indel_reads AS (SELECT o.sample, o.qname, o.pos, o.cigar, o.raw_cigar, o.l_partkey, o.l_orderkey, e.class AS modification, e.start, e.length
  FROM ops o JOIN events e ON o.sample = e.sample AND o.cigar = e.cigar AND o.pos = e.pos),
geno AS (SELECT sample, start, length, modification, count(*) AS freq FROM indel_reads GROUP BY ALL),
wild AS (SELECT sample, CAST(coalesce(sum(n) FILTER (WHERE class = 'wt'), 0) AS BIGINT) AS wt FROM called GROUP BY sample)"""


@query(f"WITH {b.ALIGN_SQL} SELECT raw_cigar, cigar, count(*) AS n FROM reads_aligned GROUP BY ALL")
def clip_trim(spark, sf_dir):
    return aligned(spark, sf_dir).groupBy("raw_cigar", "cigar").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {COLL_SQL} SELECT sample, cigar, pos, n AS count FROM coll")
def collapse(spark, sf_dir):
    return t.collapse(aligned(spark, sf_dir))


@query(f"WITH {b.ALIGN_SQL} SELECT DISTINCT cigar, array_to_string(lens, ',') AS lens, array_to_string(kinds, ',') AS kinds FROM ops")
def cigar_explode(spark, sf_dir):
    rows = t.with_ops(aligned(spark, sf_dir).select("cigar").distinct())
    return rows.select("cigar", F.array_join(F.col("lens").cast("array<string>"), ",").alias("lens"), F.array_join("kinds", ",").alias("kinds"))


@query(f"WITH {COLL_SQL} SELECT sample, main_length FROM modal")
def modal_length(spark, sf_dir):
    return t.modal_length(t.collapse(aligned(spark, sf_dir)))


@query(f"""WITH {COLL_SQL} SELECT sample, cigar, pos, n AS count, class,
  CASE WHEN class IN ('del', 'ins', 'unknown') THEN pos + lens[1] END AS start, CASE WHEN class IN ('del', 'ins', 'unknown') THEN lens[2] END AS length FROM called""")
def variant_call(spark, sf_dir):
    return called(spark, sf_dir).select("sample", "cigar", "pos", "count", "class", F.col("start").cast("bigint").alias("start"), F.col("length").cast("bigint").alias("length"))


@query(f"WITH {COLL_SQL} SELECT sample, round(mean_ins, 6) AS mean_ins FROM mean_ins")
def mean_ins_len(spark, sf_dir):
    return t.mean_insertion(called(spark, sf_dir)).withColumn("mean_ins", F.round("mean_ins", 6))


@query(f"WITH {events_sql(False)} SELECT sample, cigar, pos, n AS count, class, start, length FROM again")
def reclassify(spark, sf_dir):
    return t.reclassify(called(spark, sf_dir))


@query(f"WITH {events_sql(True)} SELECT sample, cigar, pos, n AS count, class, start, length FROM again")
def reclassify_mock(spark, sf_dir):
    return t.reclassify(called(spark, sf_dir), mock=True)


@query(f"""WITH {events_sql(False)} SELECT sample, cigar, pos, class, start, length,
  CAST(round_even(n + CASE WHEN class = 'del' THEN -1 ELSE 1 END * n * (length * 0.156e0 / (length * 0.156e0 + 10)), 0) AS BIGINT) AS count FROM events WHERE class IN ('del', 'ins')""")
def spikes(spark, sf_dir):
    return t.spike_correction(t.all_events(called(spark, sf_dir)))


@query(f"WITH {READ_SQL} SELECT sample, qname, modification, start, length, count(*) AS n FROM indel_reads GROUP BY ALL")
def indels_per_read(spark, sf_dir):
    return indel_reads(spark, sf_dir).groupBy("sample", "qname", "modification", "start", "length").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {READ_SQL} SELECT sample, start, length, modification, freq, round(freq * 100.0 / sum(freq) OVER (PARTITION BY sample), 6) AS perc FROM geno")
def genotype_freq(spark, sf_dir):
    return t.genotypes(indel_reads(spark, sf_dir)).withColumn("perc", F.round("perc", 6))


PEAK_SQL = READ_SQL + """,
touched AS (SELECT DISTINCT sample, unnest(range(start, start + length + 1)) AS p FROM geno WHERE modification = 'del'),
runs AS (SELECT sample, min(p) AS first, max(p) AS last FROM (SELECT *, p - row_number() OVER (PARTITION BY sample ORDER BY p) AS island FROM touched) GROUP BY sample, island),
peak AS (SELECT sample, first, last FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY last - first DESC, first) AS k FROM runs) WHERE k = 1),
in_peak AS (SELECT g.sample, start, length, modification FROM geno g JOIN peak USING (sample) WHERE start > first + 1 AND start < last)"""


@query(f"WITH {PEAK_SQL} SELECT sample, start, length, modification FROM in_peak")
def peak_filter(spark, sf_dir):
    return t.peak_filter(indel_reads(spark, sf_dir))


ERROR_SQL = PEAK_SQL + "," + b.READS_SQL + """,
bound AS (SELECT i.*, r.seq, r.qual, regexp_extract_all(raw_cigar, '([0-9]+)([MIDNSHP=X])', 2) AS rk,
    list_transform(regexp_extract_all(raw_cigar, '([0-9]+)([MIDNSHP=X])', 1), lambda x: CAST(x AS BIGINT)) AS rl
  FROM indel_reads i LEFT JOIN reads r ON r.doc_id = i.l_partkey % (SELECT count(*) FROM documents) AND r.read_no = i.l_orderkey % r.n_reads),
placed AS (SELECT *, coalesce(list_sum(rl[1:list_position(rk, CASE WHEN modification = 'del' THEN 'D' ELSE 'I' END) - 1]), 0) AS off FROM bound WHERE modification IN ('del', 'ins')),
errs AS (SELECT sample, start, length, modification, count(*) AS n,
    avg(pow(10, -(ascii(nullif(substr(qual, CAST(off AS BIGINT), 1), '')) - 33) / 10.0)) AS e0, avg(pow(10, -(ascii(nullif(substr(qual, CAST(off AS BIGINT) + 1, 1), '')) - 33) / 10.0)) AS e1
  FROM placed GROUP BY ALL),
edited AS (SELECT sample, count(*) AS edited FROM indel_reads GROUP BY sample),
above AS (SELECT e.sample, start, length, modification FROM errs e JOIN edited USING (sample) JOIN wild USING (sample)
  WHERE CAST(n AS DOUBLE) / (edited + wt) > CASE WHEN modification = 'del' THEN least(e0, e1) ELSE e0 END)"""


def above_error(spark, sf_dir, calls=None):
    calls = calls or Calls(spark, sf_dir)
    return t.error_filter(read_of(calls.reads(), spark, sf_dir), calls.wild_type())


@query(f"WITH {ERROR_SQL} SELECT sample, start, length, modification FROM above")
def error_rate(spark, sf_dir):
    return above_error(spark, sf_dir)


def flagged(spark, sf_dir, calls=None):
    calls = calls or Calls(spark, sf_dir)
    return t.flag_reads(calls.reads(), above_error(spark, sf_dir, calls), t.peak_filter(calls.genotypes()))


FLAG_SQL = ERROR_SQL + """,
flagged AS (SELECT i.*, a.sample IS NOT NULL AS above_error_rate, p.sample IS NOT NULL AS in_pick FROM indel_reads i
  LEFT JOIN above a ON a.sample = i.sample AND a.start = i.start AND a.length = i.length AND a.modification = i.modification
  LEFT JOIN in_peak p ON p.sample = i.sample AND p.start = i.start AND p.length = i.length AND p.modification = i.modification)"""


@query(f"""WITH {FLAG_SQL}, pl AS (SELECT sample, CAST(coalesce(sum(n) FILTER (WHERE class = 'wt'), 0) AS BIGINT) AS wt, CAST(coalesce(sum(n) FILTER (WHERE class = 'bad_wt'), 0) AS BIGINT) AS bad_wt,
  CAST(coalesce(sum(n) FILTER (WHERE class = 'bad_alignment'), 0) AS BIGINT) AS trunc_reads FROM called GROUP BY sample)
SELECT sample, any_value(wt) AS wt, any_value(bad_wt) AS bad_wt, any_value(trunc_reads) AS trunc_reads,
  count(*) FILTER (WHERE above_error_rate AND in_pick) AS above_in, count(*) FILTER (WHERE above_error_rate AND NOT in_pick) AS above_out,
  count(*) FILTER (WHERE NOT above_error_rate AND in_pick) AS below_in, count(*) FILTER (WHERE NOT above_error_rate AND NOT in_pick) AS below_out
FROM flagged JOIN pl USING (sample) GROUP BY sample""")
def qc_crosstab(spark, sf_dir):
    calls = Calls(spark, sf_dir)
    return t.qc_crosstab(calls.samples(), flagged(spark, sf_dir, calls), calls.called)


@query(f"""WITH {READ_SQL}, d AS (SELECT DISTINCT start, length, substr('{A}', start, length) AS gone, substr('{A}', 1, start - 1) AS l, substr('{A}', start + length) AS r FROM geno WHERE modification = 'del'),
h AS (SELECT *, len(list_filter(range(1, least(len(l), length) + 1), lambda k: right(l, k) = right(gone, k))) AS n, len(list_filter(range(1, least(len(r), length) + 1), lambda k: left(r, k) = left(gone, k))) AS m FROM d),
c AS (SELECT *, greatest(n - CASE WHEN n = len(l) THEN 1 ELSE 0 END, 0) AS n2, greatest(m - CASE WHEN m = len(r) THEN 1 ELSE 0 END, 0) AS m2 FROM h)
SELECT start, length, CASE WHEN n2 = 0 AND m2 = 0 THEN 'NHEJ' WHEN m2 > n2 THEN left(r, m2) ELSE right(l, n2) END AS pattern FROM c""")
def homology(spark, sf_dir):
    dels = indel_reads(spark, sf_dir).filter("modification = 'del'").select("start", "length").distinct()
    return t.homology(dels, A)


CONTEXT_SQL = ERROR_SQL + """,
context AS (SELECT *, substr(seq, CAST(greatest(off + 1 - least(off, 3), 1) AS BIGINT), CAST(least(off, 3) AS BIGINT)) AS pre_ins_nt, substr(seq, CAST(off + 1 AS BIGINT), length) AS ins_nt, substr(seq, CAST(off + 1 + length AS BIGINT), 3) AS post_ins_nt FROM placed WHERE modification = 'ins')"""


def insertions(spark, sf_dir, calls=None):
    return t.insertion_context(read_of(indel_reads(spark, sf_dir, calls).filter("modification = 'ins'"), spark, sf_dir))


@query(f"WITH {CONTEXT_SQL} SELECT sample, start, length, pre_ins_nt, ins_nt, post_ins_nt, count(*) AS n FROM context GROUP BY ALL")
def insertion_context(spark, sf_dir):
    return insertions(spark, sf_dir).groupBy("sample", "start", "length", "pre_ins_nt", "ins_nt", "post_ins_nt").agg(F.count(F.lit(1)).alias("n"))


def guides_of_amplicon(spark, sf_dir):
    """Every 20-base guide of either strand, one a supplier."""
    key = (F.col("s_suppkey") % (len(A) - 19) + 1).cast("int")
    cut = lambda ref: F.lit(ref).substr(key, F.lit(20)) if isinstance(ref, str) else ref.substr(key, F.lit(20))
    guide = F.when(F.col("s_suppkey") % 2 == 0, cut(A)).otherwise(cut(q.revcomp(F.lit(A))))
    return b.table(spark, sf_dir, "supplier").select("s_suppkey", guide.alias("guide"))


def cut_sql(rel: int) -> str:
    fwd = f"f + {rel} - 1" if rel > 0 else f"f + 20 + {rel} - 1"
    back = f"{len(A)} - (r + 19) + (20 - {rel})" if rel > 0 else f"{len(A)} - (r + 19) - ({rel})"
    return f"""WITH ref AS (SELECT '{A}' AS a, reverse(translate('{A}', 'ACGT', 'TGCA')) AS z),
g AS (SELECT s_suppkey, substr(CASE WHEN s_suppkey % 2 = 0 THEN a ELSE z END, s_suppkey % {len(A) - 19} + 1, 20) AS guide, a, z FROM supplier, ref),
p AS (SELECT *, instr(a, guide) AS f, instr(z, guide) AS r FROM g)
SELECT s_suppkey, guide, CAST(CASE WHEN f > 0 THEN {fwd} WHEN r > 0 THEN {back} END AS INTEGER) AS cut_site FROM p"""


@query(cut_sql(-3))
def cut_site(spark, sf_dir):
    return t.cut_site(guides_of_amplicon(spark, sf_dir), F.lit(A))


@query(cut_sql(17))
def cut_site_positive(spark, sf_dir):
    return t.cut_site(guides_of_amplicon(spark, sf_dir), F.lit(A), 17)


EDIT_SQL = READ_SQL + """,
tpl AS (SELECT qname FROM indel_reads WHERE l_partkey % 50 = 0),
edits AS (SELECT w.sample, wt, (SELECT count(*) FROM indel_reads i WHERE i.sample = w.sample AND l_partkey % 50 = 0) AS template_based,
  count(*) FILTER (WHERE modification = 'delin') AS delins, count(*) FILTER (WHERE modification = 'ins' AND length % 3 = 0) AS ins_inframe, count(*) FILTER (WHERE modification = 'ins' AND length % 3 <> 0) AS ins_outframe,
  count(*) FILTER (WHERE modification = 'del' AND length % 3 = 0) AS dels_inframe, count(*) FILTER (WHERE modification = 'del' AND length % 3 <> 0) AS dels_outframe
  FROM wild w LEFT JOIN (SELECT * FROM indel_reads WHERE qname NOT IN (SELECT qname FROM tpl)) r USING (sample) GROUP BY w.sample, wt)"""


def edits(spark, sf_dir, calls=None):
    calls = calls or Calls(spark, sf_dir)
    rows = calls.reads()
    return t.edit_summary(calls.samples(), rows, calls.wild_type(), rows.filter("l_partkey % 50 = 0"))


@query(f"WITH {EDIT_SQL} SELECT sample, wt, template_based, delins, ins_inframe, ins_outframe, dels_inframe, dels_outframe FROM edits")
def edit_summary(spark, sf_dir):
    return edits(spark, sf_dir)


PCT_SQL = """,
pct AS (SELECT *, wt + template_based + delins + ins_inframe + ins_outframe + dels_inframe + dels_outframe AS total FROM edits),
pc AS (SELECT *, wt * 100.0 / total AS pct_wt, (dels_inframe + dels_outframe) * 100.0 / total AS pct_dels, (ins_inframe + ins_outframe) * 100.0 / total AS pct_ins, delins * 100.0 / total AS pct_delins,
  (ins_inframe + dels_inframe) * 100.0 / total AS pct_inframe, (ins_outframe + dels_outframe) * 100.0 / total AS pct_outframe FROM pct),
zy AS (SELECT *, CASE WHEN pct_wt > 80 THEN 'Hom WT' WHEN pct_wt BETWEEN 40 AND 60 THEN 'Het NHEJ' WHEN pct_wt < 20 THEN 'Hom NHEJ' ELSE 'Ambiguous' END AS classification FROM pc)"""
PCTS = ["pct_wt", "pct_dels", "pct_ins", "pct_delins", "pct_inframe", "pct_outframe"]


@query(f"WITH {EDIT_SQL}{PCT_SQL} SELECT sample, total, classification, {', '.join(f'round({c}, 6) AS {c}' for c in PCTS)} FROM zy")
def zygosity(spark, sf_dir):
    rows = t.percentages(edits(spark, sf_dir))
    return rows.select("sample", "total", "classification", *[F.round(c, 6).alias(c) for c in PCTS])


@query(f"""WITH {CONTEXT_SQL}, {EDIT_SQL.replace(READ_SQL + ',', '')}{PCT_SQL},
grp AS (SELECT sample, count(*) AS n FROM indel_reads WHERE modification IN ('del', 'delin') GROUP BY sample, modification, start, length
  UNION ALL SELECT sample, count(*) FROM context WHERE pre_ins_nt NOT LIKE '%N%' AND ins_nt NOT LIKE '%N%' AND post_ins_nt NOT LIKE '%N%' GROUP BY sample, start, length, pre_ins_nt, ins_nt, post_ins_nt),
pk AS (SELECT g.sample, count(*) AS peaks, max(CAST(n AS DOUBLE) / total) AS max_peak, sum(CAST(n AS DOUBLE) / total) AS occupancy FROM grp g JOIN zy USING (sample) WHERE CAST(n AS DOUBLE) / total > 0.05 GROUP BY g.sample),
j AS (SELECT zy.*, coalesce(peaks, 0) AS peaks, coalesce(max_peak, 0) AS max_peak, round(coalesce(occupancy, 0), 12) AS occ FROM zy LEFT JOIN pk USING (sample)),
k AS (SELECT *, CASE WHEN total < 200 THEN 'Insufficient data for analysis' WHEN pct_wt > 85 THEN 'Low editing activity' WHEN max_peak > 0.85 THEN 'Clonal' WHEN peaks = 1 AND max_peak > 0.4 AND pct_wt > 0.4 THEN 'Clonal'
  WHEN peaks = 2 AND occ >= 0.8 THEN 'Clonal' WHEN peaks IN (1, 2) AND occ > 0.75 THEN 'Likely clonal with minor background variants' WHEN peaks > 2 AND occ - max_peak > 0.4 THEN 'Polyclonal' ELSE 'Ambiguous' END AS clonality,
  CASE WHEN total < 200 THEN 'Ambiguous' ELSE classification END AS cls FROM j)
SELECT sample, cls AS classification, CASE WHEN total < 200 THEN 0 ELSE peaks END AS peaks, round(max_peak, 6) AS max_peak, clonality,
  round(CASE WHEN cls <> 'Ambiguous' THEN greatest(0, greatest(0, 1 - abs(pct_wt - CASE cls WHEN 'Hom WT' THEN 100 WHEN 'Het NHEJ' THEN 50 ELSE 0 END) * CASE cls WHEN 'Het NHEJ' THEN 0.5 ELSE 1 END / 100) - CASE WHEN total < 3000 THEN (3000 - total) / 3000.0 * 0.1 ELSE 0 END) END, 6) AS confidence FROM k""")
def clonality(spark, sf_dir):
    calls = Calls(spark, sf_dir)
    rows = materialize(t.percentages(edits(spark, sf_dir, calls)), "edits")  # one row a sample, read twice
    out = t.clonality(rows, t.indel_groups(calls.reads(), insertions(spark, sf_dir, calls)))
    return out.select("sample", "classification", F.col("peaks").cast("bigint").alias("peaks"), F.round("max_peak", 6).alias("max_peak"), "clonality", F.round("confidence", 6).alias("confidence"))


SUB_SQL = b.ALIGN_SQL + "," + b.READS_SQL + """,
whole AS (SELECT o.sample, o.qname, o.pos, r.seq, r.qual, regexp_extract_all(raw_cigar, '([0-9]+)([MIDNSHP=X])', 2) AS rk,
    list_transform(regexp_extract_all(raw_cigar, '([0-9]+)([MIDNSHP=X])', 1), lambda x: CAST(x AS BIGINT)) AS rl
  FROM ops o JOIN reads r ON r.doc_id = o.l_partkey % (SELECT count(*) FROM documents) AND r.read_no = o.l_orderkey % r.n_reads),
op AS (SELECT sample, pos, seq, qual, rk[k] AS kind, rl[k] AS len, coalesce(list_sum(list_transform(range(1, k), lambda i: CASE WHEN rk[i] IN ('M', 'D', 'N') THEN rl[i] ELSE 0 END)), 0) AS ref_at,
    coalesce(list_sum(list_transform(range(1, k), lambda i: CASE WHEN rk[i] IN ('M', 'I', 'S') THEN rl[i] ELSE 0 END)), 0) AS read_at FROM (SELECT *, unnest(range(1, len(rk) + 1)) AS k FROM whole)),
placed_bases AS (SELECT *, unnest(range(len)) AS i FROM op WHERE kind = 'M'),
based AS (SELECT sample, CAST(pos + ref_at + i AS BIGINT) AS pos, substr(seq, CAST(read_at + i + 1 AS BIGINT), 1) AS nucleotide, ascii(substr(qual, CAST(read_at + i + 1 AS BIGINT), 1)) - 33 AS q FROM placed_bases WHERE read_at + i < length(seq)),
depth AS (SELECT sample, pos, nucleotide, count(*) AS n FROM based WHERE q >= 10 GROUP BY ALL),
prof AS (SELECT sample, pos, nucleotide, round_even(n * 100.0e0 / sum(n) OVER (PARTITION BY sample, pos), 2) AS percentage FROM depth WHERE n >= 4)"""


def profile(spark, sf_dir):
    rows = read_of(b.alignments(spark, sf_dir), spark, sf_dir).filter("seq is not null").withColumn("mapq", F.lit(60))
    return t.substitutions(rows.select("sample", "pos", "raw_cigar", "seq", "qual", "mapq"))


@query(f"WITH {SUB_SQL} SELECT sample, pos, nucleotide, percentage FROM prof")
def substitutions(spark, sf_dir):
    return profile(spark, sf_dir)


@query(f"""WITH {SUB_SQL} SELECT sample, pos, {', '.join(f"CASE WHEN coalesce(max(percentage) FILTER (WHERE nucleotide = '{c}'), 100) = 100 THEN 0 ELSE max(percentage) FILTER (WHERE nucleotide = '{c}') END AS {c}" for c in 'ACGT')}
FROM prof WHERE pos BETWEEN 35 AND 85 GROUP BY sample, pos""")
def logo_matrix(spark, sf_dir):
    return t.logo_matrix(profile(spark, sf_dir), 60)


@query(f"""WITH {READ_SQL}, spread AS (SELECT sample, modification, freq, unnest(range(start, start + length + 1)) AS p FROM geno WHERE modification IN ('del', 'ins')),
s AS (SELECT sample, modification, p, CAST(sum(freq) AS BIGINT) AS n FROM spread GROUP BY ALL) SELECT *, round(n * 100.0 / sum(n) OVER (PARTITION BY sample, modification), 6) AS pct FROM s""")
def indel_hist(spark, sf_dir):
    return t.position_histogram(indel_reads(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


@query(f"""WITH {READ_SQL}, v AS (SELECT sample, start || '_' || modification || '_' || length AS variant, freq AS n FROM geno UNION ALL SELECT sample, 'wt', wt FROM wild)
SELECT sample, variant, n, k FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sample ORDER BY n DESC, variant) AS INTEGER) AS k FROM v) WHERE k <= 5""")
def unique_variants(spark, sf_dir):
    return t.unique_variants(indel_reads(spark, sf_dir), t.wild_type_counts(called(spark, sf_dir)))


@query(f"""WITH {READ_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY freq DESC, modification, start, length) AS k FROM geno WHERE modification IN ('del', 'ins'))
SELECT sample, CAST(k AS INTEGER) AS k, CASE WHEN modification = 'del' THEN substr('{A}', 1, start - 1) || repeat('-', length) || substr('{A}', start + length) ELSE substr('{A}', 1, start - 1) || repeat('N', length) || substr('{A}', start) END AS allele FROM o WHERE k <= 10""")
def top_alleles(spark, sf_dir):
    return t.alleles(t.genotypes(indel_reads(spark, sf_dir)), A).select("sample", "k", "allele")


@query(f"""WITH {b.ALIGN_SQL}, tp(sample, pos, cigar) AS (VALUES (0, 1, '100M'), (1, 2, '40M3D60M'), (2, 3, '50M6I50M'), (3, 1, '45M4D1M2I55M')),
m AS (SELECT o.* FROM ops o JOIN tp ON o.sample = tp.sample AND o.pos = tp.pos AND o.cigar = tp.cigar)
SELECT sample, CASE WHEN len(kinds) = 1 THEN 'no-changes' WHEN len(kinds) > 3 THEN 'delin' WHEN kinds[2] = 'I' AND lens[2] % 3 = 0 THEN 'ins-in' WHEN kinds[2] = 'I' THEN 'ins-out' WHEN kinds[2] = 'D' AND lens[2] % 3 = 0 THEN 'dels-in' WHEN kinds[2] = 'D' THEN 'dels-out' ELSE 'subs' END AS kind, count(*) AS n FROM m GROUP BY 1, 2""")
def template_count(spark, sf_dir):
    rows = [(0, 1, "100M"), (1, 2, "40M3D60M"), (2, 3, "50M6I50M"), (3, 1, "45M4D1M2I55M")]
    templates = spark.createDataFrame(rows, "sample bigint, pos bigint, cigar string")
    return t.template_counts(aligned(spark, sf_dir), templates)


# Reads


@query(f"""WITH {b.READS_SQL}, e AS (SELECT sample, CAST(i AS INTEGER) AS cycle, substr(seq, i, 1) AS b, ascii(substr(qual, i, 1)) - 33 AS q FROM reads, range(1, 151) r(i) WHERE i <= len(seq))
SELECT sample, cycle, count(*) AS reads, round(avg(q), 6) AS mean_quality, round(avg(CASE WHEN b IN ('G', 'C') THEN 1.0 ELSE 0 END), 6) AS gc FROM e GROUP BY 1, 2""")
def fastq_qc(spark, sf_dir):
    rows = t.base_quality(b.reads(spark, sf_dir))
    return rows.select("sample", "cycle", "reads", F.round("mean_quality", 6).alias("mean_quality"), F.round("gc", 6).alias("gc"))


@query(f"""WITH {b.READS_SQL}, c AS (SELECT sample, substr(seq, 1, 8) AS seq, count(*) AS n FROM reads GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY sample) AS BIGINT) AS total FROM c) WHERE n > 0.03 * total""")
def overrepresented(spark, sf_dir):
    return t.overrepresented(b.reads(spark, sf_dir), 0.03, 8)


@query(f"""WITH {b.READS_SQL} SELECT read_id, CASE WHEN instr(seq, 'ACGT') > 0 THEN substr(seq, instr(seq, 'ACGT') + 4) ELSE seq END AS five, CASE WHEN instr(seq, 'TTGC') > 0 THEN substr(seq, 1, instr(seq, 'TTGC') - 1) ELSE seq END AS three FROM reads""")
def adapter_trim_exact(spark, sf_dir):
    seq = F.col("seq")
    return b.reads(spark, sf_dir).select("read_id", t.trim_adapter(seq, "ACGT", 5).alias("five"), t.trim_adapter(seq, "TTGC", 3).alias("three"))


ADAPTERS = ["ACGTTGCA", "CTTACG"]
ADAPTER_SQL = b.READS_SQL + f""",
adapters AS (SELECT * FROM (VALUES {", ".join(f"({k}, '{x}')" for k, x in enumerate(ADAPTERS))}) v(k, a)),
laid AS (SELECT read_id, side, k, i, len(x) AS size, least(len(a), len(x) - i) AS n, len(list_filter(range(1, least(len(a), len(x) - i) + 1), lambda j: substr(x, i + j, 1) <> substr(y, j, 1))) AS wrong
  FROM (SELECT read_id, side, k, a, CASE side WHEN 3 THEN seq ELSE reverse(seq) END AS x, CASE side WHEN 3 THEN a ELSE reverse(a) END AS y, unnest(range(0, len(seq) - 2)) AS i FROM reads, adapters, (VALUES (3), (5)) v(side))),
found AS (SELECT read_id, side, k, i, row_number() OVER (PARTITION BY read_id, side ORDER BY n - wrong DESC, wrong, i, k) AS place FROM laid WHERE wrong <= floor(0.2 * n + 1e-9))"""


@query(f"""WITH {ADAPTER_SQL} SELECT r.read_id, side, CAST(f.k AS INTEGER) AS adapter, CASE WHEN f.i IS NULL THEN seq WHEN side = 3 THEN left(seq, f.i) ELSE right(seq, f.i) END AS seq
FROM (SELECT * FROM reads, (VALUES (3), (5)) v(side)) r LEFT JOIN (SELECT * FROM found WHERE place = 1) f USING (read_id, side)""")
def adapter_trim(spark, sf_dir):
    """Several adapters with mismatches and partial ends, at either end of the reads."""
    reads = b.reads(spark, sf_dir).select("read_id", "seq")
    parts = [t.trim_adapters(reads, ADAPTERS, end, 0.2).withColumn("side", F.lit(end)) for end in (3, 5)]
    return parts[0].unionByName(parts[1]).select("read_id", "side", "adapter", "seq")


#: Every stretch of a read against an adapter, or its end against an adapter's beginning.
INDEL_SQL = b.READS_SQL + f""",
adapters AS (SELECT * FROM (VALUES {", ".join(f"({k}, '{x}')" for k, x in enumerate(ADAPTERS))}) v(k, a)),
sided AS (SELECT read_id, side, k, CASE side WHEN 3 THEN seq ELSE reverse(seq) END AS x, CASE side WHEN 3 THEN a ELSE reverse(a) END AS y FROM reads, adapters, (VALUES (3), (5)) v(side)),
starts AS (SELECT *, unnest(range(0, len(x))) AS i FROM sided),
laid AS (SELECT read_id, side, k, i, len(y) AS n, levenshtein(substr(x, i + 1, size), y) AS wrong FROM starts, (VALUES (-1), (0), (1)) d(d), (SELECT len(y) + d AS size) WHERE i + size <= len(x)
  UNION ALL SELECT read_id, side, k, i, n, levenshtein(substr(x, i + 1), left(y, n)) FROM starts, (VALUES (-1), (0), (1)) d(d), (SELECT len(x) - i + d AS n) WHERE n BETWEEN 3 AND len(y)),
found AS (SELECT read_id, side, k, i, row_number() OVER (PARTITION BY read_id, side ORDER BY n - wrong DESC, wrong, i, k) AS place FROM laid WHERE wrong <= floor(0.2 * n + 1e-9))"""


@query(f"""WITH {INDEL_SQL} SELECT r.read_id, side, CAST(f.k AS INTEGER) AS adapter, CASE WHEN f.i IS NULL THEN seq WHEN side = 3 THEN left(seq, f.i) ELSE right(seq, f.i) END AS seq
FROM (SELECT * FROM reads, (VALUES (3), (5)) v(side)) r LEFT JOIN (SELECT * FROM found WHERE place = 1) f USING (read_id, side)""")
def adapter_trim_indels(spark, sf_dir):
    """As adapter_trim, but bases of an adapter may be missing and others may stand between."""
    reads = b.reads(spark, sf_dir).select("read_id", "seq")
    parts = [t.trim_adapters(reads, ADAPTERS, end, 0.2, indels=True).withColumn("side", F.lit(end)) for end in (3, 5)]
    return parts[0].unionByName(parts[1]).select("read_id", "side", "adapter", "seq")


@query(f"""WITH {b.READS_SQL} SELECT read_id, list_aggregate(list_transform(range(1, len(seq) + 1), lambda i: CASE WHEN ascii(substr(qual, i, 1)) - 33 < 20 THEN 'N' ELSE substr(seq, i, 1) END), 'string_agg', '') AS seq FROM reads WHERE len(seq) >= 80""")
def quality_mask(spark, sf_dir):
    return t.quality_mask(b.reads(spark, sf_dir)).select("read_id", "seq")


@query(f"WITH {b.READS_SQL} SELECT read_id, seq, repeat('#', len(seq)) AS qual FROM reads")
def fake_quality(spark, sf_dir):
    return b.reads(spark, sf_dir).select("read_id", "seq", F.repeat(F.lit("#"), F.length("seq")).alias("qual"))


@query(f"WITH {b.READS_SQL} SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq FROM reads")
def revcomp(spark, sf_dir):
    return b.reads(spark, sf_dir).select("read_id", q.revcomp(F.col("seq")).alias("seq"))


@query(f"""WITH {b.READS_SQL.replace("reads AS (", "reads AS MATERIALIZED (")}, m AS (SELECT * FROM reads WHERE len(seq) >= 80), u AS (SELECT * FROM m WHERE instr(seq, 'ACGT') > 0),
s AS (SELECT sample, 'raw-reads' AS stage, count(*) AS n FROM reads GROUP BY 1 UNION ALL SELECT sample, 'quality-filtered-reads', count(*) FROM m GROUP BY 1 UNION ALL SELECT sample, 'reads-with-adapters', count(*) FROM u GROUP BY 1)
SELECT sample, stage, s.n, round_even(s.n * 100.0e0 / x.n, 1) AS pct FROM s JOIN (SELECT sample, n FROM s WHERE stage = 'raw-reads') x USING (sample)""")
def stage_summary(spark, sf_dir):
    raw = b.reads(spark, sf_dir)
    masked = t.quality_mask(raw)
    found = raw.filter(F.length("seq") >= 80).filter(F.col("seq").contains("ACGT"))
    return t.stage_summary([("raw-reads", raw), ("quality-filtered-reads", masked), ("reads-with-adapters", found)])


@query(f"""WITH {b.READS_SQL}, lib AS (SELECT 'l' || i AS guide, 'gene' || (i % 7) AS gene, array_to_string([['A', 'C', 'G', 'T'][1 + (i // 4 ** k)::BIGINT % 4] FOR k IN range(0, 5)], '') AS sequence FROM range(0, 1024) r(i)),
f AS (SELECT guide, gene, sample, count(*) AS n FROM reads JOIN lib ON substr(seq, 6, 5) = sequence GROUP BY ALL)
SELECT lib.guide, lib.gene, s.sample, coalesce(n, 0) AS count FROM lib CROSS JOIN (SELECT DISTINCT sample FROM f) s LEFT JOIN f ON f.guide = lib.guide AND f.sample = s.sample""".replace("(i // 4 ** k)::BIGINT", "CAST(floor(i / pow(4, k)) AS BIGINT)"))
def guide_count(spark, sf_dir):
    from editlake.operators.screening import count_guides

    i = F.col("id")
    bases = F.array(*[F.lit(c) for c in "ACGT"])
    seq = F.concat(*[F.get(bases, (F.floor(i / 4**k) % 4).cast("int")) for k in range(5)])
    lib = spark.range(1024).select(F.concat(F.lit("l"), i.cast("string")).alias("guide"), F.concat(F.lit("gene"), (i % 7).cast("string")).alias("gene"), seq.alias("sequence"))
    return count_guides(b.reads(spark, sf_dir), lib, 5, 5)


#: The amplicon with three bases changed, a deletion of six bases that fits one place only, and an insertion of six.
CHANGED = A[:40] + A[40:43].translate(str.maketrans("ACGT", "TGCA")) + A[43:]
GONE, PUT = 31, "TGTGTG"
TEMPLATES = [CHANGED[1:101], A[:GONE] + A[GONE + 6 : 100 + 6], A[2 : 2 + 50] + PUT + A[52:102], A[:100]]


@query(f"""SELECT s_suppkey, CAST(1 + s_suppkey % 3 AS BIGINT) AS pos, CASE WHEN s_suppkey % 2 = 0 THEN '100M' ELSE ({GONE} - s_suppkey % 3)::BIGINT || 'M6D55M' END AS cigar FROM supplier""")
def template_align(spark, sf_dir):
    """Templates with changed bases, or with a deletion, on the amplicon."""
    p = 1 + F.col("s_suppkey") % 3
    changed = F.lit(CHANGED).substr(p.cast("int"), F.lit(100))
    gone = F.concat(F.lit(A).substr(p.cast("int"), (GONE + 1 - p).cast("int")), F.lit(A[GONE + 6 : GONE + 61]))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, changed).otherwise(gone).alias("template"), F.lit(A).alias("reference"))
    return t.template_alignments(rows).select("s_suppkey", F.col("pos").cast("bigint").alias("pos"), "cigar")


TEMPLATE_READS_SQL = f"""{b.ALIGN_SQL},
lettered AS (SELECT *, substr(CASE WHEN l_partkey % 5 = 0 THEN '{CHANGED}' ELSE '{A}' END, pos, CASE cigar WHEN '60M' THEN 60 ELSE 100 END) AS body FROM ops),
borne AS (SELECT sample, qname, 'subs' AS kind FROM lettered WHERE sample = 0 AND len(kinds) = 1 AND substr(body, 42 - pos, 3) = '{CHANGED[40:43]}' AND EXISTS (SELECT 1 FROM ops WHERE sample = 0 AND pos = 2 AND cigar = '100M')
  UNION ALL SELECT sample, qname, 'dels-in' FROM ops WHERE sample = 1 AND pos = 1 AND cigar = '{GONE}M6D{100 - GONE}M'
  UNION ALL SELECT sample, qname, 'ins-in' FROM ops WHERE sample = 2 AND pos = 3 AND cigar = '50M6I50M')"""


@query(f"WITH {TEMPLATE_READS_SQL} SELECT sample, qname, kind FROM borne")
def template_reads(spark, sf_dir):
    """Reads with the template's edit: changed bases in sample 0, a deletion in 1, an insertion in 2; sample 3's template changes nothing."""
    templates = spark.createDataFrame([(k, x, A) for k, x in enumerate(TEMPLATES)], "sample bigint, template string, reference string")
    letters = F.when(F.col("l_partkey") % 5 == 0, F.lit(CHANGED)).otherwise(F.lit(A))
    clipped = F.when(F.col("raw_cigar").startswith("5S"), F.lit("GGGGG")).otherwise(F.lit(""))
    body = letters.substr(F.col("pos").cast("int"), F.when(F.col("cigar") == "60M", 60).otherwise(100))
    return t.template_reads(aligned(spark, sf_dir).withColumn("seq", F.concat(clipped, body)), t.template_alignments(templates))


RUN_SQL = f"""{b.READS_SQL.replace("reads AS (", "reads AS MATERIALIZED (")},
c AS (SELECT sample, count(*) AS raw, count(*) FILTER (WHERE len(seq) >= 80) AS filtered, count(*) FILTER (WHERE len(seq) >= 100 AND len(sample) % 2 = 0) AS merged,
  count(*) FILTER (WHERE instr(seq, 'ACGT') > 0) AS adapters, count(DISTINCT left(seq, 6)) AS clustered, count(*) FILTER (WHERE instr(seq, 'CA') > 0) AS aligned FROM reads GROUP BY sample),
d AS (SELECT *, CASE WHEN merged > 0 THEN merged ELSE raw END AS base FROM c WHERE filtered > 0),
lines AS (SELECT sample, unnest([0, 1, 2, 3, 4, 5]) AS step, unnest(['raw-reads', 'merged-reads', 'reads-with-adapters', 'quality-filtered-reads', 'clustered-reads', 'aligned-reads']) AS class,
  unnest([raw, merged, adapters, filtered, clustered, aligned]) AS n, unnest([raw, raw, base, base, NULL, raw]) AS total FROM d)"""


@query(f"WITH {RUN_SQL} SELECT sample, step, class, n, round_even(n * 100.0e0 / total, 1) AS pct FROM lines")
def run_summary(spark, sf_dir):
    """A sample's reads through a run: merged in every other sample, clustered by their first six bases."""
    raw = b.reads(spark, sf_dir)
    merged = raw.filter((F.length("seq") >= 100) & (F.length("sample") % 2 == 0))
    clustered = raw.select("sample", F.left("seq", F.lit(6)).alias("first")).distinct()
    laid = raw.select("sample", F.col("seq").contains("CA").alias("mapped"))
    return t.run_summary(raw, t.quality_mask(raw), merged, raw.filter(F.col("seq").contains("ACGT")), clustered, laid)
