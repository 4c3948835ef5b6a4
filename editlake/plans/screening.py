"""Registered screening queries over the bindings, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editlake.functions import stats
from editlake.operators import resampling as r
from editlake.operators import screening as s
from editlake.scratch import materialize

from . import bindings as b

H = b.HALF_WINDOW
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Doubles to 6 decimals, for comparison."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 with treatment counts of essential guides halved."""
    full = s.count_matrix(b.guides(spark, sf_dir), b.observed_counts(spark, sf_dir))
    halve = (F.col("part_type") == b.ESSENTIAL) & F.col("sample").isin(b.TREATMENT)
    return full.withColumn("count", F.when(halve, F.floor(F.col("count") / 2)).otherwise(F.col("count")).cast("bigint"))


def gene_set(spark: SparkSession, sf_dir: str, part_type: str) -> DataFrame:
    return b.guides(spark, sf_dir).filter(F.col("part_type") == part_type).select("gene").distinct()


NORM_SQL = b.COUNTS_SQL + """,
norm AS (SELECT *, count * 1e7 / sum(count) OVER (PARTITION BY sample) AS norm FROM counts)"""
FC_SQL = NORM_SQL + """,
fc AS (SELECT guide, gene, CAST(i AS INTEGER) AS replicate, CAST(c.count AS DOUBLE) AS raw_control, log2((t.norm + 5) / (c.norm + 5)) AS fc
       FROM (VALUES (0, 'AF', 'RF'), (1, 'AO', 'RO')) p(i, cs, ts)
       JOIN norm c ON c.sample = cs JOIN norm t USING (guide, gene) WHERE t.sample = ts)"""


def eb_sql(start: str) -> str:
    return start + f""",
ordered AS (SELECT *, row_number() OVER w - 1 AS r, count(*) OVER (PARTITION BY replicate) AS n,
              stddev_samp(fc) OVER (PARTITION BY replicate ORDER BY raw_control DESC, guide ROWS BETWEEN {H} PRECEDING AND {H - 1} FOLLOWING) AS sd
            FROM fc WINDOW w AS (PARTITION BY replicate ORDER BY raw_control DESC, guide)),
bins AS (SELECT replicate, (r - {H}) // 25 AS bin, max(sd) OVER (PARTITION BY replicate ORDER BY r) AS eb_std
         FROM ordered WHERE r >= {H} AND r < n - {H} AND (r - {H}) % 25 = 0),
eb AS (SELECT o.guide, o.gene, o.replicate, o.raw_control, o.fc, b.eb_std FROM ordered o JOIN bins b
       ON o.replicate = b.replicate AND b.bin = (least(greatest(o.r, {H}), o.n - {H} - 1) - {H}) // 25),
z AS (SELECT *, fc / eb_std AS z FROM eb)"""


GENE_SQL = """,
gs AS (SELECT gene, sum(z) AS sum_z, count(*) FILTER (WHERE z <> 0) AS num_obs FROM z GROUP BY gene),
gn AS (SELECT *, (sum_z / sqrt(num_obs) - avg(sum_z / sqrt(num_obs)) OVER ()) / stddev_pop(sum_z / sqrt(num_obs)) OVER () AS norm_z FROM gs WHERE num_obs >= 1),
p AS (SELECT *, """ + stats.normal_tail_sql("-norm_z").replace("--", "- -") + """ AS pval_synth, """ + stats.normal_tail_sql("norm_z") + """ AS pval_supp FROM gn),
ranked AS (SELECT *, row_number() OVER (ORDER BY pval_synth, gene) AS rank_synth, row_number() OVER (ORDER BY pval_supp, gene) AS rank_supp, count(*) OVER () AS n FROM p)
SELECT gene, round(sum_z, 6) AS sum_z, num_obs, round(norm_z, 6) AS norm_z,
  round(pval_synth, 6) AS pval_synth, CAST(rank_synth AS INTEGER) AS rank_synth,
  round(min(pval_synth * n / rank_synth) OVER (ORDER BY rank_synth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS fdr_synth,
  round(pval_supp, 6) AS pval_supp, CAST(rank_supp AS INTEGER) AS rank_supp,
  round(min(pval_supp * n / rank_supp) OVER (ORDER BY rank_supp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS fdr_supp
FROM ranked"""


@query(f"WITH {b.COUNTS_SQL} SELECT guide, gene, sample, count FROM counts")
def count_matrix(spark, sf_dir):
    return counts(spark, sf_dir).select("guide", "gene", "sample", "count")


@query(f"WITH {NORM_SQL} SELECT guide, sample, round(norm, 6) AS norm FROM norm")
def cpm10m(spark, sf_dir):
    return rounded(s.scale_counts(counts(spark, sf_dir)), "norm").select("guide", "sample", "norm")


def changes(spark, sf_dir):
    return s.paired_changes(counts(spark, sf_dir).persist(), b.CONTROL, b.TREATMENT)  # guide-level, read four times


@query(f"WITH {FC_SQL} SELECT guide, gene, replicate, raw_control, round(fc, 6) AS fc FROM fc")
def log2_foldchange(spark, sf_dir):
    return rounded(changes(spark, sf_dir), "fc")


@query(f"WITH {eb_sql(FC_SQL)} SELECT guide, replicate, round(fc, 6) AS fc, round(eb_std, 6) AS eb_std FROM eb")
def eb_std(spark, sf_dir):
    return rounded(s.local_sd(changes(spark, sf_dir), H), "fc", "eb_std").select("guide", "replicate", "fc", "eb_std")


@query(f"WITH {eb_sql(FC_SQL)} SELECT guide, gene, replicate, round(z, 6) AS z FROM z")
def guide_z(spark, sf_dir):
    return rounded(s.guide_z(changes(spark, sf_dir), H), "z").select("guide", "gene", "replicate", "z")


@query(f"WITH {eb_sql(FC_SQL)} SELECT gene, round(sum(z), 6) AS sum_z, count(*) FILTER (WHERE z <> 0) AS num_obs FROM z GROUP BY gene")
def gene_sumz(spark, sf_dir):
    return rounded(s.gene_sums(s.guide_z(changes(spark, sf_dir), H)), "sum_z")


@query(f"""WITH {eb_sql(FC_SQL)}, gs AS (SELECT gene, sum(z) / sqrt(count(*) FILTER (WHERE z <> 0)) AS x FROM z GROUP BY gene)
SELECT gene, round((x - avg(x) OVER ()) / stddev_pop(x) OVER (), 6) AS norm_z FROM gs""")
def gene_normz(spark, sf_dir):
    return rounded(s.gene_norm(s.gene_sums(s.guide_z(changes(spark, sf_dir), H))), "norm_z").select("gene", "norm_z")


def gene_table(rows: DataFrame) -> DataFrame:
    names = ["sum_z", "norm_z", "pval_synth", "fdr_synth", "pval_supp", "fdr_supp"]
    return rounded(s.drug_scores(rows, H), *names).select(
        "gene", "sum_z", "num_obs", "norm_z", "pval_synth", "rank_synth", "fdr_synth", "pval_supp", "rank_supp", "fdr_supp"
    )


@query(f"WITH {eb_sql(FC_SQL)}{GENE_SQL}")
def drugz_paired(spark, sf_dir):
    return gene_table(changes(spark, sf_dir))


UNPAIRED_SQL = NORM_SQL + """,
fc AS (SELECT guide, gene, 0 AS replicate, avg(count) FILTER (WHERE sample IN ('AF', 'AO')) AS raw_control,
         log2((avg(norm) FILTER (WHERE sample IN ('RF', 'RO')) + 5) / (avg(norm) FILTER (WHERE sample IN ('AF', 'AO')) + 5)) AS fc
       FROM norm GROUP BY guide, gene)"""


@query(f"WITH {eb_sql(UNPAIRED_SQL)}{GENE_SQL}")
def drugz_unpaired(spark, sf_dir):
    return gene_table(s.unpaired_changes(counts(spark, sf_dir), b.CONTROL, b.TREATMENT))


REMOVED = ["Brand#11_SMALL", "Brand#12_SMALL"]
REMOVED_SQL = FC_SQL.replace("FROM counts)", "FROM counts WHERE gene NOT IN ('Brand#11_SMALL', 'Brand#12_SMALL'))")


@query(f"WITH {eb_sql(REMOVED_SQL)}{GENE_SQL}")
def drugz_remove_genes(spark, sf_dir):
    return gene_table(s.paired_changes(s.remove_genes(counts(spark, sf_dir), REMOVED), b.CONTROL, b.TREATMENT))


# Bayes factors

BFC_SQL = b.COUNTS_SQL + """,
summed AS (SELECT guide, gene, CASE WHEN sample IN ('AF', 'AO') THEN 'control' ELSE sample END AS sample, sum(count) + 5 AS count
           FROM counts WHERE sample IN ('AF', 'AO', 'RF', 'RO') GROUP BY 1, 2, 3),
scaled AS (SELECT *, count * 1e7 / sum(count) OVER (PARTITION BY sample) AS norm FROM summed),
bfc AS (SELECT x.guide, x.gene, x.sample, log2(x.norm / c.norm) AS fc FROM scaled x JOIN scaled c ON c.guide = x.guide AND c.sample = 'control'
        WHERE x.sample <> 'control')"""
GENES_SQL = f""",
ess AS (SELECT DISTINCT gene FROM guides WHERE part_type = '{b.ESSENTIAL}'),
non AS (SELECT DISTINCT gene FROM guides WHERE part_type = '{b.NONESSENTIAL}')"""


def kde_sql(name: str, genes: str) -> str:
    return f""",
{name}_x AS (SELECT fc AS x FROM bfc WHERE gene IN (SELECT gene FROM {genes})),
{name}_bw AS (SELECT count(*) AS n, pow(count(*), -0.2) * stddev_samp(x) AS bw FROM {name}_x),
{name}_kde AS (SELECT k, sum(exp(-((k / 100.0 - x) / bw) * ((k / 100.0 - x) / bw) / 2)) / (max(n) * max(bw) * 2.5066282746310002) AS d
  FROM range(-1000, 200) g(k), {name}_x, {name}_bw GROUP BY k)"""


KDE_SQL = BFC_SQL + GENES_SQL + kde_sql("e", "ess") + kde_sql("o", "non") + """,
both_kde AS (SELECT e_kde.k AS k, e_kde.d AS ess, o_kde.d AS non FROM e_kde JOIN o_kde ON e_kde.k = o_kde.k)"""
INTERVAL_SQL = KDE_SQL + """,
lim AS (SELECT pow(2, -1.1535 * ln(count(*) + 13.324) + 0.7728) AS lim FROM non),
ends AS (SELECT min(k) AS xmin, max(k) AS last FROM both_kde, lim WHERE non > lim),
inter AS (SELECT xmin, (SELECT k FROM both_kde, ends WHERE k >= xmin AND k < last AND non > 0 AND ess > 0 ORDER BY log2(ess / non), k LIMIT 1) AS xmax FROM ends)"""
LOOKUP_SQL = INTERVAL_SQL + """,
lookup AS (SELECT k, log2(ess / non) AS log_ratio FROM both_kde, inter WHERE k BETWEEN xmin AND xmax)"""
FIT_SQL = LOOKUP_SQL + """,
fit AS (SELECT regr_slope(log_ratio, k / 100.0) AS slope, regr_intercept(log_ratio, k / 100.0) AS intercept
        FROM (SELECT CAST(round_even(fc * 100, 0) AS BIGINT) AS k FROM bfc, inter WHERE fc * 100 BETWEEN xmin AND xmax) JOIN lookup USING (k))"""
BF_SQL = FIT_SQL + """,
bf AS (SELECT gene, sum(slope * fc + intercept) AS bf, count(*) AS num_obs FROM bfc, fit GROUP BY gene)"""


class Screen:
    """The Bayes-factor inputs of the bindings."""

    def __init__(self, spark, sf_dir):
        # Guide-level and read by every step below: written once.
        self.fc = materialize(s.pooled_changes(counts(spark, sf_dir), b.CONTROL, b.TREATMENT), "fold-changes")
        self.ess, self.non = (materialize(gene_set(spark, sf_dir, x), "genes") for x in (b.ESSENTIAL, b.NONESSENTIAL))

    def genes(self):
        return self.fc.select("gene").distinct()

    def both(self):
        return materialize(s.densities(self.fc, self.ess, self.non), "densities")  # one row a grid point

    def interval(self, both):
        return s.valid_interval(both, self.fc, self.non)

    def fit(self):
        both = self.both()
        ends = self.interval(both)
        return s.ratio_fit(self.fc, s.ratio_lookup(both, ends), ends)

    def bf(self):
        return s.bayes_factors(self.fc, self.fit(), ["gene"])


@query(f"WITH {BFC_SQL} SELECT guide, gene, sample, round(fc, 6) AS fc FROM bfc")
def bagel_fc(spark, sf_dir):
    return rounded(Screen(spark, sf_dir).fc, "fc")


@query(f"WITH {KDE_SQL} SELECT k, round(ess, 6) AS ess, round(non, 6) AS non FROM both_kde")
def bagel_kde(spark, sf_dir):
    return rounded(Screen(spark, sf_dir).both(), "ess", "non")


@query(f"WITH {INTERVAL_SQL} SELECT xmin, xmax FROM inter")
def bagel_interval(spark, sf_dir):
    x = Screen(spark, sf_dir)
    return x.interval(x.both())


@query(f"WITH {LOOKUP_SQL} SELECT k, round(log_ratio, 6) AS log_ratio FROM lookup")
def bagel_lookup(spark, sf_dir):
    x = Screen(spark, sf_dir)
    both = x.both()
    return rounded(s.ratio_lookup(both, x.interval(both)), "log_ratio")


@query(f"WITH {FIT_SQL} SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fit")
def bagel_linear_fit(spark, sf_dir):
    return rounded(Screen(spark, sf_dir).fit(), "slope", "intercept")


@query(f"WITH {BF_SQL} SELECT gene, round(bf, 6) AS bf, num_obs FROM bf")
def bagel_bf_nores(spark, sf_dir):
    return rounded(Screen(spark, sf_dir).bf(), "bf")


@query(f"WITH {FIT_SQL} SELECT guide, gene, round(sum(slope * fc + intercept), 6) AS bf, count(*) AS num_obs FROM bfc, fit GROUP BY guide, gene")
def bagel_bf_guide(spark, sf_dir):
    x = Screen(spark, sf_dir)
    return rounded(s.bayes_factors(x.fc, x.fit(), ["guide", "gene"]), "bf")


def resampled_sql(drawn: str) -> str:
    """Factors over the iterations of ``drawn`` (iteration, gene), beside the training tables of the screen."""
    kde = lambda name, genes: f""",
{name}_x AS (SELECT iteration, fc AS x FROM train WHERE gene IN (SELECT gene FROM {genes})),
{name}_bw AS (SELECT iteration, count(*) AS n, pow(count(*), -0.2) * stddev_samp(x) AS bw FROM {name}_x GROUP BY iteration),
{name}_kde AS (SELECT iteration, k, sum(exp(-((k / 100.0e0 - x) / bw) * ((k / 100.0e0 - x) / bw) / 2)) / (max(n) * max(bw) * 2.5066282746310002) AS d
  FROM {name}_x JOIN {name}_bw USING (iteration), range(-1000, 200) g(k) GROUP BY iteration, k)"""  # noqa: E731
    return BFC_SQL + GENES_SQL + f""",
all_genes AS (SELECT DISTINCT gene FROM bfc), {drawn},
train AS (SELECT d.iteration, bfc.gene, fc FROM bfc JOIN drawn d USING (gene))""" + kde("re", "ess") + kde("ro", "non") + """,
rboth AS (SELECT e.iteration, e.k, e.d AS ess, o.d AS non FROM re_kde e JOIN ro_kde o ON e.iteration = o.iteration AND e.k = o.k),
rlim AS (SELECT iteration, pow(2, -1.1535 * ln(count(*) + 13.324) + 0.7728) AS lim FROM drawn WHERE gene IN (SELECT gene FROM non) GROUP BY iteration),
rends AS (SELECT iteration, min(k) AS xmin, max(k) AS last FROM rboth JOIN rlim USING (iteration) WHERE non > lim GROUP BY iteration),
rinter AS (SELECT iteration, xmin, k AS xmax FROM (SELECT iteration, xmin, k, row_number() OVER (PARTITION BY iteration ORDER BY log2(ess / non), k) AS place
  FROM rboth JOIN rends USING (iteration) WHERE k >= xmin AND k < last AND non > 0 AND ess > 0) WHERE place = 1),
rfit AS (SELECT iteration, regr_slope(log2(ess / non), k / 100.0e0) AS slope, regr_intercept(log2(ess / non), k / 100.0e0) AS intercept
  FROM (SELECT iteration, CAST(round_even(fc * 100, 0) AS BIGINT) AS k FROM train JOIN rinter USING (iteration) WHERE fc * 100 BETWEEN xmin AND xmax) p
  JOIN rboth USING (iteration, k) JOIN rinter USING (iteration) WHERE k BETWEEN xmin AND xmax GROUP BY iteration),
rsum AS (SELECT iteration, gene, sum(slope * fc + intercept) AS bf FROM bfc, rfit WHERE (iteration, gene) NOT IN (SELECT (iteration, gene) FROM drawn) GROUP BY iteration, gene),
rbf AS (SELECT gene, avg(bf) AS bf, stddev_pop(bf) AS sd, count(*) AS num_obs FROM rsum GROUP BY gene)"""


HEX = "CAST('0x' || substr(md5({}), 1, 7) AS BIGINT)"
FOLDS_SQL = f"drawn AS (SELECT CAST(i AS INTEGER) AS iteration, gene FROM all_genes, range(10) r(i) WHERE i <> {HEX.format('gene')} % 10)"
BOOT_SQL = f"""spot AS (SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS place, count(*) OVER () AS n FROM all_genes),
spots AS (SELECT DISTINCT i AS iteration, {HEX.format("'0_' || i || '_' || place")} % n AS place FROM spot, range(20) r(i)),
drawn AS (SELECT CAST(iteration AS INTEGER) AS iteration, gene FROM spots JOIN spot USING (place))"""


@query(f"WITH {resampled_sql(FOLDS_SQL)} SELECT gene, round(bf, 6) AS bf, round(sd, 6) AS sd, num_obs FROM rbf")
def bagel_bf_cv(spark, sf_dir):
    x = Screen(spark, sf_dir)
    return rounded(r.resampled_factors(x.fc, x.ess, x.non, r.fold_draws(x.genes())), "bf", "sd")


@query(f"WITH {resampled_sql(BOOT_SQL)} SELECT gene, round(bf, 6) AS bf, round(sd, 6) AS sd, num_obs FROM rbf")
def bagel_bf_bootstrap(spark, sf_dir):
    x = Screen(spark, sf_dir)
    return rounded(r.resampled_factors(x.fc, x.ess, x.non, r.bootstrap_draws(x.genes(), 20)), "bf", "sd")


SMALL_SQL = BOOT_SQL.replace("FROM all_genes)", "FROM all_genes WHERE gene IN (SELECT gene FROM ess) OR gene IN (SELECT gene FROM non))")


@query(f"WITH {resampled_sql(SMALL_SQL)} SELECT gene, round(bf, 6) AS bf, round(sd, 6) AS sd, num_obs FROM rbf")
def bagel_bf_small_sample(spark, sf_dir):
    """Only genes of the two sets are drawn; all others are scored in every iteration."""
    x = Screen(spark, sf_dir)
    training = x.ess.unionByName(x.non).distinct().join(x.genes(), "gene", "left_semi")
    return rounded(r.resampled_factors(x.fc, x.ess, x.non, r.bootstrap_draws(training, 20)), "bf", "sd")


@query(f"""WITH {BF_SQL} SELECT gene, round(bf, 6) AS bf,
  round(CAST(tp AS DOUBLE) / total, 6) AS recall, round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 1), 6) AS precision,
  round(1 - coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 1), 6) AS fdr
FROM (SELECT gene, bf, sum(e) OVER w AS tp, sum(o) OVER w AS fp, sum(e) OVER () AS total
      FROM (SELECT gene, bf, CASE WHEN gene IN (SELECT gene FROM ess) THEN 1 ELSE 0 END AS e,
              CASE WHEN gene NOT IN (SELECT gene FROM ess) AND gene IN (SELECT gene FROM non) THEN 1 ELSE 0 END AS o FROM bf)
      WINDOW w AS (ORDER BY bf DESC, gene ROWS UNBOUNDED PRECEDING))""")
def bagel_pr(spark, sf_dir):
    x = Screen(spark, sf_dir)
    return rounded(s.precision_recall(x.bf(), x.ess, x.non), "bf", "recall", "precision", "fdr")


@query(f"""WITH {BF_SQL}, n AS (SELECT gene, count(*) AS n_guides FROM guides GROUP BY gene)
SELECT gene, round(bf, 6) AS bf, round(bf * 5 / n_guides, 6) AS norm_bf FROM bf JOIN n USING (gene)""")
def bagel_equalise(spark, sf_dir):
    x = Screen(spark, sf_dir)
    n = b.guides(spark, sf_dir).groupBy("gene").agg(F.count("guide").alias("n_guides"))
    return rounded(s.equalise(x.bf(), n, 5), "bf", "norm_bf").select("gene", "bf", "norm_bf")


@query(f"""WITH {FIT_SQL}, gbf AS (SELECT guide, gene, sum(slope * fc + intercept) AS bf FROM bfc, fit GROUP BY guide, gene),
t AS (SELECT g.guide, 1 + p_partkey % 3 AS perfect, (p_partkey // 3) % 4 AS mismatch FROM guides g),
gbase AS (SELECT gene, avg(bf) AS base FROM gbf JOIN t USING (guide) WHERE perfect = 1 AND mismatch = 0 GROUP BY gene),
r AS (SELECT guide, gene, bf, perfect - 1 AS x, mismatch AS y, bf - base AS e FROM gbf JOIN t USING (guide) LEFT JOIN gbase USING (gene)),
m AS (SELECT sum(x * x) AS xx, sum(y * y) AS yy, sum(x * y) AS xy, sum(x * e) AS xe, sum(y * e) AS ye FROM r WHERE e IS NOT NULL AND (x > 0 OR y > 0)),
c AS (SELECT greatest((xe * yy - ye * xy) / (xx * yy - xy * xy), 0) AS cx, greatest((ye * xx - xe * xy) / (xx * yy - xy * xy), 0) AS cy FROM m)
SELECT guide, gene, round(bf, 6) AS bf, round(bf - cx * x - cy * y, 6) AS corrected FROM r, c""")
def bagel_multitarget(spark, sf_dir):
    x = Screen(spark, sf_dir)
    key = F.substring("guide", 2, 20).cast("bigint")
    targets = b.guides(spark, sf_dir).select("guide", (1 + key % 3).alias("perfect"), (F.floor(key / 3) % 4).alias("mismatch"))
    rows = s.multi_target_penalty(s.bayes_factors(x.fc, x.fit(), ["guide", "gene"]), targets)
    return rounded(rows, "bf", "corrected")


BOOST_SQL = f"""{b.EDGES_SQL}, near AS (SELECT u AS gene, v AS near FROM network UNION SELECT v, u FROM network),
fib AS (SELECT list_append(list_transform(range(1, 80), lambda i: round((pow((1 + sqrt(5)) / 2, i) - pow((1 - sqrt(5)) / 2, i)) / sqrt(5))), 0) AS f),
o AS (SELECT n.gene, bf.bf, row_number() OVER (PARTITION BY n.gene ORDER BY bf.bf DESC) AS i FROM near n JOIN bf ON bf.gene = n.near),
boosts AS (SELECT o.gene, sum(o.bf / f[o.i]) AS boost FROM o, fib WHERE i < 70 GROUP BY o.gene)"""


@query(f"WITH {BF_SQL}, {BOOST_SQL} SELECT gene, round(boost, 6) AS boost FROM boosts")
def bagel_network(spark, sf_dir):
    """Every other edge is given in both directions, and counts once."""
    edges = b.network(spark, sf_dir)
    more = edges.filter("length(u) % 2 = 0").select(F.col("v").alias("u"), F.col("u").alias("v"))
    return rounded(s.network_sums(Screen(spark, sf_dir).bf(), edges.unionByName(more)), "boost")


# Quality and normalisation of counts


@query(f"""WITH {b.COUNTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY count, guide) AS i FROM counts)
SELECT sample, CAST(sum(count) AS BIGINT) AS reads, count(*) AS guides, count(*) FILTER (WHERE count = 0) AS zero_counts,
  round((2 * sum(CAST(i * count AS DOUBLE)) - (count(*) + 1) * sum(count)) / (count(*) * sum(CAST(count AS DOUBLE))), 6) AS gini FROM r GROUP BY sample""")
def count_qc_gini(spark, sf_dir):
    return rounded(s.count_summary(counts(spark, sf_dir)), "gini")


@query(f"""WITH {b.COUNTS_SQL}, g AS (SELECT guide, avg(ln(count)) AS m FROM (SELECT *, min(count) OVER (PARTITION BY guide) AS least FROM counts) WHERE least > 0 GROUP BY guide)
SELECT sample, round(quantile_cont(count / exp(m), 0.5), 6) AS size_factor FROM counts JOIN g USING (guide) GROUP BY sample""")
def median_ratio_norm(spark, sf_dir):
    positive = counts(spark, sf_dir).withColumn("count", F.col("count"))
    return rounded(s.median_ratio(positive.withColumn("count", F.when(F.col("count") > 0, F.col("count")).otherwise(0))), "size_factor")


# Hit selection

NAMES_SQL = """
names AS (SELECT p_partkey AS ordinal, 'H' || p_partkey AS gene_id, p_brand || '-' || p_size AS symbol,
            'OLD' || (p_partkey % 700) AS previous, 'AL' || (p_partkey % 311) || '|' || p_brand || '-' || (p_size % 13) AS aliases FROM part)"""
DICT_SQL = NAMES_SQL + """,
written AS (SELECT ordinal, 0 AS kind, 0 AS place, gene_id, symbol AS name FROM names
  UNION ALL SELECT ordinal, 1, 0, gene_id, previous FROM names
  UNION ALL SELECT ordinal, 2, i - 1, gene_id, string_split(aliases, '|')[i] FROM names, range(1, 3) r(i)),
dict AS (SELECT name, gene_id FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ordinal DESC, kind DESC, place DESC) AS k FROM written) WHERE k = 1)"""


def names(spark, sf_dir):
    part = b.table(spark, sf_dir, "part")
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    key, size, brand = F.col("p_partkey"), F.col("p_size"), F.col("p_brand")
    return part.select(
        key.alias("ordinal"),
        F.concat(F.lit("H"), text("p_partkey")).alias("gene_id"),
        F.concat(brand, F.lit("-"), text("p_size")).alias("symbol"),
        F.concat(F.lit("OLD"), text(key % 700)).alias("previous"),
        F.concat(F.lit("AL"), text(key % 311), F.lit("|"), brand, F.lit("-"), text(size % 13)).alias("aliases"),
    )


@query(f"WITH {DICT_SQL} SELECT name, gene_id FROM dict")
def gene_dictionary(spark, sf_dir):
    return s.gene_dictionary(names(spark, sf_dir))


@query(r"""SELECT DISTINCT p_brand || '-' || p_size AS symbol, CASE WHEN p_size >= 10 THEN p_brand ELSE p_brand || '-' || p_size END AS part FROM part""")
def symbol_split(spark, sf_dir):
    symbols = names(spark, sf_dir).select("symbol").distinct()
    return symbols.withColumn("part", s.split_symbol(F.col("symbol")))


@query(f"""WITH {DICT_SQL}, asked AS (SELECT DISTINCT p_brand || '-' || p_size AS symbol, CASE WHEN p_size >= 10 THEN p_brand ELSE p_brand || '-' || p_size END AS part FROM part
  UNION SELECT 'OLD7-XY', 'OLD7' UNION SELECT 'none', 'none')
SELECT symbol, coalesce((SELECT gene_id FROM dict WHERE name = symbol), (SELECT gene_id FROM dict WHERE name = part), 'No entry found') AS gene_id FROM asked""")
def gene_lookup(spark, sf_dir):
    asked = names(spark, sf_dir).select("symbol").union(spark.createDataFrame([("OLD7-XY",), ("none",)], "symbol string")).distinct()
    return s.look_up(asked, s.gene_dictionary(names(spark, sf_dir)))


@query(f"""WITH {eb_sql(FC_SQL)}, gs AS (SELECT gene, sum(z) AS sum_z FROM z GROUP BY gene)
SELECT gene, rank() OVER (ORDER BY round(sum_z, 0)) + (count(*) OVER (PARTITION BY round(sum_z, 0)) - 1) / 2.0 AS rank FROM gs""")
def caller_rank(spark, sf_dir):
    rows = s.gene_sums(s.guide_z(changes(spark, sf_dir), H))
    return s.average_rank(rows, F.round("sum_z", 0)).select("gene", "rank")


DEGREE_SQL = b.EDGES_SQL + """,
deg AS (SELECT gene, count(*) AS degree FROM (SELECT u AS gene FROM network UNION ALL SELECT v FROM network) GROUP BY gene)"""


@query(f"WITH {DEGREE_SQL} SELECT gene, degree FROM deg")
def degree(spark, sf_dir):
    return s.degree(b.network(spark, sf_dir))


MOST = 1000  # the operator's default
RANKED_SQL = f"{eb_sql(FC_SQL)}, {DEGREE_SQL}" + """,
order_z AS (SELECT gene, row_number() OVER (ORDER BY round(sum(z), 6), gene) AS rank FROM z GROUP BY gene)"""
PREFIX_SQL = RANKED_SQL + f""",
ids AS (SELECT CAST(i AS INTEGER) AS i FROM range(1, {MOST + 1}) r(i)),
first_rank AS (SELECT gene, rank FROM order_z JOIN deg USING (gene) WHERE rank <= {MOST}),
prefix AS (SELECT i, (SELECT count(*) FROM first_rank WHERE rank <= i) AS nodes,
  (SELECT count(*) FROM network JOIN first_rank x ON x.gene = u JOIN first_rank y ON y.gene = v WHERE greatest(x.rank, y.rank) <= i) AS edges FROM ids)"""
EXPECT_SQL = PREFIX_SQL + """,
placed AS (SELECT gene, CASE WHEN degree <= 10 THEN degree WHEN degree <= 30 THEN 30 WHEN degree <= 50 THEN 50 WHEN degree <= 100 THEN 100 WHEN degree <= 500 THEN 500 ELSE 501 END AS bin FROM deg),
sizes AS (SELECT bin, CAST(count(*) AS DOUBLE) AS size FROM placed GROUP BY bin),
be AS (SELECT least(x.bin, y.bin) AS a, greatest(x.bin, y.bin) AS b, count(*) AS e FROM network JOIN placed x ON x.gene = u JOIN placed y ON y.gene = v GROUP BY 1, 2),
h AS (SELECT i, bin, size, (SELECT count(*) FROM first_rank f JOIN placed p ON p.gene = f.gene WHERE p.bin = sizes.bin AND f.rank <= i) AS n FROM ids, sizes),
expect AS (SELECT x.i AS i, sum(e * CASE WHEN a = b THEN coalesce(x.n * (x.n - 1) / nullif(x.size * (x.size - 1), 0), 0) ELSE x.n * y.n / (x.size * y.size) END) AS expected
           FROM be JOIN h x ON x.bin = a JOIN h y ON y.bin = b AND y.i = x.i GROUP BY x.i)"""


def ranked(spark, sf_dir):
    rows = s.gene_sums(s.guide_z(changes(spark, sf_dir), H)).withColumn("x", F.round("sum_z", 6)).persist()  # gene-level
    return rows.select("gene", F.row_number().over(Window.orderBy("x", "gene")).alias("rank"))


@query(f"WITH {PREFIX_SQL} SELECT i, nodes, edges FROM prefix")
def prefix_edges(spark, sf_dir):
    return s.prefix_edges(ranked(spark, sf_dir), b.network(spark, sf_dir), MOST)


@query(f"WITH {EXPECT_SQL} SELECT i, round(expected, 6) AS expected FROM expect")
def expected_edges(spark, sf_dir):
    return rounded(s.expected_edges(ranked(spark, sf_dir), b.network(spark, sf_dir), MOST), "expected")


@query(f"""WITH {EXPECT_SQL},
spread AS (SELECT p.i, edges, expected, unnest(range(edges, CAST(greatest(edges, expected) + 40 * sqrt(greatest(edges, expected)) + 200 AS BIGINT))) AS k FROM prefix p JOIN expect USING (i) WHERE edges > 0 AND expected > 0),
term AS (SELECT *, -expected + k * ln(expected) - lgamma(k + 1.0) AS t FROM spread),
top AS (SELECT i, max(t) AS m FROM term GROUP BY i),
tail AS (SELECT term.i, greatest(-(max(m) + ln(sum(exp(t - m)))), 0) AS v FROM term JOIN top ON top.i = term.i GROUP BY term.i),
scored AS (SELECT p.i, edges, round(coalesce(expected, 0), 6) AS expected, coalesce(v, 0) AS v FROM prefix p LEFT JOIN expect USING (i) LEFT JOIN tail ON tail.i = p.i)
SELECT i, edges, expected, round(v, 6) AS neg_ln_p, i = (SELECT i FROM scored ORDER BY round(v, 9) DESC, i LIMIT 1) AS best FROM scored""")
def hit_poisson(spark, sf_dir):
    order, edges = ranked(spark, sf_dir), b.network(spark, sf_dir).persist()  # gene-level
    rows = s.hit_scores(s.prefix_edges(order, edges, MOST), s.expected_edges(order, edges, MOST))
    return rounded(rows, "expected", "neg_ln_p")


@query(f"""WITH {eb_sql(FC_SQL)}{GENE_SQL.replace('SELECT gene, round(sum_z', ', tab AS (SELECT gene, round(sum_z')}),
{BF_SQL}, pr AS (SELECT gene, bf FROM bf WHERE bf > 0) SELECT gene FROM tab WHERE fdr_synth < 0.5 INTERSECT SELECT gene FROM pr""".replace(f"{BF_SQL}", BF_SQL.replace(b.COUNTS_SQL + ",", "")))
def gene_overlap(spark, sf_dir):
    left = s.drug_scores(changes(spark, sf_dir), H).withColumn("f", F.round("fdr_synth", 6))
    right = Screen(spark, sf_dir).bf().withColumn("f", F.when(F.col("bf") > 0, 0.0).otherwise(1.0))
    return s.overlap(left, "f", right, "f", 0.5)


@query("""SELECT contrast, sample, 1 AS baseline, CAST(max(treated) AS INTEGER) AS treated FROM (
  VALUES ('drug', 'AF', 0), ('drug', 'AO', 0), ('drug', 'RF', 1), ('drug', 'RO', 1), ('none', 'AF', 0), ('none', 'NO', 1), ('none', 'NF', 1)) v(contrast, sample, treated) GROUP BY 1, 2""")
def design_matrix(spark, sf_dir):
    c = spark.createDataFrame([("drug", ["AF", "AO"], ["RF", "RO"]), ("none", ["AF"], ["NO", "NF"])], "contrast string, r array<string>, t array<string>")
    return s.design_matrix(F.col("contrast"), F.col("r"), F.col("t"), c)
