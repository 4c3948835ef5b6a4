"""Pooled screens: guide counts, normalisation, drug scores, Bayes factors, hit selection.

Counts are long: (guide, gene, sample, count). Windows run over guides or genes of one contrast, not over reads.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlake.functions import stats

SCALE = 1e7


# Counting and normalisation


def count_matrix(guides: DataFrame, observed: DataFrame) -> DataFrame:
    """Counts of every guide in every sample, 0 where none was seen. ``guides`` x samples is the size of the result."""
    samples = observed.select("sample").distinct()  # one row a sample
    every = guides.crossJoin(samples)
    return every.join(observed, ["guide", "sample"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def count_guides(reads: DataFrame, library: DataFrame, offset: int, length: int) -> DataFrame:
    """(guide, gene, sample, count): reads whose bases from ``offset`` are a library sequence; zero-filled."""
    cut = reads.select("sample", F.substring("seq", offset + 1, length).alias("sequence"))
    found = cut.groupBy("sample", "sequence").count().join(library, "sequence")
    found = found.groupBy("guide", "sample").agg(F.sum("count").alias("count"))
    return count_matrix(library.select("guide", "gene").distinct(), found)


def scale_counts(counts: DataFrame, by: str = "sample", scale: float = SCALE) -> DataFrame:
    """Adds ``norm``: counts per ``scale`` of the sample's total. Totals are joined, so no sample is one task's window."""
    totals = counts.groupBy(by).agg(F.sum("count").alias("total"))
    return counts.join(F.broadcast(totals), by).withColumn("norm", F.col("count") * scale / F.col("total")).drop("total")


def remove_genes(counts: DataFrame, genes: list[str]) -> DataFrame:
    """Without guides of control genes."""
    return counts.filter(~F.col("gene").isin(genes)) if genes else counts


def median_ratio(counts: DataFrame) -> DataFrame:
    """(sample, size_factor): the median over guides seen everywhere of count / geometric mean."""
    centre = counts.groupBy("guide").agg(
        F.avg(F.ln(F.col("count").cast("double"))).alias("log_mean"), F.min("count").alias("least")
    )
    centre = centre.filter("least > 0").select("guide", "log_mean")
    ratio = counts.join(centre, "guide").withColumn("ratio", F.col("count") / F.exp("log_mean"))
    return ratio.groupBy("sample").agg(F.percentile("ratio", 0.5).alias("size_factor"))


def count_summary(counts: DataFrame) -> DataFrame:
    """(sample, reads, guides, zero_counts, gini) of each sample."""
    order = Window.partitionBy("sample").orderBy("count", "guide")
    ranked = counts.withColumn("i", F.row_number().over(order))
    out = ranked.groupBy("sample").agg(
        F.sum("count").alias("reads"),
        F.count("guide").alias("guides"),
        F.count_if(F.col("count") == 0).alias("zero_counts"),
        F.sum(F.col("i") * F.col("count")).alias("weighted"),
    )
    n = F.col("guides").cast("double")
    gini = F.try_divide(2 * F.col("weighted") - (n + 1) * F.col("reads"), n * F.col("reads"))
    return out.withColumn("gini", gini).drop("weighted")


# Drug scores


def paired_changes(counts: DataFrame, control: list[str], treatment: list[str], pseudo: float = 5.0) -> DataFrame:
    """(guide, gene, replicate, raw_control, fc): log2 ratios of scaled counts of each pair of samples."""
    if len(control) != len(treatment):
        raise ValueError("a paired design needs as many treatment samples as control samples")
    scaled = scale_counts(counts)
    parts = []
    for k, (c, t) in enumerate(zip(control, treatment, strict=True)):
        wide = scaled.filter(F.col("sample").isin(c, t)).groupBy("guide", "gene").agg(
            F.max(F.when(F.col("sample") == c, F.col("count"))).alias("raw_control"),
            F.max(F.when(F.col("sample") == c, F.col("norm"))).alias("c"),
            F.max(F.when(F.col("sample") == t, F.col("norm"))).alias("t"),
        )
        fc = F.log2((F.col("t") + pseudo) / (F.col("c") + pseudo))
        parts.append(wide.select("guide", "gene", F.lit(k).alias("replicate"), F.col("raw_control").cast("double").alias("raw_control"), fc.alias("fc")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unpaired_changes(counts: DataFrame, control: list[str], treatment: list[str], pseudo: float = 5.0) -> DataFrame:
    """Like :func:`paired_changes` with one replicate: ratios of mean scaled counts, ordered by mean raw control."""
    c, t = F.col("sample").isin(control), F.col("sample").isin(treatment)
    wide = scale_counts(counts).groupBy("guide", "gene").agg(
        F.avg(F.when(c, F.col("count"))).alias("raw_control"),
        F.avg(F.when(c, F.col("norm"))).alias("c"),
        F.avg(F.when(t, F.col("norm"))).alias("t"),
    )
    fc = F.log2((F.col("t") + pseudo) / (F.col("c") + pseudo))
    return wide.select("guide", "gene", F.lit(0).alias("replicate"), "raw_control", fc.alias("fc"))


def local_sd(changes: DataFrame, half_window: int = 500, step: int = 25) -> DataFrame:
    """Adds ``eb_std``: the SD of fold changes of guides with like control counts, never falling along that order.

    SDs are taken at every ``step``-th guide; a guide takes the largest of those up to its own. Guides nearer than
    ``half_window`` to an end take the end's. Needs more than ``2 * half_window`` guides a replicate.
    """
    order = Window.partitionBy("replicate").orderBy(F.desc("raw_control"), "guide")
    around = order.rowsBetween(-half_window, half_window - 1)
    n = F.count(F.lit(1)).over(Window.partitionBy("replicate"))
    rows = changes.withColumn("r", F.row_number().over(order) - 1).withColumn("n", n)
    rows = rows.withColumn("sd", F.stddev_samp("fc").over(around))
    place = F.least(F.greatest(F.col("r"), F.lit(half_window)), F.col("n") - half_window - 1)
    rows = rows.withColumn("bin", F.floor((place - half_window) / step))
    bins = rows.filter((F.col("r") >= half_window) & (F.col("r") < F.col("n") - half_window))
    bins = bins.filter((F.col("r") - half_window) % step == 0).select(
        "replicate", F.floor((F.col("r") - half_window) / step).alias("bin"), "sd"
    )
    up_to = Window.partitionBy("replicate").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.select("replicate", "bin", F.max("sd").over(up_to).alias("eb_std"))
    return rows.drop("sd").join(bins, ["replicate", "bin"]).drop("bin", "n", "r")


def guide_z(changes: DataFrame, half_window: int = 500) -> DataFrame:
    """(guide, gene, replicate, fc, eb_std, z)."""
    rows = local_sd(changes, half_window)
    return rows.withColumn("z", F.col("fc") / F.col("eb_std")).drop("raw_control")


def gene_sums(z: DataFrame, min_obs: int = 1) -> DataFrame:
    """(gene, sum_z, num_obs): sums over guides and replicates; observations are values other than 0."""
    out = z.groupBy("gene").agg(
        F.sum(F.coalesce(F.nanvl("z", F.lit(0.0)), F.lit(0.0))).alias("sum_z"),
        F.count_if((F.col("z") != 0) | F.isnan("z")).alias("num_obs"),
    )
    return out.filter(F.col("num_obs") >= min_obs)


def gene_norm(sums: DataFrame) -> DataFrame:
    """Adds ``norm_z``: sum_z / sqrt(num_obs) as a z-score over genes."""
    rows = sums.withColumn("x", F.col("sum_z") / F.sqrt(F.col("num_obs").cast("double")))
    whole = rows.agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))  # one row
    rows = rows.join(F.broadcast(whole))
    return rows.withColumn("norm_z", (F.col("x") - F.col("mean")) / F.col("sd")).drop("x", "mean", "sd")


def drug_scores(changes: DataFrame, half_window: int = 500, min_obs: int = 1) -> DataFrame:
    """The gene table: norm_z, p-values, ranks and FDRs of synergy and suppression."""
    rows = gene_norm(gene_sums(guide_z(changes, half_window), min_obs))
    rows = rows.withColumn("pval_synth", stats.normal_tail(-F.col("norm_z")))
    rows = rows.withColumn("pval_supp", stats.normal_tail(F.col("norm_z")))
    for side in ("synth", "supp"):
        rows = stats.bh_fdr(rows, f"pval_{side}", f"rank_{side}", f"fdr_{side}", [], ["gene"])
    return rows


# Bayes factors


def pooled_changes(counts: DataFrame, control: list[str], samples: list[str], min_reads: float = 0, pseudo: float = 5.0) -> DataFrame:
    """(guide, gene, sample, fc) against the sum of the control samples; the pseudocount goes to every column first,
    so that ``min_reads`` is compared with the control after it. The sums (one row a guide and sample) are read three times and kept."""
    keep = counts.filter(F.col("sample").isin(control + samples))
    keep = keep.withColumn("sample", F.when(F.col("sample").isin(control), F.lit("control")).otherwise(F.col("sample")))
    summed = keep.groupBy("guide", "gene", "sample").agg((F.sum("count") + pseudo).alias("count")).persist()
    totals = summed.groupBy("sample").agg(F.sum("count").alias("total"))
    summed = summed.join(F.broadcast(totals), "sample").withColumn("norm", F.col("count") * SCALE / F.col("total"))
    base = summed.filter((F.col("sample") == "control") & (F.col("count") >= min_reads))
    base = base.select("guide", F.col("norm").alias("base"))
    rest = summed.filter("sample <> 'control'").join(base.hint("merge"), "guide")  # a row a guide: never broadcast
    return rest.select("guide", "gene", "sample", F.log2(F.col("norm") / F.col("base")).alias("fc"))


def grid(spark, low: int = -1000, high: int = 200) -> DataFrame:
    """(k): hundredths from ``low`` up to ``high``, without the latter."""
    return spark.range(low, high).select(F.col("id").alias("k"))


def kernel_sums(values: DataFrame, points: DataFrame) -> DataFrame:
    """(iteration, k, s): at each of the fixed ``points`` (k) the sum of ``w`` times the Gaussian kernel over ``values`` (iteration, x, w, bw).

    Kernels are summed in numpy by partition, then by key, so that no pair of a value and a point is a row.
    """
    ks = np.array([r.k for r in points.sort("k").collect()], np.int64)  # the grid: a fixed number
    kind = values.schema["iteration"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            iteration, x, w, bw = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for one in np.unique(iteration):
                mine = np.flatnonzero(iteration == one)
                for a in range(0, len(mine), 256):
                    at = mine[a : a + 256]
                    u = (ks / 100.0 - x[at, None]) / bw[at, None]
                    held[one] = held.get(one, 0.0) + w[at].astype(float) @ np.exp(-u * u / 2)
        for one, sums in held.items():
            columns = [pa.array(np.full(len(ks), one)), pa.array(ks), pa.array(sums, pa.float64(), from_pandas=True)]
            yield pa.RecordBatch.from_arrays(columns, ["iteration", "k", "s"])

    rows = values.select("iteration", "x", "w", "bw").mapInArrow(run, f"iteration {kind}, k bigint, s double")
    return rows.groupBy("iteration", "k").agg(F.sum("s").alias("s"))


def density(points: DataFrame, values: DataFrame) -> DataFrame:
    """(k, density): Gaussian kernel density of ``values`` (x) at k / 100, with Scott's bandwidth.

    Equal values are looked at once, with their number. The grid has a fixed number of points.
    """
    shape = values.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"))
    shape = shape.select("n", stats.scott_bandwidth(F.col("n"), F.col("sd")).alias("bw"))
    different = values.filter("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("w")).join(F.broadcast(shape))
    out = kernel_sums(different.withColumn("iteration", F.lit(0)), points).join(F.broadcast(shape))
    return out.select("k", (F.col("s") / (F.col("n") * F.col("bw") * 2.5066282746310002)).alias("density"))


def densities(fc: DataFrame, essential: DataFrame, nonessential: DataFrame) -> DataFrame:
    """(k, ess, non): densities of the fold changes of guides of either gene set on the grid."""
    points = grid(fc.sparkSession)
    x = fc.select("gene", F.col("fc").alias("x"))
    ess = density(points, x.join(essential, "gene", "left_semi")).withColumnRenamed("density", "ess")
    non = density(points, x.join(nonessential, "gene", "left_semi")).withColumnRenamed("density", "non")
    return points.join(ess, "k").join(non, "k")


def valid_interval(both: DataFrame, fc: DataFrame, nonessential: DataFrame) -> DataFrame:
    """(xmin, xmax) in hundredths: the first grid point where the non-essential density is trusted, and the
    point up to the last such one where log2(ess / non) is least."""
    n = fc.select("gene").distinct().join(nonessential, "gene", "left_semi").agg(F.count("gene").alias("n"))
    limit = n.select(stats.fold_change_threshold(F.col("n")).alias("limit"))
    ends = both.join(F.broadcast(limit)).filter("non > limit").agg(F.min("k").alias("xmin"), F.max("k").alias("last"))
    ratio = F.log2(F.col("ess") / F.col("non"))
    inside = both.join(F.broadcast(ends)).filter("k >= xmin and k < last and non > 0 and ess > 0")
    return inside.agg(F.min("xmin").alias("xmin"), F.min_by("k", F.struct(ratio, "k")).alias("xmax"))


def ratio_lookup(both: DataFrame, interval: DataFrame) -> DataFrame:
    """(k, log_ratio) inside the interval."""
    rows = both.join(F.broadcast(interval)).filter("k between xmin and xmax")
    return rows.select("k", F.log2(F.col("ess") / F.col("non")).alias("log_ratio"))


def ratio_fit(fc: DataFrame, lookup: DataFrame, interval: DataFrame) -> DataFrame:
    """(slope, intercept) of log_ratio on fold changes rounded to hundredths, those inside the interval."""
    rows = fc.join(F.broadcast(interval)).filter("fc * 100 between xmin and xmax")
    rows = rows.select(F.rint(F.col("fc") * 100).cast("bigint").alias("k")).join(F.broadcast(lookup), "k")
    y, x = F.col("log_ratio"), F.col("k") / 100.0
    return rows.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def bayes_factors(fc: DataFrame, fit: DataFrame, level: list[str]) -> DataFrame:
    """Sums of slope * fc + intercept over guides and samples of each ``level`` group, with the number of them."""
    rows = fc.join(F.broadcast(fit)).withColumn("bf", F.col("slope") * F.col("fc") + F.col("intercept"))
    return rows.groupBy(*level).agg(F.sum("bf").alias("bf"), F.count("bf").alias("num_obs"))


def equalise(bf: DataFrame, guides_per_gene: DataFrame, target: int) -> DataFrame:
    """Adds ``norm_bf``: bf * target / number of the gene's guides."""
    return bf.join(guides_per_gene, "gene").withColumn("norm_bf", F.col("bf") * target / F.col("n_guides"))


def multi_target_penalty(bf: DataFrame, targets: DataFrame) -> DataFrame:
    """(guide, gene, bf, corrected): excess over the gene's mean is regressed on further perfect and one-mismatch loci
    (least squares without intercept, 2 x 2 closed form); negative coefficients count as 0."""
    rows = bf.join(targets, "guide")
    base = rows.filter("perfect = 1 and mismatch = 0").groupBy("gene").agg(F.avg("bf").alias("base"))
    rows = rows.join(base, "gene", "left")
    x, y, e = F.col("perfect") - 1, F.col("mismatch"), F.col("bf") - F.col("base")
    train = rows.filter("base is not null and (perfect > 1 or mismatch > 0)")
    s = train.agg(*[F.sum(v).cast("double").alias(n) for n, v in (("xx", x * x), ("yy", y * y), ("xy", x * y), ("xe", x * e), ("ye", y * e))])
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    fit = s.select(
        F.greatest(F.coalesce(F.try_divide(F.col("xe") * F.col("yy") - F.col("ye") * F.col("xy"), det), F.lit(0.0)), F.lit(0.0)).alias("cx"),
        F.greatest(F.coalesce(F.try_divide(F.col("ye") * F.col("xx") - F.col("xe") * F.col("xy"), det), F.lit(0.0)), F.lit(0.0)).alias("cy"),
    )
    rows = rows.join(F.broadcast(fit))
    return rows.select("guide", "gene", "bf", (F.col("bf") - F.col("cx") * x - F.col("cy") * y).alias("corrected"))


def network_sums(bf: DataFrame, edges: DataFrame) -> DataFrame:
    """(gene, boost): a gene's different neighbours' factors in falling order, each divided by the next Fibonacci number.

    An edge given in both directions or more than once counts once. Fibonacci numbers beyond the 1000th are over 1e208: neighbours
    of a rank beyond that add nothing to a double and are left out.
    """
    both = edges.select(F.col("u").alias("gene"), F.col("v").alias("near"))
    both = both.unionByName(edges.select(F.col("v").alias("gene"), F.col("u").alias("near"))).filter("gene <> near").distinct()
    near = both.join(bf.select(F.col("gene").alias("near"), "bf"), "near")
    scores = near.groupBy("gene").agg(F.sort_array(F.collect_list("bf"), asc=False).alias("scores"))
    weights = F.array(*[F.lit(x) for x in stats.fibonacci(1000)])
    n = F.least(F.size("scores"), F.lit(1000))
    parts = F.zip_with(F.slice("scores", F.lit(1), n), F.slice(weights, F.lit(1), n), lambda s, w: s / w)
    return scores.select("gene", F.aggregate(parts, F.lit(0.0), lambda a, b: a + b).alias("boost"))


def precision_recall(bf: DataFrame, essential: DataFrame, nonessential: DataFrame) -> DataFrame:
    """(gene, bf, recall, precision, fdr) along falling bf; genes of both sets count as essential."""
    e = essential.select("gene", F.lit(1).alias("is_ess"))
    n = nonessential.select("gene", F.lit(1).alias("is_non"))
    rows = bf.join(F.broadcast(e), "gene", "left").join(F.broadcast(n), "gene", "left")
    tp = F.when(F.col("is_ess") == 1, 1).otherwise(0)
    fp = F.when(F.col("is_ess").isNull() & (F.col("is_non") == 1), 1).otherwise(0)
    down = Window.orderBy(F.desc("bf"), "gene").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(tp).over(Window.partitionBy())
    rows = rows.select("gene", "bf", F.sum(tp).over(down).alias("tp"), F.sum(fp).over(down).alias("fp"), total.alias("total"))
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(1.0))
    return rows.select(
        "gene", "bf", F.try_divide(F.col("tp").cast("double"), F.col("total")).alias("recall"),
        precision.alias("precision"), (1 - precision).alias("fdr"),
    )


# Hit selection


def split_symbol(symbol: Column) -> Column:
    """The part of a symbol before its last hyphen if two or more characters follow, else the symbol."""
    head = F.regexp_extract(symbol, r"^(.*)-([^-]{2,})$", 1)
    return F.when(head == "", symbol).otherwise(head)


def gene_dictionary(names: DataFrame) -> DataFrame:
    """(name, gene_id) from (ordinal, gene_id, symbol, previous, aliases; lists split at a bar): the last writer wins;
    in one row the symbol writes first, then previous symbols, then aliases."""
    parts = [F.array("symbol"), F.split(F.coalesce("previous", F.lit("")), r"\|"), F.split(F.coalesce("aliases", F.lit("")), r"\|")]
    out = None
    for k, p in enumerate(parts):
        one = names.select("ordinal", F.lit(k).alias("kind"), "gene_id", F.posexplode(p).alias("at", "name")).filter("name <> ''")
        out = one if out is None else out.unionByName(one)
    last = F.max_by("gene_id", F.struct("ordinal", "kind", "at"))
    return out.groupBy("name").agg(last.alias("gene_id"))


def look_up(symbols: DataFrame, dictionary: DataFrame, missing: str = "No entry found") -> DataFrame:
    """Adds ``gene_id`` by the whole symbol, else by its part before the last hyphen."""
    whole = dictionary.select(F.col("name").alias("symbol"), F.col("gene_id").alias("id1"))
    part = dictionary.select(F.col("name").alias("part"), F.col("gene_id").alias("id2"))
    rows = symbols.withColumn("part", split_symbol(F.col("symbol"))).join(whole, "symbol", "left").join(part, "part", "left")
    return rows.withColumn("gene_id", F.coalesce("id1", "id2", F.lit(missing))).drop("id1", "id2", "part")


def average_rank(df: DataFrame, order: Column, name: str = "rank") -> DataFrame:
    """Adds ranks in which ties share the mean."""
    ties = F.count(F.lit(1)).over(Window.partitionBy(order))
    return df.withColumn("ties", ties).withColumn(name, F.rank().over(Window.orderBy(order)) + (F.col("ties") - 1) / 2).drop("ties")


def degree(edges: DataFrame) -> DataFrame:
    """(gene, degree): ends of edges at each gene; a loop counts twice."""
    ends = edges.select(F.col("u").alias("gene")).unionByName(edges.select(F.col("v").alias("gene")))
    return ends.groupBy("gene").agg(F.count(F.lit(1)).alias("degree"))


def degree_bin(d: Column) -> Column:
    """Degrees up to 10 are bins of their own, then 11-30, 31-50, 51-100, 101-500 and above."""
    out = F.when(d <= 10, d)
    for top in (30, 50, 100, 500):
        out = out.when(d <= top, F.lit(top))
    return out.otherwise(F.lit(501)).cast("bigint")


def prefix_edges(ranked: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """(i, nodes, edges): nodes and edges among the first i of ``ranked`` (gene, rank), for i up to ``most``.

    One pass for all i: an edge comes in with the later of its ends. A gene's rank is that of its first row.
    """
    nodes = degree(edges).select("gene")
    first = ranked.groupBy("gene").agg(F.min("rank").alias("rank")).join(nodes, "gene", "left_semi").filter(F.col("rank") <= most)
    ends = edges.join(first.select(F.col("gene").alias("u"), F.col("rank").alias("ru")), "u")
    ends = ends.join(first.select(F.col("gene").alias("v"), F.col("rank").alias("rv")), "v")
    come = ends.groupBy(F.greatest("ru", "rv").alias("i")).agg(F.count(F.lit(1)).alias("e"))
    every = edges.sparkSession.range(1, most + 1).select(F.col("id").cast("int").alias("i"))
    rows = every.join(come, "i", "left").join(first.select(F.col("rank").alias("i"), F.lit(1).alias("n")), "i", "left")
    up_to = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(up_to).cast("bigint")
    return rows.select("i", total("n").alias("nodes"), total("e").alias("edges"))


def expected_edges(ranked: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """(i, expected): the mean number of edges among i genes drawn with the degree bins of the first i ranked ones.

    Exact, in place of simulation: an edge between bins a and b is drawn with probability n_a n_b / (N_a N_b),
    inside a bin with n_a (n_a - 1) / (N_a (N_a - 1)), a loop with n_a / N_a.
    """
    placed = degree(edges).select("gene", degree_bin(F.col("degree")).alias("bin"))
    sizes = placed.groupBy("bin").agg(F.count(F.lit(1)).cast("double").alias("size"))
    e = edges.join(placed.select(F.col("gene").alias("u"), F.col("bin").alias("bu")), "u")
    e = e.join(placed.select(F.col("gene").alias("v"), F.col("bin").alias("bv")), "v")
    e = e.groupBy(F.least("bu", "bv").alias("a"), F.greatest("bu", "bv").alias("b"), (F.col("u") == F.col("v")).alias("loop")).agg(
        F.count(F.lit(1)).alias("e")
    )
    first = ranked.groupBy("gene").agg(F.min("rank").alias("rank")).join(placed, "gene").filter(F.col("rank") <= most)
    every = edges.sparkSession.range(1, most + 1).select(F.col("id").cast("int").alias("i"))
    slots = every.crossJoin(F.broadcast(sizes))  # at most 16 bins for each i
    hits = slots.join(first.groupBy(F.col("rank").alias("i"), "bin").agg(F.count(F.lit(1)).alias("h")), ["i", "bin"], "left")
    up_to = Window.partitionBy("bin").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.select("i", "bin", "size", F.sum(F.coalesce("h", F.lit(0))).over(up_to).cast("double").alias("n"))
    x = hits.select("i", F.col("bin").alias("a"), F.col("n").alias("na"), F.col("size").alias("sa"))
    y = hits.select("i", F.col("bin").alias("b"), F.col("n").alias("nb"), F.col("size").alias("sb"))
    rows = F.broadcast(e).join(x, "a").join(y, ["i", "b"])
    share = (
        F.when(F.col("loop"), F.col("na") / F.col("sa"))
        .when(F.col("a") == F.col("b"), F.coalesce(F.try_divide(F.col("na") * (F.col("na") - 1), F.col("sa") * (F.col("sa") - 1)), F.lit(0.0)))
        .otherwise(F.col("na") * F.col("nb") / (F.col("sa") * F.col("sb")))
    )
    return rows.groupBy("i").agg(F.sum(F.col("e") * share).alias("expected"))


def hit_scores(prefix: DataFrame, expected: DataFrame) -> DataFrame:
    """(i, edges, expected, neg_ln_p, best): how unlikely so many edges are; best marks the largest score's first i."""
    rows = prefix.join(expected, "i", "left").withColumn("expected", F.coalesce("expected", F.lit(0.0)))
    rows = rows.withColumn("neg_ln_p", stats.poisson_neg_log_tail(F.col("edges"), F.col("expected")))
    best = rows.agg(F.max_by("i", F.struct(F.round("neg_ln_p", 9), -F.col("i"))).alias("top"))
    rows = rows.join(F.broadcast(best)).withColumn("best", F.col("i") == F.col("top"))
    return rows.select("i", "edges", "expected", "neg_ln_p", "best")


def overlap(left: DataFrame, left_fdr: str, right: DataFrame, right_fdr: str, limit: float = 0.1) -> DataFrame:
    """Genes below the limit in both tables."""
    return left.filter(F.col(left_fdr) < limit).select("gene").intersect(right.filter(F.col(right_fdr) < limit).select("gene"))


def design_matrix(contrast: Column, reference: Column, treatment: Column, contrasts: DataFrame) -> DataFrame:
    """(contrast, sample, baseline, treated) for every sample of each contrast."""
    rows = contrasts.select(contrast.alias("contrast"), treatment.alias("t"), F.explode(F.array_distinct(F.concat(reference, treatment))).alias("sample"))
    return rows.select("contrast", "sample", F.lit(1).alias("baseline"), F.array_contains("t", F.col("sample")).cast("int").alias("treated"))
