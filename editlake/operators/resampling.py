"""Bayes factors over many resampled training sets at once: folds, bootstrap draws, and the network scores' own training.

A table ``drawn`` (iteration, gene) says which genes each iteration learns from; all others are scored in it. Every iteration is a
group of the same few jobs, so nothing loops on the driver. Densities are taken on a grid of hundredths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlake.functions import stats
from editlake.scratch import materialize

from .screening import grid, kernel_sums


def hex_number(text: Column, digits: int = 7) -> Column:
    """A number from the first hex digits of the text's md5."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def fold_draws(genes: DataFrame, folds: int = 10) -> DataFrame:
    """(iteration, gene): in each of ``folds`` iterations the genes of the other folds, by a hash of the gene."""
    placed = genes.select("gene", F.pmod(hex_number(F.col("gene")), F.lit(folds)).alias("fold"))
    every = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("iteration")
    return placed.select("gene", "fold", every).filter("iteration <> fold").select("iteration", "gene")


def bootstrap_draws(genes: DataFrame, rounds: int = 1000, seed: int = 0) -> DataFrame:
    """(iteration, gene): in each iteration as many draws with replacement as there are genes; the different ones."""
    ranked = genes.select("gene", (F.row_number().over(Window.orderBy("gene")) - 1).alias("place"))  # one row a gene
    n = genes.agg(F.count("gene").alias("n"))
    draws = ranked.select(F.col("place").alias("draw"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("iteration"))
    name = F.concat_ws("_", F.lit(str(seed)), F.col("iteration").cast("string"), F.col("draw").cast("string"))
    draws = draws.join(F.broadcast(n)).select("iteration", F.pmod(hex_number(name), F.col("n")).cast("int").alias("place")).distinct()
    return draws.join(ranked, "place").select("iteration", "gene")


def grouped_density(points: DataFrame, values: DataFrame) -> DataFrame:
    """(iteration, k, density): Gaussian kernel densities, with Scott's bandwidth, of each iteration's ``values`` (iteration, x, w), ``w`` times each.

    ``points`` is (k) of a fixed number, or (iteration, k).
    """
    n, x, w = F.sum("w"), F.col("x"), F.col("w")
    shape = values.groupBy("iteration").agg(n.alias("n"), (F.sum(w * x) / n).alias("mean"), F.sum(w * x * x).alias("squares"))
    sd = F.sqrt(F.try_divide(F.greatest(F.col("squares") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0)), F.col("n") - 1))
    shape = shape.select("iteration", "n", stats.scott_bandwidth(F.col("n"), sd).alias("bw"))
    rows = values.join(shape, "iteration")
    if "iteration" in points.columns:
        u = (F.col("k") / 100.0 - F.col("x")) / F.col("bw")
        sums = rows.join(points, "iteration").groupBy("iteration", "k").agg(F.sum(w * F.exp(-u * u / 2)).alias("s"))
    else:
        sums = kernel_sums(rows, points)
    out = sums.join(shape, "iteration")
    return out.select("iteration", "k", (F.col("s") / (F.col("n") * F.col("bw") * 2.5066282746310002)).alias("density"))


def _both(points: DataFrame, train: DataFrame, essential: DataFrame, nonessential: DataFrame) -> DataFrame:
    ess = grouped_density(points, train.join(essential, "gene", "left_semi")).withColumnRenamed("density", "ess")
    non = grouped_density(points, train.join(nonessential, "gene", "left_semi")).withColumnRenamed("density", "non")
    return ess.join(non, ["iteration", "k"])


def _scored(rows: DataFrame, drawn: DataFrame, fits: DataFrame) -> DataFrame:
    """``rows`` (gene, sum, n), the sums of x and their numbers, in every iteration that did not draw the gene, with the sum of its fit's ``bf``."""
    every = rows.join(F.broadcast(fits))  # one row an iteration
    every = every.join(drawn, ["iteration", "gene"], "left_anti")
    return every.withColumn("bf", F.col("slope") * F.col("sum") + F.col("intercept") * F.col("n"))


def _fitted(points: DataFrame) -> DataFrame:
    """(iteration, slope, intercept): least squares of y on k / 100 over ``points`` (iteration, k, y, w), ``w`` times each."""
    of = Window.partitionBy("iteration")  # a row a grid point
    mean = lambda c: F.sum(F.col("w") * F.col(c)).over(of) / F.sum("w").over(of)
    rows = points.withColumns({"mk": mean("k"), "my": mean("y")})
    x = (F.col("k") - F.col("mk")) / 100.0
    slope = F.try_divide(F.sum(F.col("w") * x * (F.col("y") - F.col("my"))), F.sum(F.col("w") * x * x))
    out = rows.groupBy("iteration").agg(slope.alias("slope"), F.first("mk").alias("mk"), F.first("my").alias("my"))
    return out.select("iteration", "slope", (F.col("my") - F.col("slope") * F.col("mk") / 100.0).alias("intercept"))


def _summary(rows: DataFrame) -> DataFrame:
    """(gene, bf, sd, num_obs) over the iterations' sums (iteration, gene, bf)."""
    return rows.groupBy("gene").agg(F.avg("bf").alias("bf"), F.stddev_pop("bf").alias("sd"), F.count("bf").alias("num_obs"))


def resampled_factors(fc: DataFrame, essential: DataFrame, nonessential: DataFrame, drawn: DataFrame) -> DataFrame:
    """(gene, bf, sd, num_obs): mean and SD over the iterations in which a gene was scored, of its guides' and samples' sum.

    A gene's equal fold changes are one row with their number in every iteration, and a gene is scored by the sum of its fold changes. What
    several steps read is written once, so that no step's plan holds all steps before it.
    """
    rows = fc.groupBy("gene", F.col("fc").alias("x")).agg(F.count(F.lit(1)).alias("w"))
    rows, drawn = materialize(rows, "fold-changes"), materialize(drawn, "drawn")
    train = rows.join(drawn, "gene")
    both = materialize(_both(grid(fc.sparkSession), train, essential, nonessential), "densities")  # one row an iteration and grid point
    n = drawn.join(nonessential, "gene", "left_semi").groupBy("iteration").agg(F.count("gene").alias("n"))
    limit = n.select("iteration", stats.fold_change_threshold(F.col("n")).alias("limit"))
    ends = both.join(limit, "iteration").filter("non > limit").groupBy("iteration").agg(F.min("k").alias("xmin"), F.max("k").alias("last"))
    ratio = F.log2(F.col("ess") / F.col("non"))
    inside = both.join(ends, "iteration").filter("k >= xmin and k < last and non > 0 and ess > 0")
    ends = inside.groupBy("iteration").agg(F.min("xmin").alias("xmin"), F.min_by("k", F.struct(ratio, "k")).alias("xmax"))
    ends = materialize(ends, "ends")  # one row an iteration
    lookup = both.join(ends, "iteration").filter("k between xmin and xmax").select("iteration", "k", ratio.alias("log_ratio"))
    points = train.join(ends, "iteration").filter("x * 100 between xmin and xmax")
    points = points.groupBy("iteration", F.rint(F.col("x") * 100).cast("bigint").alias("k")).agg(F.sum("w").alias("w"))
    fits = _fitted(points.join(lookup, ["iteration", "k"]).withColumnRenamed("log_ratio", "y"))
    genes = rows.groupBy("gene").agg(F.sum(F.col("w") * F.col("x")).alias("sum"), F.sum("w").alias("n"))
    return _summary(_scored(genes, drawn, fits))


def network_factors(scores: DataFrame, bf: DataFrame, essential: DataFrame, nonessential: DataFrame, drawn: DataFrame) -> DataFrame:
    """(gene, bf, boost, boosted): the ``bf`` of genes plus the factor of their network ``scores`` (gene, boost), 0 without one.

    Each iteration fits log2 of the two sets' densities at the scores themselves, between the least grid point below the essential
    scores' mean whose ratio exceeds -5 and the greatest one above the non-essential ones' mean whose ratio is below 5.
    """
    rows = scores.select("gene", F.col("boost").alias("x"), F.lit(1).alias("w"))
    train = rows.join(drawn, "gene").persist()  # one row an iteration and gene
    sides = []
    for genes, name in ((essential, "ess"), (nonessential, "non")):
        own = train.join(genes, "gene", "left_semi").groupBy("iteration")
        sides.append(own.agg(F.min("x").alias(f"{name}_min"), F.max("x").alias(f"{name}_max"), F.avg("x").alias(f"{name}_mean")))
    shape = sides[0].join(sides[1], "iteration")
    hundredths = lambda a, b: F.sequence(F.ceil(F.col(a) * 100), F.floor(F.col(b) * 100))
    points = shape.select("iteration", F.explode(F.array_union(hundredths("ess_min", "ess_max"), hundredths("non_min", "non_max"))).alias("k"))
    both = _both(points, train, essential, nonessential).filter("ess > 0 and non > 0").join(shape, "iteration")
    at, ratio = F.col("k") / 100.0, F.log2(F.col("ess") / F.col("non"))
    low = at.between(F.col("ess_min"), F.col("ess_max")) & (ratio > -5) & (at < F.col("ess_mean"))
    high = at.between(F.col("non_min"), F.col("non_max")) & (ratio < 5) & (at > F.col("non_mean"))
    ends = both.groupBy("iteration").agg(F.min(F.when(low, at)).alias("xmin"), F.max(F.when(high, at)).alias("xmax"))
    # The densities at the scores themselves, as points of their own, in hundredths like the grid's.
    exact = train.join(ends, "iteration").filter("x between xmin and xmax").select("iteration", (F.col("x") * 100).alias("k")).distinct()
    dense = _both(exact, train, essential, nonessential)
    used = train.join(ends, "iteration").filter("x between xmin and xmax").withColumn("k", F.col("x") * 100)
    used = used.join(dense, ["iteration", "k"]).filter("ess > 0 and non > 0")
    y, x = F.log2(F.col("ess") / F.col("non")), F.rint(F.col("x") * 100) / 100
    fits = used.groupBy("iteration").agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    genes = rows.select("gene", F.col("x").alias("sum"), F.col("w").alias("n"))
    boost = _summary(_scored(genes, drawn, fits).select("iteration", "gene", "bf")).select("gene", F.col("bf").alias("boost"))
    out = bf.select("gene", "bf").join(boost, "gene", "left").withColumn("boost", F.coalesce("boost", F.lit(0.0)))
    return out.withColumn("boosted", F.col("bf") + F.col("boost"))
