"""Densities and resampled factors over many equal fold changes: each value once, with its number."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from editlake.operators import resampling as r
from editlake.operators import screening as s


def test_density_of_repeated_values(spark):
    xs = [-1.5, -1.5, -1.5, 0.25, 0.25, 1.0, None]
    values = spark.createDataFrame([(x,) for x in xs], "x double")
    made = {k: d for k, d in s.density(s.grid(spark), values).collect()}
    known = [x for x in xs if x is not None]
    mean = sum(known) / len(known)
    bw = len(known) ** -0.2 * math.sqrt(sum((x - mean) ** 2 for x in known) / (len(known) - 1))
    for k in (-1000, -150, 0, 25, 199):
        want = sum(math.exp(-(((k / 100 - x) / bw) ** 2) / 2) for x in known) / (len(known) * bw * 2.5066282746310002)
        assert abs(made[k] - want) < 1e-12
    assert len(made) == 1200


def test_weights_stand_for_rows(spark):
    rows = spark.createDataFrame([(0, -1.0, 3), (0, 0.5, 2), (1, 0.5, 1), (1, 2.0, 1)], "iteration int, x double, w bigint")
    single = rows.withColumn("w", F.explode(F.sequence(F.lit(1), "w"))).withColumn("w", F.lit(1).cast("bigint"))
    a, b = ({(x.iteration, x.k): x.density for x in r.grouped_density(s.grid(spark), y).collect()} for y in (rows, single))
    assert a.keys() == b.keys() and len(a) == 2400
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_no_row_for_each_value_and_grid_point(spark):
    values = spark.range(1000).select((F.col("id") % 10 / 10.0).alias("x"))
    plan = s.density(s.grid(spark), values)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan


def test_copied_guides_leave_few_rows_to_resample(spark):
    fc = spark.range(6000).select(F.concat(F.lit("g"), (F.col("id") % 6).cast("string")).alias("gene"), ((F.col("id") % 60) / 20.0 - 2).alias("fc"))
    genes = fc.select("gene").distinct()
    ess, non = genes.filter("gene in ('g0', 'g1', 'g2')"), genes.filter("gene in ('g3', 'g4', 'g5')")
    drawn = r.fold_draws(genes, 3)
    made = r.resampled_factors(fc, ess, non, drawn)
    assert sorted(x.gene for x in made.collect()) == [f"g{k}" for k in range(6)]
    assert "fold-changes" in made._jdf.queryExecution().executedPlan().toString()
