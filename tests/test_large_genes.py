"""Rank aggregation in genes of many guides."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from editlake.functions import beta, stats
from editlake.operators import models


def test_small_chances_are_exact():
    r = np.array([1e-100, 1e-30, 1e-12])
    assert beta.rho_p(2, r, 0.25) == pytest.approx(2 * r, rel=1e-9)  # sqrt(r)^2 and 1 - sqrt(1 - r) twice, the lesser order


def test_large_genes_end():
    """Followed one point at a time, 8000 guides are 4e9 steps."""
    p = beta.rho_p(8000, np.array([1e-6, 1e-2, 0.2, 1.0]), 0.25)
    rng = np.random.default_rng(4)
    u = np.sort(rng.random((400, 8000)), axis=1)[:, :2400]
    least = np.array([np.where(x <= 0.25, beta.binomial_tail(8000, np.arange(1, 2401), x), 1.0).min() for x in u])
    assert 1e-6 < p[0] < 1e-3 and p[3] == 1
    for r, got in ((1e-2, p[1]), (0.2, p[2])):
        assert abs((least <= r).mean() - got) < 0.08


def test_ranks_over_ranges(spark):
    df = spark.range(5000).select(F.col("id").alias("guide"), (F.col("id") * 7919 % 50).cast("double").alias("p"))
    got = stats.global_rank(df.repartition(7), "r", ["p", "guide"]).toPandas().sort_values("r")
    assert got["r"].tolist() == list(range(1, 5001))
    assert got.sort_values(["p", "guide"])["r"].tolist() == list(range(1, 5001))


def test_rho_of_a_gene_of_many_guides(spark):
    """400 guides a gene against the sum of the binomial's terms."""
    df = spark.range(4000).selectExpr("concat('g', id) guide", "concat('x', id % 10) gene", "double(id * 2654435761 % 1000003) p")
    got = {r.gene: r for r in models.rank_scores(df, "p").collect()}
    pdf = df.toPandas().sort_values(["p", "guide"])
    pdf["u"] = np.arange(1, 4001) / 4000
    for gene, x in pdf.groupby("gene"):
        u = x["u"].to_numpy()
        seen = u <= 0.25
        i = np.arange(401)
        log = lambda q: beta.log_gamma(np.array([401.0])) - beta.log_gamma(i + 1.0) - beta.log_gamma(401.0 - i) + i * np.log(q) + (400 - i) * np.log1p(-q)
        want = min(np.exp(log(q))[k:].sum() for k, q in enumerate(u[seen], 1))
        assert got[gene].num == 400 and got[gene].good == seen.sum() and got[gene].rho == pytest.approx(want, rel=1e-9)


def test_quantiles_over_ranges(spark):
    df = spark.range(3001).selectExpr("double(id * 7919 % 1009) a", "if(id % 3 = 0, null, -id / 7D) b", "1.5D c")
    got = stats.quantiles(df.repartition(5), ["a", "b", "c"], 0.68).collect()
    want = df.agg(*[F.percentile(c, F.lit(0.68)).alias(c) for c in "abc"]).first()
    assert len(got) == 1 and got[0] == want
    assert stats.quantiles(df.limit(0), ["a"], 0.5).collect()[0].a is None
