"""Genes of one guide are fitted side by side; the counts that a regression reads again and again are made once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from editlake.operators import models
from editlake.plans import modelled

X = np.array([[0, 0], [0, 0], [1, 0], [1, 0], [0, 1], [0, 1]], float)


@pytest.mark.parametrize("ridge", [0.0, 1e-3])
def test_single_guides_side_by_side(ridge):
    rng = np.random.default_rng(2)
    y = np.concatenate((rng.negative_binomial(3, 0.01, (60, 6)), rng.integers(1, 4, (60, 6)), [[1, 1, 90000, 2, 1, 1]])).astype(float)
    alpha, size = rng.uniform(1e-4, 2, len(y)), rng.uniform(0.5, 2, (len(y), 6))
    effect, se = models.fit_single_guides(y, X, size, alpha, ridge, 50)
    for k in range(len(y)):
        want = models.fit_gene(y[k : k + 1], X, size[k], alpha[k : k + 1], None, ridge, 50)
        assert effect[k] == pytest.approx(want[0], abs=1e-9) and se[k] == pytest.approx(want[1], rel=1e-6)


def test_genes_of_one_and_of_more_guides_in_one_table(spark):
    rng = np.random.default_rng(3)
    names = [f"s{k}" for k in range(6)]
    rows = [(f"x{g}", f"x{g}_{k}", s, int(rng.integers(50, 90))) for g in range(5) for k in range(1 + g % 2 * 2) for s in names]
    counts = spark.createDataFrame(rows, "gene string, guide string, sample string, count bigint")
    sizes = spark.createDataFrame([(s, 1.0) for s in names], "sample string, size_factor double")
    design = {s: [1, *map(float, X[k])] for k, s in enumerate(names)}
    for prior in (None, (9.0, 1.0)):
        got = {r.gene: r for r in models.mle_fits(counts, design, sizes, 0.1, prior).collect()}
        assert len(got) == 5
        for g, r in got.items():
            own = sorted({x[1] for x in rows if x[0] == g})
            y = np.array([[next(x[3] for x in rows if x[1] == u and x[2] == s) for s in names] for u in own], float)
            effect, se, weight = models.fit_gene(y, X, np.ones(6), np.full(len(y), 0.1), prior, 1e-3, 50)
            assert r.num == len(own) and [(u.guide, pytest.approx(u.efficiency)) for u in r.guides] == list(zip(own, weight, strict=True))
            assert [u.coefficient for u in r.effects] == [1, 2]
            assert [u.beta for u in r.effects] == pytest.approx(effect / np.log(2), abs=1e-9)
            assert [u.se for u in r.effects] == pytest.approx(se / np.log(2), rel=1e-6)


def test_counts_are_made_once(spark):
    x, sizes = modelled.guide_effects(spark, "/root/testdata/sf0.001")
    assert "Join" not in x._jdf.queryExecution().executedPlan().toString()
    assert sizes.count() == x.select("sample").distinct().count() and x.filter(F.col("count") < 1).count() == 0
