"""The regression of counts on a design: planted effects, dispersions, efficiencies and control guides; selection tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from editlake.operators import models

DESIGN = {"c1": [1, 0], "c2": [1, 0], "c3": [1, 0], "t1": [1, 1], "t2": [1, 1], "t3": [1, 1]}
SIZE = {"c1": 1.0, "c2": 0.5, "c3": 1.5, "t1": 1.0, "t2": 2.0, "t3": 0.8}


def planted(a=0.05, b=2.0, genes=120, guides=8, seed=1):
    """Counts of ``genes`` genes, the first 20 with an effect of -2 (log2), whose last two guides do nothing."""
    rng, rows = np.random.default_rng(seed), []
    for g in range(genes):
        for k in range(guides):
            base = np.exp(rng.normal(5.5, 0.8))
            for sample, (_, treated) in DESIGN.items():
                hit = g < 20 and k < guides - 2 and treated
                mu = base * SIZE[sample] * (0.25 if hit else 1.0)
                alpha = a + b / (mu / SIZE[sample])
                rows.append((f"G{g:03}", f"G{g:03}_{k}", sample, int(rng.negative_binomial(1 / alpha, 1 / (1 + alpha * mu)))))
    return pd.DataFrame(rows, columns=["gene", "guide", "sample", "count"])


@pytest.fixture(scope="module")
def screen(spark):
    counts = spark.createDataFrame(planted()).persist()
    return counts, spark.createDataFrame(list(SIZE.items()), "sample string, size_factor double")


def test_planted_trend_is_found(screen):
    counts, sizes = screen
    got = models.dispersion_trend(counts, DESIGN, sizes).toPandas()
    assert len(got) == 960
    large = got[got["mean"] > 50]
    truth = 0.05 + 2.0 / large["mean"]
    assert np.abs(np.log(large["dispersion"] / truth)).median() < 0.2


def test_planted_effects_and_efficiencies_are_found(screen):
    counts, sizes = screen
    fits = models.mle_fits(counts, DESIGN, sizes).persist()
    table = models.effect_table(fits).toPandas().set_index("gene").sort_index()
    hits = [f"G{g:03}" for g in range(20)]
    assert (table.loc[hits, "beta"] + 2).abs().max() < 0.5 and abs(table.loc[hits, "beta"].mean() + 2) < 0.1
    assert (table.loc[hits, "fdr"] < 0.01).all() and (table.drop(hits)["fdr"] < 0.05).mean() < 0.05
    eff = models.guide_efficiency(fits).toPandas()
    eff = eff[eff["gene"].isin(hits)]
    idle = eff["guide"].str[-1].astype(int) >= 6
    assert eff.loc[idle, "efficiency"].median() < 0.05 and eff.loc[~idle, "efficiency"].median() > 0.95
    alike = models.mle(counts, DESIGN, sizes, prior=None).toPandas().set_index("gene").sort_index()
    assert abs(alike.loc[hits, "beta"].mean() + 2) > 0.3  # idle guides dilute effects where all count as efficient


def test_z_of_genes_without_effect_is_standard(spark):
    counts = spark.createDataFrame(planted(genes=300, seed=5).query("gene >= 'G020'"))
    sizes = spark.createDataFrame(list(SIZE.items()), "sample string, size_factor double")
    z = models.mle(counts, DESIGN, sizes, prior=None).toPandas()["z"]
    assert abs(z.mean()) < 0.2 and 0.85 < z.std() < 1.2


def test_score_is_zero_at_the_fit():
    rng = np.random.default_rng(0)
    y, x, size = rng.poisson(40, (5, 6)).astype(float), np.array([[0, 0], [0, 0], [1, 0], [1, 0], [0, 1], [1, 1]], float), rng.uniform(0.5, 2, 6)
    alpha = np.full(5, 0.1)
    effect, se, weight = models.fit_gene(y, x, size, alpha, None, 0.0, 100)
    guides = np.repeat(np.arange(5), 6)
    full = np.concatenate([np.eye(5)[guides], np.tile(x, (5, 1))], 1)
    coef = np.concatenate([np.zeros(5), effect])
    for _ in range(200):  # baselines alone, effects held
        mu = np.tile(size, 5) * np.exp(full @ coef)
        coef[:5] += [((y.ravel() - mu) / (1 + 0.1 * mu))[guides == g].sum() / (mu / (1 + 0.1 * mu))[guides == g].sum() for g in range(5)]
    mu = np.tile(size, 5) * np.exp(full @ coef)
    assert np.abs(full.T @ ((y.ravel() - mu) / (1 + 0.1 * mu))).max() < 1e-6
    info = full.T @ ((mu / (1 + 0.1 * mu))[:, None] * full)
    assert se == pytest.approx(np.sqrt(np.diag(np.linalg.inv(info)))[5:], rel=1e-6) and (weight == 1).all()


def test_control_guides_give_the_null(screen, spark):
    counts, sizes = screen
    controls = counts.filter("gene >= 'G080'").select("guide").distinct()
    dispersion = models.dispersion_trend(counts, DESIGN, sizes).persist()
    null = models.control_fits(counts, controls, [8], DESIGN, sizes, 60, dispersion=dispersion)
    again = models.control_fits(counts.repartition(7), controls, [8], DESIGN, sizes, 60, dispersion=dispersion)
    assert null.count() == 60 and sorted(r.gene for r in null.collect()) == sorted(r.gene for r in again.collect())
    table = models.effect_table(models.mle_fits(counts, DESIGN, sizes, dispersion), null).toPandas().set_index("gene").sort_index()
    assert (table.loc[:"G019", "control_p"] == 1 / 61).all()
    assert 0.3 < table.loc["G020":"G079", "control_p"].mean() < 0.7


def test_no_replicates_no_rows_and_zero_counts(spark):
    schema = "gene string, guide string, sample string, count bigint"
    sizes = spark.createDataFrame([("c1", 1.0), ("t1", 1.0)], "sample string, size_factor double")
    two = {"c1": [1, 0], "t1": [1, 1]}
    rows = [("G", "g1", "c1", 0), ("G", "g1", "t1", 0), ("H", "h1", "c1", 90), ("H", "h1", "t1", 100), ("H", "h2", "c1", 50), ("H", "h2", "t1", 0)]
    got = models.mle(spark.createDataFrame(rows, schema), two, sizes).toPandas()
    assert sorted(got["gene"]) == ["G", "H"] and np.isfinite(got[["beta", "z", "p"]]).all().all()
    assert models.mle(spark.createDataFrame([], schema), two, sizes).count() == 0


def test_squares_of_two_arms(spark):
    rng = np.random.default_rng(3)
    genes = {f"n{k:03}": (float(x), float(y)) for k, (x, y) in enumerate(rng.normal(0, 0.1, (200, 2)))}
    genes |= {f"e{k}": (-2.0, -4.0) for k in range(9)} | {"top": (0.0, 8.0), "bottom": (0.0, -8.0), "left": (-4.0, 0.0), "right": (4.0, 0.0), "both": (4.0, 8.0)}
    rows = [(g, k, v) for g, pair in genes.items() for k, v in zip((1, 2), pair)]
    effects = spark.createDataFrame(rows, "gene string, coefficient int, beta double")
    essential = spark.createDataFrame([(f"e{k}",) for k in range(9)], "gene string")
    got = models.beta_selection(effects, 1, 2, essential).toPandas().set_index("gene").sort_index()
    assert got.loc["e0", "control"] == -1 and got.loc["e0", "treatment"] == -1 and got.loc["e0", "selected"] is None
    assert list(got.loc[["top", "bottom", "left", "right", "both"], "square"]) == ["topcenter", "bottomcenter", "midleft", "midright", None]
    assert list(got.loc[["top", "bottom", "left", "right"], "selected"]) == ["up", "down", "up", "down"]


def test_whole_run_with_control_guides(screen):
    from editlake.params import Params
    from editlake.plans import runs

    counts, _ = screen
    controls = counts.filter("gene >= 'G100'").select("guide")
    few = counts.filter("gene < 'G012' or gene >= 'G100'")
    p = Params(analysis="screening", count_table="x", contrasts="c", mle=True)
    out = runs.screen(p, few, [(["c1", "c2", "c3"], ["t1", "t2", "t3"])], controls=controls)
    table = out["mle_0"].toPandas().set_index("gene")
    assert len(table) == 32 and (table.loc[[f"G{g:03}" for g in range(12)], "beta"] < -1).all()
    assert table["control_p"].between(0, 1).all() and out["mle_guides_0"].count() == 32 * 8
