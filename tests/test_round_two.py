"""Resampling, tails, trimming, joins and hierarchies against plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from editlake.functions import beta
from editlake.operators import align, channels, models, plots, resampling, targeted
from editlake.sources import tables


def test_binomial_and_negative_binomial_tails():
    for n, k, p in ((5, 2, 0.1), (133, 30, 0.2), (1, 1, 0.25), (20, 20, 0.9), (60, 1, 0.01)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))
        assert float(beta.binomial_tail(n, np.array([k]), np.array([p]))[0]) == pytest.approx(want, rel=1e-9)
    for mean, var, x in ((3.0, 30.0, 0), (50.0, 80.0, 41), (200.0, 900.0, 300), (7.0, 7.1, 4)):
        r = mean * mean / (var - mean)
        pmf = [math.exp(math.lgamma(i + r) - math.lgamma(r) - math.lgamma(i + 1) + r * math.log(r / (r + mean)) + i * math.log(mean / (r + mean))) for i in range(x + 1)]
        low, high = beta.negative_binomial_tails(np.array([mean]), np.array([var]), np.array([float(x)]))
        assert low[0] == pytest.approx(sum(pmf), rel=1e-7) and high[0] == pytest.approx(1 - sum(pmf[:-1]), rel=1e-6)


def test_large_genes_have_p_values(spark):
    scores = spark.createDataFrame([("a", 1500, 3, 1e-4), ("b", 2, 1, 0.3)], "gene string, num bigint, good bigint, rho double")
    got = {r.gene: r.pvalue for r in models.permutation_p(scores, rounds=2).collect()}
    assert 0 < got["a"] < 0.2 and 0 < got["b"] < 1


def test_trimming_by_brute_force(spark):
    r = random.Random(4)
    adapters = ["ACGTTGCA", "GGAT"]
    reads = ["".join(r.choice("ACGT") for _ in range(r.randrange(0, 30))) for _ in range(200)] + [None, "", "AC", "ACGTTGCA"]

    def trim(x, end):
        y, best = x if end == 3 else x[::-1], None
        for k, a in enumerate(adapters):
            a = a if end == 3 else a[::-1]
            for i in range(len(y) - 2):
                n = min(len(a), len(y) - i)
                wrong = sum(y[i + j] != a[j] for j in range(n))
                if wrong <= math.floor(0.2 * n + 1e-9):
                    best = min(best or (99,), (-(n - wrong), wrong, i, k))
        if best is None:
            return x, None
        return (y[: best[2]] if end == 3 else y[: best[2]][::-1]), best[3]

    df = spark.createDataFrame(list(enumerate(reads)), "id long, seq string")
    for end in (3, 5):
        got = {x.id: (x.seq, x.adapter) for x in targeted.trim_adapters(df, adapters, end, 0.2).collect()}
        for k, x in enumerate(reads):
            assert got[k] == ((None, None) if x is None else trim(x, end)), (end, x)


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


@pytest.mark.parametrize("rate", [0.1, 0.2, 0.34])
def test_trimming_with_indels_by_brute_force(spark, rate):
    r = random.Random(6)
    adapters = ["ACGTTGCAAT", "GGATC"]
    reads = ["".join(r.choice("ACGT") for _ in range(r.randrange(0, 26))) for _ in range(60)] + [None, "", "AC", "ACGTTGCAAT", "é" + "ACGTTGCAAT"]
    for _ in range(60):  # planted, with a base changed, missing or more
        a, own = list(r.choice(adapters)), "".join(r.choice("ACGT") for _ in range(9))
        k = r.randrange(1, len(a) - 1)
        r.choice([lambda a, k: a.__setitem__(k, "T"), lambda a, k: a.pop(k), lambda a, k: a.insert(k, "C")])(a, k)
        reads.append(own + "".join(a)[: r.randrange(4, 12)] + r.choice(("", "GTC")))

    def trim(x, end):
        y, best = x if end == 3 else x[::-1], None
        for k, a in enumerate(adapters):
            a = a if end == 3 else a[::-1]
            for i in range(len(y)):
                tried = [(len(a), e) for e in range(i, len(y) + 1)] + [(n, len(y)) for n in range(3, len(a) + 1)]
                for n, e in tried:
                    if abs(e - i - n) <= rate * n and (wrong := edits(y[i:e], a[:n])) <= math.floor(rate * n + 1e-9):
                        best = min(best or (99,), (-(n - wrong), wrong, i, k))
        if best is None:
            return x, None
        return (y[: best[2]] if end == 3 else y[: best[2]][::-1]), best[3]

    df = spark.createDataFrame(list(enumerate(reads)), "id long, seq string")
    for end in (3, 5):
        got = {x.id: (x.seq, x.adapter) for x in targeted.trim_adapters(df, adapters, end, rate, indels=True).collect()}
        for k, x in enumerate(reads):
            assert got[k] == ((None, None) if x is None else trim(x, end)), (end, x)


def test_a_key_that_comes_twice_on_the_right_is_an_error(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q")], "k int, y string")
    with pytest.raises(Exception, match="more than once"):
        channels.unique_join(left, right, ["k"]).collect()
    assert channels.unique_join(left, right.filter("y = 'p'"), ["k"], True).count() == 2


def test_columns_by_number_or_name():
    assert tables.columns_by(["a", "b", "c"], [1, "3", "b"]) == ["a", "c", "b"]
    for wrong in (0, 4, "d"):
        with pytest.raises(ValueError):
            tables.columns_by(["a", "b", "c"], [wrong])
    assert tables.genome_entry({"g": {"fasta": "x"}}, "g", "fasta") == "x" and tables.genome_entry({}, None, "fasta") is None


def test_significant_digits(spark):
    row = spark.range(1).select(tables.significant(F.lit(1234.5)).alias("a"), tables.significant(F.lit(0.00012345)).alias("z")).first()
    assert float(row.a) == 1230 and float(row.z) == 0.000123


def test_clusters_join_the_first_centre_near(spark):
    r = random.Random(9)
    base = "".join(r.choice("ACGT") for _ in range(56))
    more, less = base[:30] + "G" + base[30:], base[:10] + base[11:]
    other = "".join(r.choice("ACGT") for _ in range(56))
    rows = [("s", x) for x in [base] * 5 + [more] * 2 + [less] * 3 + [other] + [base[::-1]] * 2]
    got = {x.umi: (x.cluster, x.n) for x in align.cluster_umis(spark.createDataFrame(rows, "sample string, umi string")).collect()}
    assert got == {base: (base, 5), more: (base, 2), less: (base, 3), other: (other, 1), base[::-1]: (base[::-1], 2)}


def test_network_factors_by_numpy(spark):
    r = np.random.default_rng(5)
    genes = [f"g{k}" for k in range(60)]
    score = {g: round(float(r.normal(0.4 if k < 25 else -0.4, 1.0)), 3) for k, g in enumerate(genes)}
    bf = {g: float(k) for k, g in enumerate(genes)}
    ess, non = genes[:20], genes[30:55]
    drawn = [(i, g) for i in range(3) for k, g in enumerate(genes) if k % 3 != i]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    one = lambda x: frame([(g,) for g in x], "gene string")
    made = resampling.network_factors(
        frame([(g, score[g]) for g in genes[:-1]], "gene string, boost double"), frame(list(bf.items()), "gene string, bf double"),
        one(ess), one(non), frame(drawn, "iteration int, gene string"),
    )
    got = {x.gene: (x.boost, x.boosted) for x in made.collect()}

    def kde(values, at):
        v = np.array(values)
        bw = len(v) ** -0.2 * v.std(ddof=1)
        return np.exp(-(((at - v) / bw) ** 2) / 2).sum() / (len(v) * bw * math.sqrt(2 * math.pi))

    total = {}
    for i in range(3):
        train = [g for j, g in drawn if j == i and g != genes[-1]]
        e, o = [score[g] for g in train if g in ess], [score[g] for g in train if g in non]
        grid = lambda v: [k / 100 for k in range(math.ceil(min(v) * 100 - 1e-9), math.floor(max(v) * 100 + 1e-9) + 1)]
        ratio = lambda x: math.log2(kde(e, x) / kde(o, x))
        low = min(x for x in grid(e) if ratio(x) > -5 and x < np.mean(e))
        high = max(x for x in grid(o) if ratio(x) < 5 and x > np.mean(o))
        used = [score[g] for g in train if low <= score[g] <= high]
        slope, cut = np.polyfit([np.rint(x * 100) / 100 for x in used], [ratio(x) for x in used], 1)
        for k, g in enumerate(genes[:-1]):
            if k % 3 == i:
                total[g] = slope * score[g] + cut
    for g in genes:
        assert got[g][0] == pytest.approx(total.get(g, 0.0), abs=1e-4) and got[g][1] == pytest.approx(bf[g] + total.get(g, 0.0), abs=1e-4)


def test_stage_hierarchy_leaves_out_empty_stages(spark):
    rows = [("s", "raw", 9), ("s", "merged", 0), ("s", "kept", 4)]
    got = plots.stage_hierarchy(spark.createDataFrame(rows, "sample string, stage string, n long"), ["raw", "merged", "kept"]).collect()
    assert sorted((x["class"], x.parent, x.n) for x in got) == [("kept", "raw", 4), ("raw", "", 9)]
