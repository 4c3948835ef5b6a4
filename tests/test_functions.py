"""Statistics, sequences and CIGARs on cases worked out by hand or with other means."""

from __future__ import annotations

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from editlake.functions import seq as q
from editlake.functions import stats
from editlake.operators import models, screening, targeted


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_normal_tail(spark):
    xs = [-8.0, -1.5, 0.0, 0.3, 2.0, 7.5, 12.0]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", stats.normal_tail(F.col("x")).alias("p")).collect()
    for r in rows:
        assert math.isclose(r.p, 0.5 * math.erfc(r.x / math.sqrt(2)), rel_tol=1e-7)


def test_fdr_by_hand(spark):
    df = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.9)], "gene string, p double")
    got = {r.gene: (r.rank, round(r.fdr, 6)) for r in stats.bh_fdr(df, "p", "rank", "fdr", [], ["gene"]).collect()}
    assert got == {"a": (1, 0.04), "c": (2, 0.053333), "b": (3, 0.053333), "d": (4, 0.9)}


def test_poisson_tail(spark):
    for k, mean in ((0, 3.0), (1, 3.0), (7, 3.0), (60, 20.0)):
        exact = -math.log(sum(math.exp(-mean + i * math.log(mean) - math.lgamma(i + 1)) for i in range(k, 400)))
        assert math.isclose(one(spark, stats.poisson_neg_log_tail(F.lit(k), F.lit(mean))), max(exact, 0), rel_tol=1e-8, abs_tol=1e-8)


def test_poisson_tail_of_large_means(spark):
    log = lambda i, mean: -mean + i * math.log(mean) - math.lgamma(i + 1)
    for k, mean in ((500, 1000.0), (4000, 5000.0), (999, 1000.0), (2950, 3000.0), (1, 2000.0), (3000, 3000.0), (4200, 4000.0), (20000, 19900.0)):
        exact = -math.log(math.fsum(math.exp(log(i, mean)) for i in range(k, k + 30000)))
        assert math.isclose(one(spark, stats.poisson_neg_log_tail(F.lit(k), F.lit(mean))), max(exact, 0), rel_tol=1e-7, abs_tol=1e-8), (k, mean)


def test_binomial_tail(spark):
    for n, k, p in ((5, 1, 0.2), (5, 5, 0.2), (13, 4, 0.07)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))
        assert math.isclose(one(spark, models.binomial_tail(F.lit(n), F.lit(k), F.lit(p))), exact, rel_tol=1e-9)


def test_revcomp_twice_is_the_same(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text("ACGTN", max_size=30), min_size=1, max_size=10))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "s string")
        assert all(r.s == r.t for r in df.select("s", q.revcomp(q.revcomp(F.col("s"))).alias("t")).collect())

    check()


def test_clips_and_masks(spark):
    assert one(spark, q.strip_clips(F.lit("5H10S20M3S"))) == "10S20M"
    assert one(spark, q.mask_low_quality(F.lit("ACGT"), F.lit("I+I5"))) == "ANGT"
    assert one(spark, q.cigar_lengths(F.lit("3M12D1I"))) == [3, 12, 1]
    assert one(spark, q.cigar_ops(F.lit("3M12D1I"))) == ["M", "D", "I"]


def test_local_sd_like_a_loop(spark):
    rng = np.random.default_rng(1)
    n, h = 137, 20
    fc, raw = rng.normal(size=n), np.arange(n)[::-1].astype(float)
    df = spark.createDataFrame([(f"g{i:03}", "x", 0, float(raw[i]), float(fc[i])) for i in range(n)], "guide string, gene string, replicate int, raw_control double, fc double")
    got = {r.guide: r.eb_std for r in screening.local_sd(df, h).collect()}
    want, now = np.zeros(n), 0.0
    for start in range(h, n - h):
        if (start - h) % 25 == 0:
            now = max(now, fc[start - h : start + h].std(ddof=1))
        want[start] = now
    want[:h], want[n - h :] = want[h], want[n - h - 1]
    assert all(math.isclose(got[f"g{i:03}"], want[i], rel_tol=1e-9) for i in range(n))


def called(spark, cigars):
    rows = [("s", f"r{k}", 1, c) for k, c in enumerate(cigars)]
    a = spark.createDataFrame(rows, "sample string, qname string, pos bigint, raw_cigar string")
    return targeted.call_variants(targeted.collapse(targeted.explode_cigars(a)))


def test_calls_by_number_of_operations(spark):
    c = called(spark, ["100M", "60M", "50M3D50M", "50M2I48M", "10M2D3I85M", "40M4D1M2I55M", "9M1D9M1I9M1D9M", "1M1I1M1I1M1I1M1I", "1M1I1M1I1M1I"])
    got = {r.cigar: (r["class"], r.start, r.length) for r in c.collect()}
    assert got["100M"][0] == "wt" and got["60M"][0] == "bad_wt"
    assert got["50M3D50M"] == ("del", 51, 3) and got["50M2I48M"] == ("ins", 51, 2)
    plain = {(r.cigar, r["class"]) for r in targeted.reclassify(c).collect()}
    assert ("10M2D3I85M", "delin") in plain and ("40M4D1M2I55M", "delin") in plain
    assert ("9M1D9M1I9M1D9M", "bad_alignment") in plain and ("1M1I1M1I1M1I1M1I", "bad_alignment") in plain
    mock = [(r["class"], r.start, r.length) for r in targeted.reclassify(c, mock=True).filter("cigar = '9M1D9M1I9M1D9M'").collect()]
    assert sorted(mock) == [("del", 10, 1), ("del", 29, 1), ("ins", 20, 1)]


def test_no_insertion_filter_as_written(spark):
    rows = [("s", "q", 51, 2, "ins", "50M2I48M", "I" * 100)] * 5 + [("s", "q", 51, 3, "del", "50M3D48M", "I" * 100)] * 5
    r = spark.createDataFrame(rows, "sample string, qname string, start bigint, length bigint, modification string, raw_cigar string, qual string")
    w = spark.createDataFrame([("s", 3)], "sample string, wt bigint")
    assert targeted.error_filter(r, w).count() == 2
    assert [x.modification for x in targeted.error_filter(r, w, "as_written").collect()] == ["del"]


def test_homology_rules(spark):
    d = spark.createDataFrame([(5, 3)], "start bigint, length bigint")
    assert targeted.homology(d, "AACTGGCAAA").first().pattern == "NHEJ"
    assert targeted.homology(d, "AACTACTGGG").first().pattern == "ACT"  # the left flank ends as the deletion does
    assert targeted.homology(d, "TTTTGCAGCATT").first().pattern == "GCA"
    assert targeted.homology(d, "TTTTGCAGC").first().pattern == "G"  # matched to its end: one less


def test_clonality_rules(spark):
    e = spark.createDataFrame(
        [("a", 950, 0, 0, 0, 0, 50, 0), ("b", 10, 0, 0, 0, 0, 90, 0), ("c", 0, 0, 0, 0, 0, 0, 1000), ("d", 500, 0, 0, 250, 0, 0, 250)],
        "sample string, wt long, template_based long, delins long, ins_inframe long, ins_outframe long, dels_inframe long, dels_outframe long",
    )
    g = spark.createDataFrame([("a", 50), ("b", 90), ("c", 900), ("c", 100), ("d", 250), ("d", 250)], "sample string, n long")
    got = {r.sample: (r.clonality, r.classification, r.confidence) for r in targeted.clonality(targeted.percentages(e), g).collect()}
    assert got["a"][0] == "Low editing activity" and got["a"][1] == "Hom WT"
    assert got["b"] == ("Insufficient data for analysis", "Ambiguous", None)
    assert got["c"][0] == "Clonal" and got["d"][0] == "Ambiguous"
    assert math.isclose(got["d"][2], 1 - 2000 / 3000 * 0.1)


def test_expected_edges_like_simulation(spark):
    rng = np.random.default_rng(5)
    pairs = {tuple(sorted(rng.choice(40, 2, replace=False))) for _ in range(150)}
    edges = spark.createDataFrame([(f"g{a}", f"g{b}") for a, b in pairs], "u string, v string")
    degree = np.zeros(40, int)
    for a, b in pairs:
        degree[[a, b]] += 1
    order = [k for k in rng.permutation(40) if degree[k]]
    ranked = spark.createDataFrame([(f"g{k}", i + 1) for i, k in enumerate(order)], "gene string, rank int")
    got = {r.i: r.expected for r in screening.expected_edges(ranked, edges, 12).collect()}
    bins = np.where(degree <= 10, degree, 30)
    total = []
    for _ in range(3000):
        drawn = set()
        for d in set(bins[order[:12]]):
            drawn |= set(rng.choice(np.flatnonzero(bins == d), sum(bins[k] == d for k in order[:12]), replace=False))
        total.append(sum(a in drawn and b in drawn for a, b in pairs))
    assert abs(np.mean(total) - got[12]) < 5 * np.std(total) / math.sqrt(len(total))
