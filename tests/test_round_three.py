"""Exact chances, segments and their way back to counts against plain Python."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from editlake.functions import beta
from editlake.operators import align, models


def test_beta_quantiles():
    for a, b, p in ((1, 5, 0.2), (3, 3, 0.5), (40, 2, 0.01), (1, 1, 0.7)):
        x = beta.beta_quantile(np.array([a]), np.array([b]), np.array([p]))
        assert float(beta.beta_inc(a, b, x)[0]) == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize("n", [1, 2, 5, 13, 60])
def test_chances_of_rho_by_simulation(n):
    rng, alpha = np.random.default_rng(n), 0.25
    u = np.sort(rng.random((20_000, n)), axis=1)
    tail = beta.binomial_tail(n, np.arange(1, n + 1), np.maximum(u, 1e-12))
    drawn = np.where(u <= alpha, tail, 1.0).min(1)
    asked = np.array([0.001, 0.01, 0.05, 0.1, 0.2, 0.5])
    got = beta.rho_p(n, asked, alpha)
    for r, p in zip(asked, got, strict=True):
        share = (drawn <= r).mean()
        assert abs(p - share) <= 4.5 * math.sqrt(max(p * (1 - p), 1e-4) / len(drawn)), (n, r)
    assert beta.rho_p(n, np.array([1.0]), alpha)[0] == 1


def test_small_chances_and_closed_forms():
    assert beta.rho_p(1, np.array([1e-9, 0.2, 0.9]), 0.25) == pytest.approx([1e-9, 0.2, 0.25], rel=1e-6)
    r = np.array([1e-8, 0.01, 0.3])
    one, two = np.minimum(1 - np.sqrt(1 - r), 0.25), np.minimum(np.sqrt(r), 0.25)
    assert beta.rho_p(2, r, 0.25) == pytest.approx(2 * one - one**2 + (two - one) ** 2, rel=1e-6)
    large = beta.rho_p(1500, np.array([1e-4, 1e-2]), 0.25)
    assert 1e-4 < large[0] < large[1] < 0.5


def test_the_largest_arc_is_found():
    rng = np.random.default_rng(8)
    for _ in range(40):
        x = rng.normal(size=rng.integers(2, 40))
        a = rng.integers(0, len(x))
        x[a : a + 6] += 1
        n, sums = len(x), np.concatenate(([0], np.cumsum(x - x.mean())))
        want = max(abs(sums[j] - sums[i]) / x.std() / math.sqrt((j - i) * (1 - (j - i) / n)) for i in range(n) for j in range(i + 1, n + 1) if j - i < n)
        t, i, j = (v[0] for v in models.largest_arcs(x[None]))
        assert t == pytest.approx(want)
        assert abs(sums[j] - sums[i]) / x.std() / math.sqrt((j - i) * (1 - (j - i) / n)) == pytest.approx(want)
    assert models.largest_arcs(np.full((1, 9), 3.7))[0][0] == 0


def test_planted_segments_are_found_in_noise(spark):
    rng = np.random.default_rng(4)
    rows = [(f"g{k:03}", f"gene{k // 2}", "c1", k, float(rng.normal(0, 0.2) + (1.5 if 18 <= k < 24 else 0))) for k in range(60)]
    df = spark.createDataFrame(rows, "guide string, gene string, chrom string, pos long, fc double")
    got = {r.pos: r.segment for r in models.copy_number_correction(df).collect()}
    assert [got[17], got[18], got[23], got[24]] == [0, 1, 1, 2] and max(got.values()) == 2


def test_counts_come_back(spark):
    rows = spark.createDataFrame([(7.0, 31.0), (100.0, 0.0)], "control double, x double")
    change = F.log2((F.col("x") + 0.5) / (F.col("control") + 0.5))
    assert [r.x == pytest.approx(r.y) for r in rows.withColumn("y", models.corrected_count(F.col("control"), change)).collect()] == [True, True]
    assert rows.select(models.corrected_count(F.col("control"), F.lit(-20.0)).alias("y")).first().y == 0


def mutated(r, text, gaps, share=0.01):
    out = [r.choice("ACGT") if r.random() < share else c for c in text]
    for n in gaps:
        k = r.randrange(200, len(out) - 200)
        if n > 0:
            out[k:k] = [r.choice("ACGT") for _ in range(n)]
        else:
            del out[k : k - n]
    return "".join(out)


@pytest.mark.parametrize("profile", ["minimap2", "bwa", "bowtie2"])
def test_long_pairs_score_as_in_the_whole_table(profile):
    r = random.Random(profile)
    s = align.PROFILES[profile]
    for mode in ("global-local", "global", "local"):
        subject = "".join(r.choice("ACGT") for _ in range(1500))
        query = mutated(r, subject[200:1400] if mode != "global" else subject, [r.randrange(1, 40), -r.randrange(1, 40), -3])
        assert len(query) * len(subject) > align.LONG
        got, want = align.align_long(query, subject, mode, s), align.align_batch([query], [subject], mode, s)[0]
        assert got == want


def test_reads_of_ten_thousand_bases_need_little_memory():
    import tracemalloc

    r = random.Random(12)
    subject = "".join(r.choice("ACGT") for _ in range(12_000))
    query = mutated(r, subject[1000:11_000], [60, -45, 5, -1])
    tracemalloc.start()
    score, start, end, cigar = align.align_long(query, subject, "global-local", align.PROFILES["minimap2"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sizes = [(int(n), op) for n, op in re.findall(r"(\d+)([MID])", cigar)]
    assert peak < 100e6 and start == 1001 and end == 11_000
    assert sum(n for n, op in sizes if op != "D") == len(query) and {(60, "I"), (45, "D")} <= set(sizes)
    # A path through the planted gaps is one of those that were tried.
    assert score > 29 * 9700 - 17 * 160 - 4 * 25 - 2 * 111


def test_pairs_without_a_chain_fill_the_whole_table():
    r = random.Random(2)
    a, b = ("".join(r.choice(x) for _ in range(1100)) for x in ("AC", "GT"))
    s = align.PROFILES["bwa"]
    assert align.chain(a, b) is None
    assert align.align_long(a, b, "global", s) == align.align_batch([a], [b], "global", s)[0]
    assert align.chain("ACGT", "ACGTACGTACGTACGTT") is None and align.minimisers("")[0].size == 0


def test_long_and_short_pairs_in_one_table(spark):
    r = random.Random(5)
    subject = "".join(r.choice("ACGT") for _ in range(1400))
    rows = [("long", subject[:600] + subject[640:], subject), ("short", "ACGT", "TTACGTTT"), ("none", None, "A")]
    df = spark.createDataFrame(rows, "k string, q string, s string")
    got = {x.k: (x.start, x.end, x.cigar) for x in align.align_pairs(df, "q", "s").collect()}
    assert got["short"] == (3, 6, "4M") and "none" not in got
    a, b = (int(n) for n in re.fullmatch(r"(\d+)M40D(\d+)M", got["long"][2]).groups())
    assert abs(a - 600) < 12 and a + b == 1360


def test_cut_sites_of_guides_that_are_not_exact(spark):
    ref = "TTGACCATTGACGGATCCTTAAGGCATCGATTGCCAGTACCGG"
    swap = str.maketrans("ACGT", "TGCA")
    guide = ref[10:30]
    changed = guide[:8] + guide[8].translate(str.maketrans("ACGT", "CGTA")) + guide[9:]
    rows = [("exact", guide), ("changed", changed.lower()), ("back", guide.translate(swap)[::-1]), ("changed back", changed.translate(swap)[::-1]), ("null", None)]
    df = spark.createDataFrame([(k, g, ref) for k, g in rows], "k string, guide string, reference string")
    for rel in (-3, 17):
        got = {r.k: r.cut_site for r in align.cut_sites(df, "reference", rel).collect()}
        assert got["exact"] == got["changed"] and got["back"] == got["changed back"] and None not in (got["exact"], got["back"])
        assert len(got) == 5
