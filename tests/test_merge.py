"""Merging of mates: the best overlap against every shift, planted fragments, and unrelated mates."""

from __future__ import annotations

import math
import random

import numpy as np

from editlake.operators import align

turned = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
letters = lambda rng, n: "".join(rng.choice("ACGT") for _ in range(n))
marks = lambda rng, n: "".join(chr(33 + rng.choice([2, 12, 25, 37])) for _ in range(n))


def test_best_overlap_of_every_shift():
    rng, table = random.Random(2), align.overlap_scores()
    pairs = []
    for _ in range(120):
        whole = letters(rng, rng.randrange(1, 50))
        s1, s2 = (whole + letters(rng, 9))[: rng.randrange(40)], (letters(rng, 9) + whole)[-rng.randrange(1, 40) :]
        s2 = "".join(rng.choice("ACGTN") if rng.random() < 0.1 else b for b in s2)
        pairs.append((s1, marks(rng, len(s1)), s2, marks(rng, len(s2))))
    at, chance = align.best_overlaps(*map(list, zip(*pairs)), 8)
    for (s1, q1, s2, q2), d, p in zip(pairs, at, chance):
        found = (0, 0)
        for shift in range(8 - len(s2), len(s1) - 7):
            lo, hi = max(0, shift), min(len(s1), shift + len(s2))
            if hi - lo >= 8:
                score = sum(int(table[int(s1[i] == s2[i - shift])][ord(q1[i]) - 33, ord(q2[i - shift]) - 33]) for i in range(lo, hi))
                if score > 0:
                    found = max(found, (score, shift)) if found[0] else (score, shift)  # ties: the largest shift
        assert d == found[1] and (found[0] or p == 1)


def test_planted_fragments_and_unrelated_mates(spark):
    rng, rows, wholes = random.Random(7), [], {}
    for k in range(400):
        whole = letters(rng, rng.randrange(60, 180))  # shorter than a read too: both mates read on
        past = letters(rng, 100)
        s1, s2 = (whole + past)[:100], turned((past + whole)[-100:])
        bad = lambda s: "".join(rng.choice("ACGT") if rng.random() < 0.02 else b for b in s)
        rows.append((k, bad(s1), "I" * 100, bad(s2), "I" * 100))
        wholes[k] = len(whole)
    for k in range(400, 2400):
        rows.append((k, letters(rng, 100), marks(rng, 100), letters(rng, 100), marks(rng, 100)))
    rows += [(-1, None, "I", "A", "I"), (-2, "", "", "", ""), (-3, "ACGT", "III", "ACGT", "IIII"), (-4, "A" * 80, "I" * 80, "T" * 80, "I" * 80)]
    df = spark.createDataFrame(rows, "id int, seq1 string, qual1 string, seq2 string, qual2 string")
    got = {r.id: r for r in align.merge_pairs(df).collect()}
    right = [len(got[k].merged or "") == n for k, n in wholes.items()]
    assert sum(right) >= 396
    assert all(got[k].merged is None or len(got[k].merged) == len(got[k].merged_qual) == n for k, n in wholes.items())
    assert sum(got[k].merged is not None for k in range(400, 2400)) <= 0.01 * 2000
    assert [got[k].merged for k in (-1, -2, -3, -4)] == [None] * 4  # one letter alone proves no overlap


def test_bound_holds():
    """The bound is no smaller than the share of unrelated mates that do as well."""
    rng = random.Random(1)
    many = [(letters(rng, 30), marks(rng, 30), letters(rng, 30), marks(rng, 30)) for _ in range(4000)]
    _, chance = align.best_overlaps(*map(list, zip(*many)), 10)
    for level in (0.5, 0.1, 0.02):
        assert np.mean(chance <= level) <= level + 3 * math.sqrt(level / 4000)


def test_quality_decides(spark):
    s1, s2 = "ACGTTGCAAGGCTTAACCGT", "GGCTTAACGGTTTACGACGA"
    whole = letters(random.Random(5), 60)
    wrong = whole[:35] + ("A" if whole[35] != "A" else "C") + whole[36:40]
    rows = [("low", wrong, "I" * 35 + "#" + "I" * 4, turned(whole[20:]), "I" * 40), ("none", s1, "I" * 20, turned(s2), "I" * 20)]
    got = {r.k: r for r in align.merge_pairs(spark.createDataFrame(rows, "k string, seq1 string, qual1 string, seq2 string, qual2 string")).collect()}
    assert got["low"].merged == whole and got["low"].merge_p < 1e-6
