"""Consensus by qualities: planted errors, insertions that the centre lacks, and every column against plain Python."""

from __future__ import annotations

import random

from editlake.operators import align

MEMBERS = "sample string, cluster string, seq string, qual string, centre string"
letters = lambda rng, n: "".join(rng.choice("ACGT") for _ in range(n))


def noisy(rng, text):
    """A read of the text, and its qualities: a fifth of the bases have a low one, and half of these are wrong, missing or followed by another."""
    seq, qual = [], []
    for b in text:
        mark, rate = ("%", 0.5) if rng.random() < 0.2 else ("F", 0.002)
        kind = rng.random() if rng.random() < rate else 1.0
        if kind < 0.9:
            seq.append(rng.choice([x for x in "ACGT" if x != b]) if kind < 0.8 else b)
            qual.append(mark)
            if kind >= 0.8:
                seq.append(rng.choice("ACGT"))
                qual.append("%")
        elif kind == 1.0:
            seq.append(b)
            qual.append(mark)
    return "".join(seq), "".join(qual)


def distance(a, b):
    """Edit distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_beats_the_majority(spark):
    rng, rows, truth = random.Random(21), [], {}
    for c in range(40):
        truth[str(c)] = letters(rng, 90)
        rows += [("s", str(c), *noisy(rng, truth[str(c)]), "") for _ in range(10)]
    df = spark.createDataFrame(rows, MEMBERS).repartition(3)
    errors = lambda made: sum(distance(truth[r.cluster], r.consensus) for r in made.collect())
    assert 3 * errors(align.polish_by_quality(df.drop("centre"), 3)) < errors(align.polish(df.drop("centre", "qual"), 3))


def test_insertions_and_ends(spark):
    rows = []
    for cluster, centre, seqs in (
        ("in", "ACGTTGCA", [("ACGTCCTGCA", "I" * 10)] * 2 + [("ACGTTGCA", "I" * 8)]),  # two of three insert CC
        ("one", "ACGTTGCA", [("ACGTCCTGCA", "IIII##IIII")] + [("ACGTTGCA", "I" * 8)]),  # a doubtful one doesn't
        ("front", "CGTTGCAT", [("AACGTTGCAT", "I" * 10)] * 3),
        ("back", "ACGTTGCA", [("ACGTTGCAGG", "I" * 10)] * 3),
        ("lost", "ACGTTGCA", [("ACGTGCA", "I" * 7)] * 2 + [("ACGTTGCA", "IIII#III")]),
        ("empty", "ACGT", [("", "")]),
    ):
        rows += [("s", cluster, s, v, centre) for s, v in seqs]
    rows += [("s", "in", None, "I", "A"), ("s", "in", "AC", None, "A"), ("s", "in", "ACG", "II", "ACG"), ("s", "none", "AC", "II", None)]
    got = {r.cluster: r.consensus for r in align.consensus_by_quality(spark.createDataFrame(rows, MEMBERS)).collect()}
    assert got["in"] == "ACGTCCTGCA" and got["one"] == "ACGTTGCA" and got["front"] == "AACGTTGCAT" and got["back"] == "ACGTTGCAGG"
    assert got["lost"] == "ACGTGCA" and got.get("empty", "") == "" and "none" not in got
    assert align.consensus_by_quality(spark.createDataFrame([], MEMBERS)).count() == 0


def test_votes_are_the_same_in_any_parts(spark):
    rng = random.Random(3)
    centre = letters(rng, 40)
    rows = [("s", "c", *noisy(rng, centre), centre) for _ in range(50)]
    df = spark.createDataFrame(rows, MEMBERS)
    a, b = (sorted(map(tuple, align.quality_votes(x).collect())) for x in (df.coalesce(1), df.repartition(9)))
    assert a == b
    total = sum(1 for _ in range(41))
    assert sum(1 for r in a if r[4] == "|" and r[3] == 0) == total
