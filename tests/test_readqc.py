"""Read QC against plain Python."""

from __future__ import annotations

import random
from collections import Counter

from editlake.operators import readqc

READS = "sample string, seq string, qual string"


def test_quantiles_content_and_tables(spark):
    rng, rows = random.Random(4), []
    for _ in range(300):
        n = rng.choice([0, 1, 30, 31, 80])
        rows.append((rng.choice("xy"), "".join(rng.choice("ACGTN") for _ in range(n)), "".join(chr(33 + rng.randrange(42)) for _ in range(n))))
    rows += [("x", None, "II"), (None, "ACGT", "IIII"), ("y", "AC", None)]
    df = spark.createDataFrame(rows, READS).repartition(5)
    kept = [r for r in rows if None not in r[1:]]
    levels = readqc.level_counts(df).persist()
    content = {(r.sample, r.cycle): r for r in readqc.base_content(levels).collect()}
    for r in readqc.cycle_quantiles(levels).collect():
        here = [(s[r.cycle - 1], ord(v[r.cycle - 1]) - 33) for name, s, v in kept if name == r.sample and len(s) >= r.cycle]
        scores = sorted(x for _, x in here)
        assert r.reads == len(here)
        for p in readqc.QUANTILES:
            assert r[f"p{p}"] == scores[max(len(scores) * p // 100, 1) - 1]
        shares = content[r.sample, r.cycle]
        assert abs(shares.g - sum(b == "G" for b, _ in here) / len(here)) < 1e-9 and abs(shares.other - sum(b == "N" for b, _ in here) / len(here)) < 1e-9
    want = Counter()
    for name, s, v in kept:
        want[name, "length", len(s)] += 1
        if s:
            gc = sum(b in "GC" for b in s)
            want[name, "gc", (200 * gc + len(s)) // (2 * len(s))] += 1
            want[name, "quality", sum(ord(x) - 33 for x in v) // len(s)] += 1
    assert {(r.sample, r.measure, r.value): r.n for r in readqc.read_tables(df).collect()} == want


def test_duplication(spark):
    long = "ACGT" * 20
    rows = [("x", "A", "I")] + [("x", "C", "I")] * 9 + [("x", "G", "I")] * 10 + [("x", long, "I" * 80)] * 30 + [("x", long[:50] + "T" * 26, "I" * 76)] * 20 + [("x", long[:75], "I" * 75)]
    got = {r.level: (r.sequences, r.reads) for r in readqc.duplication_levels(spark.createDataFrame(rows, READS)).collect()}
    assert got == {1: (2, 2), 9: (1, 9), 10: (1, 10), 50: (1, 50)}  # the two long ones begin alike


def test_contaminants_against_every_placement(spark):
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    turned = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    items = [(f"c{k}", letters(rng.choice([19, 33, 60]))) for k in range(6)]
    seqs = [letters(50) for _ in range(10)] + [items[1][1][:9], items[2][1][5:20], "ACGT", "", letters(25)]
    for _ in range(40):
        c = rng.choice(items)[1]
        c = turned(c) if rng.random() < 0.5 else c
        at = rng.randrange(len(c))
        piece = list(c[at : at + rng.choice([19, 20, 22, 40])])
        for _ in range(rng.randrange(4)):
            piece[rng.randrange(len(piece))] = rng.choice("ACGT")
        seqs.append((letters(rng.randrange(12)) + "".join(piece) + letters(rng.randrange(12)))[:50])
    want = {}
    for s in set(seqs):
        hits = []
        for name, c in items:
            for strand, t in (("+", c), ("-", turned(c))):
                if 8 <= len(s) < 20 and s in t:
                    hits.append((-len(s), 0, name, strand))
                for d in range(1 - len(t), len(s)) if len(s) >= 20 else ():
                    same = [s[i] == t[i - d] for i in range(max(0, d), min(len(s), len(t) + d))]
                    for a in range(len(same)):
                        for b in range(a + 20, len(same) + 1):
                            wrong = b - a - sum(same[a:b])
                            if wrong <= 1:
                                hits.append((a - b, wrong, name, strand))
        if hits:
            want[s] = min(hits)
    found = spark.createDataFrame([("x", s, 1) for s in seqs] + [("x", None, 1)], "sample string, seq string, n int")
    got = readqc.contaminant_hits(found, spark.createDataFrame(items + [("none", None)], "name string, sequence string"))
    assert {r.seq: (-r.size, r.wrong, r.contaminant, r.strand) for r in got.collect()} == want and len(want) > 15


def test_empty_tables(spark):
    none = spark.createDataFrame([], READS)
    assert readqc.cycle_quantiles(readqc.level_counts(none)).count() == readqc.read_tables(none).count() == readqc.duplication_levels(none).count() == 0
    assert readqc.contaminant_hits(none, spark.createDataFrame([], "name string, sequence string")).count() == 0
