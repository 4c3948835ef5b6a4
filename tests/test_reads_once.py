"""Amplicon steps look at every read once, and at what reads have in common once for all of them."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from editlake.operators import targeted as t
from editlake.plans import targeted as plans


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_error_filter_takes_reads_once(spark):
    columns = "sample bigint, start bigint, length bigint, modification string, raw_cigar string, qual string"
    rows = [(0, 11, 2, "del", "10M2D5M", "I" * 15)] * 3 + [(0, 4, 1, "ins", "3M1I5M", "!" * 9), (0, 4, 1, "delin", "3M1I1D5M", None)]
    reads = spark.createDataFrame(rows, columns).repartition(2)
    made = t.error_filter(reads, spark.createDataFrame([(0, 7)], "sample bigint, wt bigint"))
    assert [tuple(x) for x in made.collect()] == [(0, 11, 2, "del")]
    assert plan(made).count("raw_cigar#") and len(re.findall(r"RepartitionByExpression|Repartition ", plan(made))) == 1


def test_calls_collapse_once(spark):
    calls = plans.Calls(spark, "/root/testdata/sf0.001")
    assert plan(calls.reads()).count("l_linestatus") <= plan(plans.aligned(spark, "/root/testdata/sf0.001")).count("l_linestatus")
    reads = calls.reads().select("sample", "start", "length", "modification").distinct()
    assert sorted(map(tuple, reads.collect())) == sorted(map(tuple, calls.genotypes().collect()))


def test_substitutions_with_clips_gaps_and_poor_bases(spark):
    rng, rows = random.Random(3), []
    for k in range(200):
        ops = rng.choice([[(5, "S"), (20, "M"), (3, "D"), (10, "M")], [(12, "M"), (4, "I"), (9, "M"), (2, "S")], [(30, "=")], [(3, "H"), (7, "X"), (50, "N"), (4, "M")], []])
        size = rng.choice([40, 25, 9, 0])
        rows.append((k % 3 if k % 7 else None, 1 + k % 5, "".join(f"{n}{c}" for n, c in ops), "".join(rng.choices("ACGTN", k=size)), "".join(rng.choices("!+5I", k=size)), 60))
    want = Counter()
    for sample, pos, cigar, seq, qual, _ in rows:
        ref, read = pos, 0
        for n, c in ((int(n), c) for n, c in re.findall(r"(\d+)([A-Z=])", cigar)):
            if c in "M=X":
                for i in range(max(0, min(n, len(seq) - read))):
                    if ord(qual[read + i]) - 33 >= 10:
                        want[sample, ref + i, seq[read + i]] += 1
            ref, read = ref + n * (c in "M=XDN"), read + n * (c in "M=XIS")
    df = spark.createDataFrame(rows, "sample bigint, pos bigint, raw_cigar string, seq string, qual string, mapq int").repartition(3)
    made = t.substitutions(df, min_depth=1)
    total = Counter()
    for (sample, pos, _), n in want.items():
        total[sample, pos] += n
    assert {(x.sample, x.pos, x.nucleotide): x.percentage for x in made.collect()} == {k: round(n * 100.0 / total[k[:2]], 2) for k, n in want.items()}
    assert "Generate" not in plan(made)


def test_a_read_of_a_document_is_cut_once(spark):
    rows = spark.createDataFrame([(k, k) for k in range(40)], "l_partkey bigint, l_orderkey bigint")
    made = plans.read_of(rows, spark, "/root/testdata/sf0.001")
    assert "substr" not in plan(made)
    from editlake.plans import bindings as b

    docs = {r.doc_id: r for r in b.letters(spark, "/root/testdata/sf0.001").collect()}
    for x in made.collect():
        d = docs.get(x.l_partkey % len(docs))
        cut = d.letters[x.l_orderkey % d.n_reads * 150 :][:150] if d is not None and d.letters else None
        assert x.seq == (cut and "".join("ACGT"[(ord(c) - 97) % 4] for c in cut)) and x.qual == (cut and "".join("+5?I"[(ord(c) - 97) % 4] for c in cut))
