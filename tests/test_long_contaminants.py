"""A long contaminant is cut into words piece by piece."""

from __future__ import annotations

import time

import numpy as np

from editlake.operators import readqc


def test_hits_in_a_long_contaminant(spark):
    rng = np.random.default_rng(8)
    long = "".join(rng.choice(list("ACGT"), 3_000))
    turned = long[::-1].translate(str.maketrans("ACGT", "TGCA"))
    at = [0, 45, 63, 64, 127, 1_500, 2_950]
    seqs = [long[k : k + 50] for k in at] + [turned[k : k + 40] for k in at[:-1]] + [long[-15:], long[55:70]]
    found = spark.createDataFrame([("s", x, 2) for x in seqs], "sample string, seq string, n long")
    items = spark.createDataFrame([("long", long), ("long", long), ("none", None), ("empty", "")], "name string, sequence string")
    began = time.monotonic()
    got = {r.seq: (r.contaminant, r.size, r.wrong) for r in readqc.contaminant_hits(found, items).collect()}
    assert got == {x: ("long", len(x), 0) for x in seqs}
    assert time.monotonic() - began < 60
