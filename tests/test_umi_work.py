"""UMIs: errors as bits against whole alignments, and clusters without alignments where no difference is allowed."""

from __future__ import annotations

import numpy as np
import pandas as pd

from editlake.operators import align


def test_pattern_errors():
    rng = np.random.default_rng(5)
    texts = ["", "N", "é" * 4, "acgtacgt", *("".join(rng.choice(list("ACGTNacgt-"), k)) for k in rng.integers(0, 61, 400))]
    for pattern in ("NNNNRYNN", "ACGTACGT", "TTGCATGC", "A", "GATTACAGATTACA" * 4):
        want = [-x[0] for x in align.align_batch([pattern] * len(texts), texts, "global-local", align.PROFILES["edits"])]
        assert align.pattern_errors(texts, pattern).tolist() == want


def test_inside(spark):
    run = align.inside().func
    a = pd.Series(["", "ACT", "ACT", "AAA", "ACGT", "ACGT"])
    b = pd.Series(["", "AGCGT", "AGGT", "AA", "ACGT", "ACGGGT"])
    assert run(a, b).tolist() == [True, True, False, False, True, True]


def test_no_alignment_without_differences(spark, monkeypatch):
    """Bases alone: no pair is aligned. Counts given or counted make the same clusters."""
    rng = np.random.default_rng(6)
    base = ["".join(rng.choice(list("ACGT"), 56)) for _ in range(30)]
    rows = [("s", x[:k] + "G" + x[k:], 1 + k % 3) for k, x in zip(range(0, 57, 2), base, strict=False)] + [("s", x, 2) for x in base]
    rows += [("s", base[0][:-1], 1), ("t", base[0], 1), (None, base[0], 1)]
    every = [r[:2] for r in rows for _ in range(r[2])]
    want = {tuple(r) for r in align.cluster_umis(spark.createDataFrame(every, "sample string, umi string")).collect()}
    asked, write = {}, align.materialize
    monkeypatch.setattr(align, "materialize", lambda df, label: asked.__setitem__(label, write(df, label)) or asked[label])
    got = {tuple(r) for r in align.cluster_umis(spark.createDataFrame(rows, "sample string, umi string, n long")).collect()}
    assert got == want and len(got) == 61
    near = asked["umi-near"]
    assert near.count() >= 29 and near.filter("not plain").isEmpty()
