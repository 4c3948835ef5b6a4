"""Alignments by diagonals: the results of whole rows, letter by letter, for less work."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from editlake.operators import align
from editlake.plans.bindings import AMPLICON

SCORES = [*align.PROFILES.values(), align.Scores(1, -1, 10, 4), align.Scores(8, -6, 8, 1), align.Scores(2, -3, 1, 1), align.Scores(3000, -17, 25, 2)]


def by_rows(queries, subjects, mode, s):
    m, n = (np.array([len(t) for t in texts], int) for texts in (queries, subjects))
    return align._fill_whole(align._codes(queries, int(m.max())), align._codes(subjects, int(n.max())), m, n, mode, s)


@pytest.mark.parametrize("mode", ["local", "global", "global-local"])
def test_diagonals_give_what_rows_give(mode):
    rng, used = random.Random(4), set()
    text = lambda n, letters: "".join(rng.choices(letters, k=n))
    for k in range(48):
        letters, longest, s = rng.choice(["ACGT", "AC", "ACGTNRYacgt-"]), rng.choice([3, 12, 60]), SCORES[k % len(SCORES)]
        x = [text(rng.randint(1, longest), letters) for _ in range(rng.choice([1, 7, 600]))]
        y = [t[: len(t) // 2] + text(rng.randint(0, 4), letters) + t[len(t) // 2 :] if rng.random() < 0.5 else text(rng.randint(1, longest), letters) for t in x]
        used.add(align._diagonal_kind(max(map(len, x)), max(map(len, y)), s))
        assert align.align_batch(x, y, mode, s) == by_rows(x, y, mode, s)
    assert used == {np.int16, np.int32}


def test_costs_that_diagonals_are_not_for():
    for s in (align.Scores(1.5, -1, 2, 1), align.Scores(1, -9, 2, 1), align.Scores(1, 0, 2, 1)):
        assert align._diagonal_kind(20, 20, s) is None
        assert align.align_batch(["ACGTTT", "GG"], ["ACTT", "CAGT"], "local", s) == by_rows(["ACGTTT", "GG"], ["ACTT", "CAGT"], "local", s)


def test_reads_take_less_than_half_the_work_of_rows():
    rng = random.Random(5)
    reads, subject, s = ["".join(rng.choices("ACGT", k=150)) for _ in range(512)], [AMPLICON] * 512, align.PROFILES["minimap2"]
    spent = []
    for run in (align.align_batch, align.align_batch, lambda *a: [by_rows(reads[k : k + 64], subject[k : k + 64], "local", s) for k in range(0, 512, 64)]):
        began = time.process_time()
        run(reads, subject, "local", s)
        spent.append(time.process_time() - began)
    assert spent[1] < spent[2] / 2


def test_pairs_are_aligned_once_a_batch(spark):
    rows = spark.createDataFrame([(k, "ACGTACGT"[k % 3 :] if k % 7 else None) for k in range(40)], "k int, a string")
    rows = rows.withColumn("b", F.lit("TTACGTACGTTT"))
    seen = align.by_pair(rows, "a", "b", lambda a, b: [(len(a),)] * len(a), "n int").collect()
    assert {r.k for r in seen} == set(range(40)) and max(r.n for r in seen) <= 4
    done = align.align_pairs(rows, "a", "b")
    assert "EvalPython" not in done._jdf.queryExecution().executedPlan().toString()
    made = {r.k: r[3:] for r in done.collect()}
    want = align.align_batch(["ACGTACGT"[k:] for k in range(3)], ["TTACGTACGTTT"] * 3, "global-local", align.Scores())
    assert made == {k: want[k % 3] for k in range(40) if k % 7}
