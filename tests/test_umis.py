"""Strands and statistics of UMI extraction."""

from __future__ import annotations

from editlake.operators import align

DESIGN = align.UmiDesign("GATTACAGATCCGA", "CCTTGGAACGTCAT", "RYRYRY", "YRYRYR", adapter_length=40, max_error=1)


def sought(spark, texts, strands="intended"):
    rows = spark.createDataFrame([("s", k, t) for k, t in enumerate(texts)], "sample string, read_id long, seq string")
    return {r.read_id: r.strand for r in align.seek_umis(rows, DESIGN, strands).collect()}


def test_a_far_context_is_not_there(spark):
    front, rest = "GTGTGT" + "A" * 4, "T" * 40
    fwd, rev = DESIGN.fwd_context, DESIGN.rev_context
    texts = [front + fwd + rest, front + rev + rest, front + fwd[:4] + rest, "T" * 60, front + fwd[:10] + rest, "short", None]
    assert sought(spark, texts) == {0: "+", 1: "-", 2: "-", 3: "-", 4: "+"}
    # As written, what is not there is nearest, so a context alone has the other one's strand.
    assert sought(spark, texts, "as_written") == {0: "-", 1: "+", 2: "-", 3: "-", 4: "-"}


def test_report(spark):
    good = "GTGTGT" + DESIGN.fwd_context + "G" * 40 + "CACACA"
    turned = "GTGTGT" + DESIGN.rev_context + "G" * 40 + "CACACA"
    bare = "G" * 60
    rows = [("a", good)] * 5 + [("a", turned)] * 2 + [("a", bare)] + [("a", "ACGT")] * 2 + [("b", None)] + [("c", good)] * 3
    rows = spark.createDataFrame([(s, k, t) for k, (s, t) in enumerate(rows)], "sample string, read_id long, seq string")
    got = {r.sample: tuple(r)[1:] for r in align.extraction_report(rows, DESIGN).collect()}
    assert got == {"a": (10, 5, 3, 5 / 3, 7, 70.0), "b": (1, 0, 0, -1.0, 0, 0.0), "c": (3, 3, 0, -1.0, 3, 100.0)}
    assert align.extraction_report(rows.limit(0), DESIGN).count() == 0
