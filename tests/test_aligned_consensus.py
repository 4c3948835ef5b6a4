"""Members are laid over their centre by pair, dealt out evenly, equal ones once a batch."""

from editlake.operators import align


def test_members_are_laid_by_pair(spark):
    rows = [("a", "x", "ACGTTGCA", "ACGTGCA"), ("a", "x", "ACGTGCA", "ACGTGCA"), ("a", "x", "ACTGCA", "ACGTGCA"), ("a", "x", None, "ACGTGCA"), ("b", "y", "", ""), ("b", "y", "AC", None)]
    members = spark.createDataFrame(rows * 30, "sample string, cluster string, seq string, centre string")
    made = align.project(members, "seq", "centre")
    assert "EvalPython" not in made._jdf.queryExecution().executedPlan().toString()
    got = made.collect()
    assert made.columns == [*members.columns, "projected"] and len(got) == 180
    assert {(r.seq, r.centre): r.projected for r in got} == {
        ("ACGTTGCA", "ACGTGCA"): "ACGTGCA", ("ACGTGCA", "ACGTGCA"): "ACGTGCA", ("ACTGCA", "ACGTGCA"): "AC-TGCA", (None, "ACGTGCA"): None, ("", ""): None, ("AC", None): None,
    }
