"""The rank aggregation's query makes its counts once."""

from editlake.plans import modelled


def test_rra_reads_counts_that_are_made(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(modelled.models, "rra", lambda counts, *_: seen.append(counts) or counts)
    modelled.rra(spark, "/root/testdata/sf0.001")
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    key = ["guide", "sample", "count"]
    assert sorted(map(tuple, seen[0].select(key).collect())) == sorted(map(tuple, modelled.counts(spark, "/root/testdata/sf0.001").select(key).collect()))
