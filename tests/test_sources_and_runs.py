"""Readers, writers, parameters, alignment, streaming and whole runs."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from editlake.operators import align, channels, models
from editlake.params import Params, validate
from editlake.plans import runs
from editlake.sources import fastx, tables
from editlake.streaming import landing


def test_fastx(spark, tmp_path):
    with gzip.open(tmp_path / "a.fq.gz", "wt") as f:
        f.write("@r1 left\nACGT\n+\nIIII\n@r2\nGG\n+\n@@\n")
    (tmp_path / "b.fa").write_text(">x y z\nAC\nGT\n\n>e\n")
    fastx.register(spark)
    got = sorted(tuple(r) for r in spark.read.format("fastx").load(str(tmp_path)).collect())
    assert got == [("a.fq.gz", "r1", "left", "ACGT", "IIII"), ("a.fq.gz", "r2", None, "GG", "@@"), ("b.fa", "e", None, "", None), ("b.fa", "x", "y z", "ACGT", None)]


def test_sam_primary_only(spark, tmp_path):
    line = lambda name, flag: f"{name}\t{flag}\tref\t3\t60\t5S4M\t*\t0\t0\tACGTACGTA\tIIIIIIIII\n"
    (tmp_path / "s1.sam").write_text("@HD\tVN:1.6\n" + line("a", 0) + line("b", 256) + line("c", 4) + line("d", 16))
    rows = fastx.read_sam(spark, str(tmp_path / "s1.sam"))
    assert sorted((r.sample, r.qname, r.pos, r.raw_cigar) for r in rows.collect()) == [("s1", "a", 3, "5S4M"), ("s1", "d", 3, "5S4M")]
    assert tuple(fastx.mapped_counts(fastx.read_sam(spark, str(tmp_path / "s1.sam"), False)).first()) == ("s1", 3, 4)


def test_tables(spark, tmp_path):
    (tmp_path / "counts.tsv").write_text("sgRNA\tGene\tA\tB\ng1\tX\t3\t\ng2\t\t1\t2\n")
    got = sorted(tuple(r) for r in tables.read_counts(spark, str(tmp_path / "counts.tsv")).collect())
    assert got == [("g1", "X", "A", 3.0), ("g1", "X", "B", 0.0), ("g2", "NO_GENE_NAME", "A", 1.0), ("g2", "NO_GENE_NAME", "B", 2.0)]
    (tmp_path / "fc.tsv").write_text("REAGENT_ID\tGENE\ts\ng1\tX\t0.5\ng1\tX\t0.7\n")
    with pytest.raises(ValueError, match="unique"):
        tables.read_fold_changes(spark, str(tmp_path / "fc.tsv"))
    (tmp_path / "c.csv").write_text("reference;treatment\nA,B;C\n")
    assert tables.read_contrasts(spark, str(tmp_path / "c.csv")).first() == ("C_vs_A_B", ["A", "B"], ["C"])
    (tmp_path / "ess.txt").write_text("GENE\tx\nA\t1\nB\t2\n")
    assert sorted(r.gene for r in tables.read_gene_set(spark, str(tmp_path / "ess.txt")).collect()) == ["A", "B"]
    assert tables.read_gene_set(spark, str(tmp_path / "ess.txt"), header=False).count() == 3
    (tmp_path / "al.tsv").write_text("g1\tc1,c2\tX\t\t\n")
    assert tuple(tables.read_align_info(spark, str(tmp_path / "al.tsv")).first()) == ("g1", 2, 0)
    (tmp_path / "sheet.csv").write_text("sample,fastq_1\na b,x.fq\n")
    with pytest.raises(ValueError, match="blanks"):
        tables.read_samplesheet(spark, str(tmp_path / "sheet.csv"))


def test_upsert(spark):
    old = spark.createDataFrame([("s", "raw", 5, 100.0), ("s", "aligned", 1, 20.0)], "sample string, stage string, n long, pct double")
    new = spark.createDataFrame([("s", "aligned", 4, 80.0)], old.schema)
    assert sorted((r.stage, r.n) for r in tables.upsert_stage(old, new).collect()) == [("aligned", 4), ("raw", 5)]


def test_rules():
    validate(Params())
    with pytest.raises(ValueError, match="contrasts"):
        validate(Params(analysis="screening", count_table="x", drugz=True))
    with pytest.raises(ValueError, match="library"):
        validate(Params(analysis="screening", input="x"))
    assert validate(Params(analysis="screening", count_table="x", mle=True, contrasts="c", mle_design_matrix="d"))


def test_alignment_modes():
    s = align.Scores(1, -1, 2, 1)
    assert align.align_batch(["ACGT"], ["TTACGTTT"], "global-local", s) == [(4.0, 3, 6, "4M")]
    assert align.align_batch(["ACGTTTACGT"], ["ACGTACGT"], "global", s)[0][3] in ("4M2I4M", "3M2I5M")
    assert align.align_batch(["GGACGTGG"], ["TTACGTTT"], "local", s) == [(4.0, 3, 6, "2S4M2S")]
    assert align.align_batch(["ACGTACGTAC"], ["ACGTAGGGCGTAC"], "global", align.Scores(5, -4, 3, 1))[0][3] in ("5M3D5M", "4M3D6M")
    edits = align.PROFILES["edits"]
    assert [r[0] for r in align.align_batch(["ACNT", "AAAA"], ["GGACTTGG", "GGACTTGG"], "global-local", edits)] == [0.0, -3.0]


def test_merge_and_umis(spark):
    whole = "ACGTTGCAATGCCGATTACGGATCCTTAAGGCATCGATTGCC"
    swap = str.maketrans("ACGT", "TGCA")
    second = whole[15:].translate(swap)[::-1]
    df = spark.createDataFrame([(whole[:30], "I" * 30, second, "I" * len(second)), ("A" * 30, "I" * 30, "A" * 30, "I" * 30)], "seq1 string, qual1 string, seq2 string, qual2 string")
    assert [r.merged for r in align.merge_pairs(df).collect()] == [whole, None]
    umis = spark.createDataFrame([("s", "A" * 100)] * 3 + [("s", "A" * 99 + "C")] + [("s", "C" * 100)], "sample string, umi string")
    got = {r.umi[-1]: r.cluster[0] for r in align.cluster_umis(umis, 0.99, 90, 110).collect() if r.umi[0] == "A"}
    assert got == {"A": "A", "C": "A"}


def test_consensus_outvotes_errors(spark):
    rows = spark.createDataFrame([("s", "c", "ACGT"), ("s", "c", "ACGT"), ("s", "c", "AGT")], "sample string, cluster string, seq string").withColumn("centre", F.lit("ACGT"))
    assert align.consensus(align.project(rows, "seq", "centre")).first().consensus == "ACGT"


def test_segments_are_centred(spark):
    rows = [(f"g{i:03}", f"G{i}", "chr1", i, (2.0 if 40 <= i < 60 else 0.0) + 0.01 * (i % 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "guide string, gene string, chrom string, pos bigint, fc double")
    got = {r.pos: r.corrected for r in models.copy_number_correction(df).collect()}
    assert all(abs(x) < 0.05 for x in got.values())


def test_regression_finds_the_effect(spark):
    rows = [(g, f"{g}{k}", s, int(100 * (k + 1) * (4 if g == "hit" and s == "t" else 1))) for g in ("hit", "none") for k in range(3) for s in ("c", "t")]
    counts = spark.createDataFrame(rows, "gene string, guide string, sample string, count bigint")
    sizes = spark.createDataFrame([("c", 1.0), ("t", 1.0)], "sample string, size_factor double")
    got = {r.gene: r.beta for r in models.mle(counts, {"c": [1, 0], "t": [1, 1]}, sizes).collect()}
    assert abs(got["hit"] - 2) < 0.05 and abs(got["none"]) < 0.05


def test_grouping_waits_for_whole_groups(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "k string, o int, v string")
    got = channels.group_tuple(df, ["k"], "o", 2).first()
    assert (got.k, got.o, got.v) == ("a", [1, 2], ["x", "y"])


def test_stream_counts(spark, tmp_path):
    lib = spark.createDataFrame([("g", "X", "ACG")], "guide string, gene string, sequence string")
    spark.createDataFrame([("s", 1, "TACG", "IIII"), ("s", 2, "TTTT", "IIII")], landing.READS).write.parquet(str(tmp_path / "in"))
    query = landing.start(landing.running_counts(landing.read_landing(spark, str(tmp_path / "in")), lib, 1, 3), "seen", str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    assert [tuple(r) for r in spark.table("seen").collect()] == [("g", "X", "s", 1)]


def test_whole_runs(spark, tmp_path):
    from editlake.plans import bindings, screening

    folder = "/root/testdata/sf0.001"
    p = Params(analysis="screening", count_table="x", contrasts="c", drugz=True)
    out = runs.screen(p, screening.counts(spark, folder), [(["AF"], ["RF"])])
    assert set(out) == {"count_summary", "size_factors", "drugz_0"}
    runs.publish({"count_summary": out["count_summary"]}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/count_summary").count() == 6
    refs = spark.createDataFrame([("src0", bindings.AMPLICON)], "sample string, reference string")
    rows = runs.align_amplicons(Params(), bindings.reads(spark, folder).limit(20), refs)
    assert rows.columns == ["sample", "qname", "pos", "mapq", "raw_cigar", "seq", "qual"]
