"""Byte ranges: at every cut point the ranges' records are those of the whole file."""

from __future__ import annotations

import gzip
import io
import random

import numpy as np
import pyarrow as pa
import pytest

from editlake.sources import bam, fastx, ranges


def in_ranges(read, data, kind, cuts):
    """Records of all ranges between ``cuts`` of ``data``."""
    edges = [0, *cuts, len(data)]
    rows = []
    for a, b in zip(edges, edges[1:], strict=False):
        if a < b:
            rows += read(pa.PythonFile(io.BytesIO(data), "r"), ranges.Range("x", kind, a, b, len(data)))
    return rows


def fastx_rows(f, r):
    return [row for arrays in fastx.records(f, r) for row in zip(*(a.to_pylist() for a in arrays), strict=True)]


def fastq_text(r, n, end="\n"):
    """Records that try to look like others: qualities that begin with @ or +, headers within headers, empty sequences."""
    out, rows = [], []
    for k in range(n):
        size = r.choice((0, 1, 3, 9))
        seq, qual = "".join(r.choice("ACGTN") for _ in range(size)), "".join(r.choice("@+>I") for _ in range(size))
        name, comment = f"r{k}@r+{k}", r.choice((None, "@a", "+ >b c"))
        plus = r.choice(("+", f"+{name}"))
        out.append(f"@{name}{' ' + comment if comment else ''}{end}{seq}{end}{plus}{end}{qual}{end}")
        rows.append((name, comment, seq, qual))
    return "".join(out).encode(), rows


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_at_every_cut(end):
    data, rows = fastq_text(random.Random(1), 25, end)
    for text in (data, data.removesuffix(end.encode()), data + b"\n\n"):
        for cut in range(len(text)):
            assert in_ranges(fastx_rows, text, "plain", [cut]) == rows, cut
    for step in (1, 2, 7, 40):
        assert in_ranges(fastx_rows, data, "plain", range(step, len(data), step)) == rows


def test_fastq_with_empty_lines_and_broken_records():
    assert fastx_rows(pa.PythonFile(io.BytesIO(b"\n@a b\nAC\n+\nII\n\n\n@c\nG\n+\nI\n"), "r"), ranges.Range("x", "plain", 0, 29, 29)) == [("a", "b", "AC", "II"), ("c", None, "G", "I")]
    for bad in (b"@a\nAC\n+\nI\n", b"@a\nAC\n+\n", b"@a\nAC\nII\n+\n", b"nothing"):
        with pytest.raises(ValueError):
            fastx_rows(pa.PythonFile(io.BytesIO(bad), "r"), ranges.Range("x", "plain", 0, len(bad), len(bad)))


def test_fasta_at_every_cut():
    r = random.Random(2)
    rows, out = [], []
    for k in range(20):
        lines = ["".join(r.choice("ACGT") for _ in range(r.randrange(9))) for _ in range(r.randrange(4))]
        out.append(f">n{k}{' c>c' if k % 2 else ''}\n" + "".join(f"{x}\n" for x in lines))
        rows.append((f"n{k}", "c>c" if k % 2 else None, "".join(lines), None))
    data = "".join(out).encode()
    for cut in range(len(data)):
        assert in_ranges(fastx_rows, data, "plain", [cut]) == rows, cut
    for step in (1, 2, 5):
        assert in_ranges(fastx_rows, data, "plain", range(step, len(data), step)) == rows


def small_blocks(data, r, most):
    out, at = b"", 0
    while at < len(data):
        n = r.randrange(1, most)
        out += ranges.pack(data[at : at + n])
        at += n
    return out + ranges.LAST_BLOCK


def test_fastq_in_blocks_at_every_cut():
    r = random.Random(3)
    data, rows = fastq_text(r, 40)
    packed = small_blocks(data, r, 60)
    assert gzip.decompress(packed) == data
    for cut in range(0, len(packed), 3):
        assert in_ranges(fastx_rows, packed, "blocks", [cut]) == rows, cut
    assert in_ranges(fastx_rows, packed, "blocks", range(11, len(packed), 11)) == rows


def test_blocks_of_incompressible_bytes():
    data = np.random.default_rng(1).integers(0, 256, 300_000, np.uint8).tobytes()
    f = pa.PythonFile(io.BytesIO(ranges.pack(data) + ranges.LAST_BLOCK), "r")
    assert b"".join(x for _, x in ranges.blocks(f, 0, f.size())) == data


def bam_rows(f, r):
    refs, skip = bam.header(f, r.size)
    out = []
    for data, at in bam.records(f, r, len(refs), skip):
        out += [tuple(x.values()) for x in bam.decode(data, at, refs, "s").to_pylist()]
    return out


def test_bam_at_every_cut():
    r = random.Random(4)
    rows = []
    for k in range(150):
        n = r.choice((0, 1, 7, 40))
        seq = "".join(r.choice(bam.BASES[1:]) for _ in range(n)) or "*"
        qual = "*" if n == 0 or k % 5 == 0 else "".join(chr(33 + r.randrange(94)) for _ in range(n))
        cigar = "".join(f"{r.randrange(1, 200)}{r.choice(bam.OPS)}" for _ in range(r.randrange(5))) or "*"
        rows.append(("s", f"q{k}", r.randrange(4096), r.choice(("*", "chr1", "x")), r.randrange(10**6), r.randrange(256), cigar, seq, qual))
    writer = bam.BamWriter("x", ["chr1", "x"])
    batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows]) for k in range(9)], bam.COLUMNS)
    data = b"".join(writer.contents([batch]))
    for most in (30, 500):
        packed = small_blocks(data, r, most)
        for cut in range(1, len(packed), 41):
            assert in_ranges(bam_rows, packed, "blocks", [cut]) == rows, cut
        step = 1500
        assert in_ranges(bam_rows, packed, "blocks", range(step, len(packed), step)) == rows


def test_tables_of_many_ranges(spark, tmp_path):
    rows = spark.range(3000).selectExpr("concat('r', id) name", "if(id % 2 = 0, 'c d', null) comment", "repeat('ACGTN', int(id % 40)) seq", "repeat('I@+#5', int(id % 40)) qual")
    fastx.write_blocks(rows.repartition(2), f"{tmp_path}/blocks")
    got = fastx.read_fastx(spark, f"{tmp_path}/blocks", 500)
    assert got.rdd.getNumPartitions() > 4
    assert sorted(tuple(x) for x in got.drop("file").collect()) == sorted(tuple(x) for x in rows.collect())
    with gzip.open(tmp_path / "one.fq.gz", "wt") as f:
        f.writelines(f"@{x.name}\n{x.seq}\n+\n{x.qual}\n" for x in rows.collect())
    one = fastx.read_fastx(spark, str(tmp_path / "one.fq.gz"), 10_000)
    assert one.rdd.getNumPartitions() == 1 and one.count() == 3000
    assert sorted(tuple(x) for x in one.collect()) == sorted(tuple(x) for x in fastx.read_whole_files(spark, str(tmp_path / "one.fq.gz")).collect())
    with pytest.raises(Exception, match="nowhere"):
        fastx.read_fastx(spark, str(tmp_path / "nowhere.fq")).count()


def test_bam_primary_only(spark, tmp_path):
    rows = spark.createDataFrame([(f"q{k}", flag, "chr1", k + 1, 60, "4M", "ACGT", "IIII") for k, flag in enumerate((0, 4, 16, 256, 1024, 2048))], "qname string, flag int, ref string, pos long, mapq int, raw_cigar string, seq string, qual string")
    bam.write_bam(rows.repartition(1), f"{tmp_path}/b")
    assert sorted((x.qname, x.pos) for x in bam.read_bam(spark, f"{tmp_path}/b").collect()) == [("q0", 1), ("q2", 3)]
    assert fastx.mapped_counts(bam.read_bam(spark, f"{tmp_path}/b", False)).first()[1:] == (5, 6)
    bam.write_bam(rows.limit(0), f"{tmp_path}/none")
    assert bam.read_bam(spark, f"{tmp_path}/none").count() == 0


def test_small_ranges_share_a_task(tmp_path):
    """As many tasks as are asked for, whatever the ranges' size; none has more than a full range's bytes, and no byte is left out."""
    (tmp_path / "a.fastq").write_bytes(b"@r\nACGT\n+\nIIII\n" * 10_000)
    found = ranges.cut(str(tmp_path), 100)
    groups = ranges.grouped(found, 8)
    assert len(found) == 1500 and 8 <= len(groups) <= 9
    assert [r for g in groups for r in g.ranges] == found
    whole = [ranges.Range("x", "plain", k, k + ranges.SPLIT_BYTES, 0) for k in range(0, 20 * ranges.SPLIT_BYTES, ranges.SPLIT_BYTES)]
    assert [len(g.ranges) for g in ranges.grouped(whole, 4)] == [1] * 20
    assert ranges.grouped([], 4) == []


def test_little_is_unpacked_beyond_a_range(tmp_path, monkeypatch):
    """A range's reader unpacks its own blocks and one or two more, not another piece of them."""
    rng = np.random.default_rng(3)
    bases = ["".join(rng.choice(list("ACGT"), 150)) for _ in range(200)]
    data = "".join(f"@{k}\n{bases[k % 200]}\n+\n{'I' * 150}\n" for k in range(10_000)).encode()
    (tmp_path / "a.fastq.gz").write_bytes(ranges.pack(data) + ranges.LAST_BLOCK)
    unpacked, real = [], ranges.unpack
    monkeypatch.setattr(ranges, "unpack", lambda block: unpacked.append(len(got := real(block))) or got)
    found = ranges.cut(str(tmp_path), 1 << 16)
    names = []
    for r in found:
        with open(r.path, "rb") as g, pa.PythonFile(g) as f:
            names += [n for arrays in fastx.records(f, r) for n in arrays[0].to_pylist()]
    assert names == [str(k) for k in range(10_000)]
    # For each range: the file's first blocks, the one before the range, and the next one or two.
    assert sum(unpacked) <= len(data) + 6 * len(found) * ranges.BLOCK
