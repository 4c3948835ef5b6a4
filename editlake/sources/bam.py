"""BAM files as tables: read in byte ranges, written one file a task.

``spark.read.format("bam").load(path)`` after :func:`register`, or :func:`read_bam`. A task finds the first record of its range by looking for
a place from which several records follow one another, each with plausible fields; see ``ranges`` for which records are its own.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from . import ranges

COLUMNS = ["sample", "qname", "flag", "ref", "pos", "mapq", "raw_cigar", "seq", "qual"]
SCHEMA = "sample string, qname string, flag int, ref string, pos bigint, mapq int, raw_cigar string, seq string, qual string"
#: The format's codes of bases and of operations.
BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
#: A record's fixed fields, its own size first.
FIXED = np.dtype(
    [("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"),
     ("seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")]
)
#: So many records have to follow one another, if the file has that many.
CHAIN = 6
_PAIRS = np.frombuffer("".join(a + b for a in BASES for b in BASES).encode(), np.uint8).reshape(256, 2)
_NAME = re.compile(rb"[!-?A-~]+\x00")


class BamSource(DataSource):
    """Records of BAM files; the sample is the file's name, pos counts from 1, and what the format leaves out is ``*``."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BamReader(self.options["path"], int(self.options.get("splitBytes", ranges.SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(self.options["path"], json.loads(self.options["refs"]))


class BamReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def partitions(self) -> list[ranges.Range]:
        return ranges.cut(self.path, self.split_bytes)

    def read(self, partition: ranges.Range) -> Iterator[pa.RecordBatch]:
        if partition.kind != "blocks":
            raise ValueError(f"{partition.path} isn't block-compressed")
        system, inside = ranges.open_fs(partition.path)
        sample = re.sub(r"\.bam$", "", partition.path.rsplit("/", 1)[-1])
        with system.open_input_file(inside) as f:
            refs, skip = header(f, partition.size)
            for data, at in records(f, partition, len(refs), skip):
                yield decode(data, at, refs, sample)


def header(f, size: int) -> tuple[list[str], int]:
    """The names of the references, and how many unpacked bytes the header takes."""
    data = b""
    for _, block in ranges.blocks(f, 0, size):
        data += block
        try:
            if data[:4] != b"BAM\1":
                raise ValueError("this is no BAM file")
            (n,) = struct.unpack_from("<i", data, 4)
            at = 8 + n
            (n,) = struct.unpack_from("<i", data, at)
            at, refs = at + 4, []
            for _ in range(n):
                (size_of_name,) = struct.unpack_from("<i", data, at)
                struct.unpack_from("<i", data, at + 4 + size_of_name)
                refs.append(data[at + 4 : at + 3 + size_of_name].decode())
                at += 8 + size_of_name
            return refs, at
        except struct.error:
            continue
    raise ValueError("the header isn't whole")


def plausible(data: bytes, at: int, refs: int) -> int:
    """Where the record at ``at`` ends if its fields can be a record's; 0 if they can't, -1 if the bytes end before that shows."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, name, _, _, ops, _, seq, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < refs and -1 <= next_ref < refs and pos >= -1 and next_pos >= -1 and name >= 1 and seq >= 0):
        return 0
    if size < 32 + name + 4 * ops + (seq + 1) // 2 + seq:
        return 0
    if at + 36 + name + 4 * ops > len(data):
        return -1
    if not _NAME.fullmatch(data, at + 36, at + 36 + name):
        return 0
    if any(x & 15 > 8 for x in struct.unpack_from(f"<{ops}I", data, at + 36 + name)):
        return 0
    return at + 4 + size


def sync(data: bytes, refs: int, last: bool) -> int | None:
    """The first place from which records follow one another; None if more bytes are needed. At a file's ``last`` bytes a chain
    may be shorter if it ends with them."""
    for at in range(len(data) - 35):
        end, n = at, 0
        while n < CHAIN:
            after = plausible(data, end, refs)
            if after == 0:
                break
            if after < 0 or after > len(data):
                if not last:
                    return None
                n = CHAIN if end == len(data) and n else 0
                break
            end, n = after, n + 1
        if n == CHAIN:
            return at
    return len(data) if last else None


def records(f, r: ranges.Range, refs: int, skip: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """Bytes and where the range's records begin in them."""
    _, stream = ranges.pieces(f, r)
    buf, own, synced = b"", 0, r.start == 0
    left = skip if synced else 0
    for data, mine in _with_end(stream):
        last = data is None
        if not last:
            own += len(data) * mine
            buf += data
        if left:
            k = min(left, len(buf))
            buf, own, left = buf[k:], own - k, left - k
        if not synced:
            at = sync(buf, refs, last)
            if at is None:
                continue
            buf, own, synced = buf[at:], own - at, True
        at, starts = 0, []
        while at < own and at + 4 <= len(buf):
            end = at + 4 + int.from_bytes(buf[at : at + 4], "little")
            if end > len(buf):
                break
            starts.append(at)
            at = end
        if starts:
            yield buf[:at], np.array(starts)
        buf, own = buf[at:], own - at
        if own <= 0 and (last or not mine):
            return
    if own > 0:
        raise ValueError(f"the last record of {r.path} isn't whole")


def _with_end(stream):
    yield from stream
    yield None, False


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... sizes[k] of them, for each k."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(int(sizes.sum()))


def _strings(data: np.ndarray, sizes: np.ndarray, star: np.ndarray) -> pa.Array:
    """Texts one after the other in ``data``, but ``*`` where ``star``."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    return pc.if_else(pa.array(star), pa.scalar("*"), texts) if star.any() else texts


def decode(data: bytes, at: np.ndarray, refs: list[str], sample: str) -> pa.RecordBatch:
    raw = np.frombuffer(data, np.uint8)
    fixed = np.ascontiguousarray(raw[at[:, None] + np.arange(36)]).view(FIXED).ravel()
    name, ops, seq = (fixed[k].astype(np.int64) for k in ("name", "ops", "seq"))
    names_at = at + 36
    cigars_at, seqs_at = names_at + name, names_at + name + 4 * ops
    packed = (seq + 1) // 2
    bases = _PAIRS[raw[_ragged(seqs_at, packed)]].reshape(-1)
    bases = bases[_ragged(2 * (np.cumsum(packed) - packed), seq)]
    quals = raw[_ragged(seqs_at + packed, seq)]
    first = np.cumsum(seq) - seq
    no_qual = (seq == 0) | (quals[np.minimum(first, max(0, len(quals) - 1))] == 255 if len(quals) else True)
    codes = np.ascontiguousarray(raw[_ragged(cigars_at, 4 * ops)]).view("<u4")
    text = [f"{c >> 4}{OPS[c & 15]}" for c in codes.tolist()]
    ends = np.cumsum(ops).tolist()
    cigars = ["".join(text[a:b]) or "*" for a, b in zip([0, *ends], ends, strict=False)]
    n = len(at)
    arrays = [
        pa.array([sample] * n),
        _strings(raw[_ragged(names_at, name - 1)], name - 1, np.zeros(n, bool)),
        pa.array(fixed["flag"].astype(np.int32)),
        pa.array([refs[k] if k >= 0 else "*" for k in fixed["ref"].tolist()], pa.string()),
        pa.array(fixed["pos"].astype(np.int64) + 1),
        pa.array(fixed["mapq"].astype(np.int32)),
        pa.array(cigars, pa.string()),
        _strings(bases, seq, seq == 0),
        _strings(np.where(quals == 255, 33, quals + 33).astype(np.uint8), seq, no_qual),
    ]
    return pa.RecordBatch.from_arrays(arrays, COLUMNS)


_CODE = {c: k for k, c in enumerate(BASES)}
_OP = re.compile(r"([0-9]+)([MIDNSHP=X])")


def encode(qname: str, flag: int, ref: int, pos: int, mapq: int, cigar: str, seq: str, qual: str) -> bytes:
    """One record. Bases that the format has no code for become N; the field for index bins is left 0."""
    ops = [] if cigar in ("", "*") else [int(n) << 4 | OPS.index(op) for n, op in _OP.findall(cigar)]
    bases = "" if seq == "*" else seq.upper()
    codes = [_CODE.get(c, 15) for c in bases] + [0] * (len(bases) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    quals = b"\xff" * len(bases) if qual in ("", "*") else bytes(ord(c) - 33 for c in qual)
    name = (qname or "*").encode() + b"\0"
    fixed = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name), mapq, 0, len(ops), flag, len(bases), -1, -1, 0)
    body = fixed + name + struct.pack(f"<{len(ops)}I", *ops) + packed + quals
    return struct.pack("<i", len(body)) + body


class BamWriter(ranges.BlocksWriter):
    suffix = ".bam"

    def __init__(self, path: str, refs: list[str]):
        super().__init__(path)
        self.refs = refs

    def contents(self, batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        names = b"".join(struct.pack("<i", len(r.encode()) + 1) + r.encode() + b"\0" + struct.pack("<i", 1 << 29) for r in self.refs)
        yield b"BAM\1" + struct.pack("<ii", 0, len(self.refs)) + names
        number = {r: k for k, r in enumerate(self.refs)}
        for batch in batches:
            for qname, flag, ref, pos, mapq, cigar, seq, qual in zip(*(batch[c].to_pylist() for c in COLUMNS[1:]), strict=True):
                yield encode(qname, flag, number.get(ref, -1), pos, mapq, cigar, seq, qual)


def register(spark: SparkSession) -> None:
    """Make the data source known to the session."""
    spark.dataSource.register(BamSource)


def read_bam(spark: SparkSession, path: str, primary_only: bool = True, split_bytes: int = ranges.SPLIT_BYTES) -> DataFrame:
    """The columns of SCHEMA; those of SAM text too."""
    from .fastx import NOT_PRIMARY

    register(spark)
    rows = spark.read.format("bam").option("splitBytes", split_bytes).load(path)
    return rows.filter(F.col("flag").bitwiseAND(F.lit(NOT_PRIMARY)) == 0) if primary_only else rows


def write_bam(df: DataFrame, path: str) -> None:
    """``df`` with the columns of SCHEMA (the sample aside) as BAM files in a folder, one a partition. The names of the references, some
    thousands at most, go into every file's header."""
    register(df.sparkSession)
    refs = sorted(r.ref for r in df.select("ref").distinct().collect() if r.ref not in (None, "*"))
    rows = df.select(F.lit("").alias("sample"), *COLUMNS[1:])
    rows.write.format("bam").option("refs", json.dumps(refs)).mode("append").save(path)
