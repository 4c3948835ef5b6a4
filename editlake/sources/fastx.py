"""FASTA, FASTQ and SAM readers as tables.

``spark.read.format("fastx").load(path)`` after :func:`register`, or :func:`read_fastx`: files are read in byte ranges, several tasks a file,
whatever its size (see ``ranges``). SAM text is read through Spark itself by :func:`read_sam`.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from . import ranges

#: Alignment flags that aren't primary: unmapped, secondary, duplicate, supplementary.
NOT_PRIMARY = 0x4 | 0x100 | 0x400 | 0x800
COLUMNS = ["file", "name", "comment", "seq", "qual"]
#: Tasks of a read, unless ranges of full size need more; small ranges share a task.
TASKS = 128


class FastxSource(DataSource):
    """Records (file, name, comment, seq, qual) of FASTA and FASTQ files; qual is null in FASTA."""

    @classmethod
    def name(cls) -> str:
        return "fastx"

    def schema(self) -> str:
        return "file string, name string, comment string, seq string, qual string"

    def reader(self, schema) -> DataSourceReader:
        return FastxReader(self.options["path"], int(self.options.get("splitBytes", ranges.SPLIT_BYTES)), int(self.options.get("tasks", TASKS)))

    def writer(self, schema, overwrite: bool) -> FastqWriter:
        return FastqWriter(self.options["path"])


class FastxReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int, tasks: int):
        self.path, self.split_bytes, self.tasks = path, split_bytes, tasks

    def partitions(self) -> list[ranges.Group]:
        return ranges.grouped(ranges.cut(self.path, self.split_bytes), self.tasks)

    def read(self, partition: ranges.Group) -> Iterator[pa.RecordBatch]:
        for r in partition.ranges:
            system, inside = ranges.open_fs(r.path)
            with system.open_input_file(inside) as f:
                for arrays in records(f, r):
                    file = pa.array([r.path.rsplit("/", 1)[-1]] * len(arrays[0]), pa.string())
                    yield pa.RecordBatch.from_arrays([file, *arrays], COLUMNS)


def records(f, r: ranges.Range) -> Iterator[list[pa.Array]]:
    """name, comment, seq and qual of the range's records."""
    _, beginning = ranges.pieces(f, ranges.Range(r.path, r.kind, 0, min(r.size, 1), r.size))
    first = next((x.lstrip()[:1] for x, _ in beginning if x.strip()), b"")
    if first not in (b"", b">", b"@"):
        raise ValueError(f"{r.path} is neither FASTA nor FASTQ")
    before, stream = ranges.pieces(f, r)
    yield from (_fastq if first == b"@" else _fasta)(stream, before, r.path)


def _with_end(stream):
    yield from stream
    yield b"", None


def _fastq(stream, before: bytes | None, path: str) -> Iterator[list[pa.Array]]:
    buf, own, synced = b"", 0, before is None
    for data, mine in _with_end(stream):
        last = mine is None
        own += len(data) * bool(mine)
        buf += data
        if last and buf and not buf.endswith(b"\n"):
            buf += b"\n"
        if not synced:
            at = sync(buf, before == b"\n", last)
            if at is None:
                continue
            buf, own, synced = buf[at:], own - at, True
        arrays, used = parse_fastq(buf, own, path)
        if len(arrays[0]):
            yield arrays
        buf, own = buf[used:], own - used
        if own <= 0 and not mine:
            return
    if own > 0 and buf.strip():
        raise ValueError(f"the last record of {path} isn't whole")


def sync(buf: bytes, at_line: bool, last: bool) -> int | None:
    """Where the first record begins in bytes that may begin anywhere: at a line with an @ in front, two above one with a +, whose
    next line is as long as the one below the +. No other line of a record can look so, as bases are neither. None: more bytes are needed."""
    ends = np.flatnonzero(np.frombuffer(buf, np.uint8) == 10).tolist()
    starts = [0, *(k + 1 for k in ends)]
    size = lambda k: len(buf[starts[k] : ends[k]].rstrip(b"\r"))
    for k in range(0 if at_line else 1, len(ends) - 3):
        if buf[starts[k]] == 64 and buf[starts[k + 2]] == 43 and size(k + 1) == size(k + 3):
            return starts[k]
    return len(buf) if last else None


def parse_fastq(buf: bytes, own: int, path: str) -> tuple[list[pa.Array], int]:
    """name, comment, seq and qual of the whole records of ``buf`` that begin before ``own``, and how many bytes they take."""
    raw = np.frombuffer(buf, np.uint8)
    ends = np.flatnonzero(raw == 10) + 1
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else np.zeros(0, np.int64)
    n = len(ends) // 4
    n = int(np.searchsorted(starts[: 4 * n : 4], own))
    starts, ends = starts[: 4 * n], ends[: 4 * n]
    sizes = ends - starts - 1
    sizes -= (raw[ends - 2] == 13) & (sizes > 0)
    if not ((raw[starts[::4]] == 64).all() and (raw[starts[2::4]] == 43).all() and (sizes[1::4] == sizes[3::4]).all()):
        return _parse_lines(buf, own, path)
    offsets = np.append(starts, ends[-1:] if n else [0]).astype(np.int32)
    lines = pa.StringArray.from_buffers(4 * n, pa.py_buffer(offsets), pa.py_buffer(buf))
    take = lambda k: pc.ascii_rtrim(lines.take(pa.array(np.arange(k, 4 * n, 4))), characters="\r\n")
    return [*_headers(pc.utf8_slice_codeunits(take(0), 1)), take(1), take(3)], int(offsets[-1])


def _parse_lines(buf: bytes, own: int, path: str) -> tuple[list[pa.Array], int]:
    """As :func:`parse_fastq`, line by line: empty lines may stand between records."""
    rows, at, used = [], 0, 0
    while at < own:
        end = buf.find(b"\n", at)
        if end < 0:
            break
        if not buf[at:end].strip():
            at = used = end + 1
            continue
        four = buf[at:].split(b"\n", 4) if len(buf) - at < 1 << 16 else buf[at : at + (1 << 16)].split(b"\n", 4)
        if len(four) < 5:
            four = buf[at:].split(b"\n", 4)
        if len(four) < 5:
            break
        head, seq, plus, qual = (x.rstrip(b"\r").decode() for x in four[:4])
        if head[0] != "@" or plus[:1] != "+" or len(seq) != len(qual):
            raise ValueError(f"{path}: record {head[1:]} isn't one of four lines with as many qualities as bases")
        rows.append((*_header(head[1:]), seq, qual))
        at = used = at + sum(len(x) + 1 for x in four[:4])
    return [pa.array([x[k] for x in rows], pa.string()) for k in range(4)], used


def _headers(text: pa.Array) -> list[pa.Array]:
    if not len(text):
        return [text, text]
    parts = pc.split_pattern(text, " ", max_splits=1)
    name = pc.list_element(parts, 0)
    has = pc.greater(pc.list_value_length(parts), 1)
    second = parts.flatten().take(pc.if_else(has, pc.add(pa.array(np.asarray(parts.offsets)[:-1]), 1), pa.scalar(None, pa.int32())))
    return [name, pc.if_else(pc.equal(second, ""), pa.scalar(None, pa.string()), second)]


def _fasta(stream, before: bytes | None, path: str) -> Iterator[list[pa.Array]]:
    """A record is all from a line with a > to the next one; its lines are joined."""
    buf, own, seen, at = bytearray(), 0, 0, None if before is not None else 0
    rows: list[tuple] = []
    for data, mine in _with_end(stream):
        last = mine is None
        own += len(data) * bool(mine)
        buf += data
        if at is None:
            found = 0 if before == b"\n" and buf[:1] == b">" else buf.find(b"\n>", max(0, seen - 1)) + 1
            if not found and not (before == b"\n" and buf[:1] == b">"):
                seen = len(buf)
                if not mine:
                    return
                continue
            at = seen = found
        while at < own:
            end = buf.find(b"\n>", max(at, seen - 1))
            if end < 0 and not last:
                break
            end = len(buf) if end < 0 else end
            head, _, body = bytes(buf[at:end]).lstrip().partition(b"\n")
            if head:
                rows.append((*_header(head[1:].rstrip(b"\r").decode()), body.translate(None, b"\r\n").decode(), None))
            at = seen = end + 1
        if rows and (len(rows) >= 10_000 or len(buf) >= ranges.PIECE):
            yield [pa.array([x[k] for x in rows], pa.string()) for k in range(4)]
            rows = []
        if at >= own and not mine:
            break
        seen = max(at, len(buf))
        del buf[:at]
        own, seen, at = own - at, seen - at, 0
    if rows:
        yield [pa.array([x[k] for x in rows], pa.string()) for k in range(4)]


class FastqWriter(ranges.BlocksWriter):
    """FASTQ files in blocks; without qualities FASTA."""

    suffix = ".gz"

    def contents(self, batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        text = lambda x: pa.scalar(x, pa.large_string()) if isinstance(x, str) else x
        join = lambda *x: pc.binary_join_element_wise(*map(text, x), text(""))
        for batch in batches:
            name, comment, seq, qual = (batch[c].cast(pa.large_string()) for c in COLUMNS[1:])
            # A null part makes the whole null, and then the other form stands.
            head = pc.coalesce(join(name, " ", comment), name)
            record = pc.coalesce(join("@", head, "\n", seq, "\n+\n", qual, "\n"), join(">", head, "\n", seq, "\n"))
            if record.null_count:
                raise ValueError("a record has no name or no sequence")
            yield "".join(record.to_pylist()).encode()


def read_fastx(spark: SparkSession, path: str, split_bytes: int = ranges.SPLIT_BYTES) -> DataFrame:
    """(file, name, comment, seq, qual) of FASTA and FASTQ files, in ranges of about ``split_bytes``."""
    register(spark)
    return spark.read.format("fastx").option("splitBytes", split_bytes).load(path)


def write_blocks(df: DataFrame, path: str) -> None:
    """``df`` (name, comment, seq, qual) as block-compressed files in a folder, one a partition, which can be read in ranges again."""
    register(df.sparkSession)
    df.select(F.lit("").alias("file"), *COLUMNS[1:]).write.format("fastx").mode("append").save(path)


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_fastx`, for stores that only Spark can read: files that end in .gz are unpacked, and a file is one task's work and
    at most 2 GB."""

    def run(batches):
        for batch in batches:
            rows = []
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = content.as_buffer()
                lines = gzip.open(io.BytesIO(raw), "rt") if file.endswith(".gz") else io.TextIOWrapper(io.BytesIO(raw))
                for record in parse_fastx(lines):
                    rows.append((file.rsplit("/", 1)[-1], *record))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, FastxSource.schema(None))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["file", "name", "comment", "seq", "qual"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(5)], names)


def parse_fastx(lines) -> Iterator[tuple[str, str | None, str, str | None]]:
    """(name, comment, seq, qual) of each record; FASTA sequences may be folded, empty lines are skipped."""
    name, parts = None, []
    lines = (line.rstrip("\r\n") for line in lines)
    for line in lines:
        if line.startswith(">") or line.startswith("@") and name is None:
            if name is not None:
                yield (*_header(name), "".join(parts), None)
            name, parts = line[1:], []
            if line.startswith("@"):
                seq, _, qual = next(lines, ""), next(lines, ""), next(lines, "")
                if len(seq) != len(qual):
                    raise ValueError(f"record {name}: sequence and quality differ in length")
                yield (*_header(name), seq, qual)
                name = None
        elif line and name is not None:
            parts.append(line)
    if name is not None:
        yield (*_header(name), "".join(parts), None)


def _header(text: str) -> tuple[str, str | None]:
    name, _, comment = text.partition(" ")
    return name, comment or None


def register(spark: SparkSession) -> None:
    """Make the data source known to the session."""
    spark.dataSource.register(FastxSource)


def _stem(name: Column, ending: str) -> Column:
    """A file's name without ``.gz`` and then ``ending``, of which at least one character stays; by comparison, as it is asked for in every row."""
    for x in (".gz", ending):
        cut = F.left(name, F.length(name) - len(x))
        name = F.when(name.endswith(x) & (F.length(name) > len(x)), cut).otherwise(name)
    return name


def read_sam(spark: SparkSession, path: str, primary_only: bool = True) -> DataFrame:
    """(sample, qname, flag, pos, mapq, raw_cigar, seq, qual) of SAM text; the sample is the file's name."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("@"))
    f = F.split("value", "\t")
    rows = lines.select(
        _stem(F.substring_index(F.input_file_name(), "/", -1), ".sam").alias("sample"),
        F.get(f, F.lit(0)).alias("qname"), F.get(f, F.lit(1)).cast("int").alias("flag"), F.get(f, F.lit(3)).cast("bigint").alias("pos"),
        F.get(f, F.lit(4)).cast("int").alias("mapq"), F.get(f, F.lit(5)).alias("raw_cigar"), F.get(f, F.lit(9)).alias("seq"), F.get(f, F.lit(10)).alias("qual"),
    )
    return rows.filter(F.col("flag").bitwiseAND(F.lit(NOT_PRIMARY)) == 0) if primary_only else rows


def mapped_counts(alignments: DataFrame) -> DataFrame:
    """(sample, mapped, total) over all records, primary or not."""
    return alignments.groupBy("sample").agg(F.count_if(F.col("flag").bitwiseAND(F.lit(4)) == 0).alias("mapped"), F.count(F.lit(1)).alias("total"))


def to_fasta(df: DataFrame, name: str, seq: str) -> DataFrame:
    """One text column, a record a row; write it with ``df.write.text``."""
    return df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq)).alias("value"))


def to_fastq(df: DataFrame, name: str, seq: str, qual: str | None = None, fill: str = "#") -> DataFrame:
    """Like :func:`to_fasta`; without a quality column every base gets ``fill``."""
    quality = F.col(qual) if qual else F.repeat(F.lit(fill), F.length(seq))
    return df.select(F.concat(F.lit("@"), F.col(name), F.lit("\n"), F.col(seq), F.lit("\n+\n"), quality).alias("value"))


__all__ = ["FastxSource", "mapped_counts", "parse_fastx", "read_fastx", "read_sam", "read_whole_files", "register", "to_fasta", "to_fastq", "write_blocks"]
