"""Files as byte ranges that tasks read on their own, plain or block-compressed.

A task has the bytes from ``start`` to ``end`` of a file. The records whose first byte lies there are its own; it finds the first of them by
itself and reads beyond its end to finish the last. A block-compressed file (gzip members of at most 64 KB that tell their size) is
cut between blocks, and a record belongs to the task that has the block of its first byte. Other gzip files can't be cut: one task
unpacks such a file as a stream.

Files are opened by pyarrow, so local and mounted folders, HDFS and object stores will do.
"""

from __future__ import annotations

import fnmatch
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSourceArrowWriter, InputPartition, WriterCommitMessage

SPLIT_BYTES = 64 << 20
#: Bytes that a task reads at once; bytes of a block at most, packed or not.
PIECE, BLOCK = 1 << 20, 1 << 16
#: How a block begins, but for six bytes that may be anything, and the empty block at a file's end.
HEAD, EXTRA = b"\x1f\x8b\x08\x04", b"\x06\x00BC\x02\x00"
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


@dataclass
class Range(InputPartition):
    """Bytes of a file that one task reads; kind is plain, gzip or blocks."""

    path: str
    kind: str
    start: int
    end: int
    size: int


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))


def find_files(paths: str) -> list[tuple[str, int]]:
    """(path, size) of files: ``paths`` are files, folders or patterns of names, with commas between. Names that begin with a dot
    or an underscore are left out."""
    out = []
    for path in paths.split(","):
        system, inside = open_fs(path)
        info = system.get_file_info(inside)
        base, name = inside.rsplit("/", 1)
        if info.type == fs.FileType.File:
            found = [info]
        elif info.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(inside))
        else:
            found = [x for x in system.get_file_info(fs.FileSelector(base, allow_not_found=True)) if fnmatch.fnmatchcase(x.base_name, name)]
            if not found:
                raise FileNotFoundError(path)
        prefix = path[: path.index("://") + 3] if "://" in path else ""
        out += [(prefix + x.path, x.size) for x in found if x.type == fs.FileType.File and x.base_name[0] not in "._"]
    return sorted(out)


def cut(paths: str, split_bytes: int = SPLIT_BYTES) -> list[Range]:
    """The ranges of all files, of about ``split_bytes`` each."""
    out = []
    for path, size in find_files(paths):
        packed = path.endswith((".gz", ".bgz", ".bam"))
        kind = "plain"
        if packed:
            system, inside = open_fs(path)
            with system.open_input_file(inside) as f:
                kind = "blocks" if block_size(f.read_at(18, 0)) else "gzip"
        step = size if kind == "gzip" else split_bytes
        out += [Range(path, kind, a, min(a + step, size), size) for a in range(0, size, max(1, step))]
    return out


@dataclass
class Group(InputPartition):
    """Ranges that one task reads, one after the other."""

    ranges: list[Range]


def grouped(found: list[Range], tasks: int) -> list[Group]:
    """``found`` in order, some neighbours to a task: more tasks than ``tasks`` only where one would have more than ``SPLIT_BYTES``."""
    most = min(SPLIT_BYTES, sum(r.end - r.start for r in found) // max(1, tasks))
    out, size = [], 0
    for r in found:
        if not out or size + r.end - r.start > most:
            out.append(Group([]))
            size = 0
        out[-1].ranges.append(r)
        size += r.end - r.start
    return out


def block_size(head: bytes, at: int = 0) -> int:
    """Bytes of the packed block that begins at ``at``; 0 if none does."""
    if head[at : at + 4] != HEAD or head[at + 10 : at + 16] != EXTRA or len(head) < at + 18:
        return 0
    return struct.unpack_from("<H", head, at + 16)[0] + 1


def _chained(f, at: int, size: int) -> bool:
    """Whether a block begins at ``at``: it ends where another begins, or the file does."""
    own = block_size(f.read_at(18, at))
    return bool(own) and (at + own == size or at + own < size and block_size(f.read_at(18, at + own)) > 0)


def first_block(f, start: int, size: int) -> int:
    """Where the first block at ``start`` or later begins; the size if none does."""
    at = start
    while at < size:
        window = f.read_at(2 * BLOCK, at)
        k = window.find(HEAD)
        while k >= 0:
            if _chained(f, at + k, size):
                return at + k
            k = window.find(HEAD, k + 1)
        at += max(1, len(window) - len(HEAD) + 1)
    return size


def unpack(block: bytes) -> bytes:
    data = zlib.decompress(block[18:-8], wbits=-15)
    crc, n = struct.unpack("<II", block[-8:])
    if n != len(data) or crc != zlib.crc32(data):
        raise ValueError("a block's checksum is wrong")
    return data


def pack(data: bytes, level: int = 6) -> bytes:
    """``data`` in blocks, without the empty one at the end."""
    out = []
    for a in range(0, len(data), 0xFF00):
        part = data[a : a + 0xFF00]
        for how in (level, 0):
            z = zlib.compressobj(how, zlib.DEFLATED, -15)
            body = z.compress(part) + z.flush()
            if len(body) + 26 <= BLOCK:
                break
        out.append(HEAD + b"\0\0\0\0\0\xff" + EXTRA + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return b"".join(out)


def _byte_before(f, at: int) -> bytes:
    """The last byte of the blocks before ``at``, which is where a block begins."""
    low = max(0, at - 2 * BLOCK)
    window = f.read_at(at - low, low)
    k = window.rfind(HEAD)
    while k >= 0:
        if block_size(window, k) == len(window) - k:
            data = unpack(window[k:])
            return data[-1:] if data else _byte_before(f, low + k)
        k = window.rfind(HEAD, 0, k + 3)
    raise ValueError(f"no block ends at byte {at}")


def blocks(f, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, unpacked bytes) of the blocks from ``at`` on."""
    window, base = b"", at
    while at < size:
        if at - base + BLOCK > len(window) and base + len(window) < size:
            window, base = f.read_at(PIECE + BLOCK, at), at
        n = block_size(window, at - base)
        if not n:
            raise ValueError(f"no block begins at byte {at}")
        yield at, unpack(window[at - base : at - base + n])
        at += n


def pieces(f, r: Range) -> tuple[bytes | None, Iterator[tuple[bytes, bool]]]:
    """The byte before the range's first one, None at a file's beginning, and the unpacked bytes from there to the file's end with
    whether they are the range's own."""
    if r.kind == "gzip":
        return None, ((x, True) for x in _gunzip(f, r.size))
    if r.kind == "plain":
        return (f.read_at(1, r.start - 1) if r.start else None), _plain(f, r)
    at = first_block(f, r.start, r.size) if r.start else 0
    return (_byte_before(f, at) if at and at < r.end else None), _unpacked(f, r, at)


def _plain(f, r: Range) -> Iterator[tuple[bytes, bool]]:
    for a, b, own in ((r.start, r.end, True), (r.end, r.size, False)):
        for at in range(a, b, PIECE):
            yield f.read_at(min(PIECE, b - at), at), own


def _unpacked(f, r: Range, at: int) -> Iterator[tuple[bytes, bool]]:
    held, own, n = [], True, 0
    if at >= r.end:
        return
    for offset, data in blocks(f, at, r.size):
        # Beyond the range's end blocks come one by one, as the last record mostly ends in the first of them.
        if n and (n >= PIECE or not own or own != (offset < r.end)):
            yield b"".join(held), own
            held, n = [], 0
        own = offset < r.end
        held.append(data)
        n += len(data)
    if held:
        yield b"".join(held), own


def _gunzip(f, size: int) -> Iterator[bytes]:
    z = zlib.decompressobj(wbits=31)
    for at in range(0, size, PIECE):
        data = f.read_at(min(PIECE, size - at), at)
        while data:
            out = z.decompress(data, PIECE)
            if out:
                yield out
            data = z.unconsumed_tail
            if z.eof:  # another member may follow
                data = z.unused_data.lstrip(b"\0")
                z = zlib.decompressobj(wbits=31)
            elif not out and not data:
                break


@dataclass
class Written(WriterCommitMessage):
    """A task's file, under the hidden name it has until all tasks are done."""

    hidden: str
    name: str


class BlocksWriter(DataSourceArrowWriter):
    """Block-compressed files in a folder, one for each task's rows. They get their names when the whole job is done, so rows of tasks
    that fail, or that run twice, are never read."""

    suffix = ""

    def __init__(self, path: str):
        self.path = path

    def contents(self, batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        """The file's bytes before they are packed."""
        raise NotImplementedError

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = open_fs(self.path)
        system.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}{self.suffix}"
        hidden = f"{folder}/_{name}"
        held = bytearray()
        with system.open_output_stream(hidden, compression=None) as out:
            for data in self.contents(iterator):
                held += data
                whole = len(held) // 0xFF00 * 0xFF00
                if whole >= PIECE:
                    out.write(pack(bytes(held[:whole])))
                    del held[:whole]
            out.write(pack(bytes(held)) + LAST_BLOCK)
        return Written(hidden, f"{folder}/{name}")

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = open_fs(self.path)
        for m in messages:
            if m is not None:
                system.move(m.hidden, m.name)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = open_fs(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(m.hidden)


__all__ = ["LAST_BLOCK", "SPLIT_BYTES", "BlocksWriter", "Group", "Range", "block_size", "blocks", "cut", "find_files", "grouped", "open_fs", "pack", "pieces", "unpack"]
