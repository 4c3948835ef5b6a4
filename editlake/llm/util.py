"""Helpers the corpus operators share: shared-folder tables, Arrow text buffers, vectorised words.

Word hashes are polynomial in the word's bytes, computed for a whole chunk of documents from one
prefix sum, so no Python object is made per word.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1
#: Bytes of text that one vectorised step takes; a longer document makes a step of its own.
CHUNK_BYTES = 1 << 20
#: For bytes.translate: A-Z in lower case.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where that is unset a temporary one, in local mode only."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="editlake-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def write_table(df: DataFrame, label: str, **options: str) -> str:
    """Write ``df`` as Parquet under the shared folder and return its path."""
    path = f"{shared_dir(df.sparkSession)}/editlake-{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: later reads survive the loss of any executor and nothing is computed twice."""
    return df.sparkSession.read.parquet(write_table(df, label))


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`write_table` made."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so other columns can't clash."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def ascii_lower(col):
    """Lower-case A-Z only; plain ``lower`` does it faster where the text is ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(
        F.translate(col, upper, upper.lower())
    )


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and its row offsets; a null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@functools.lru_cache(maxsize=1)
def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    """A random 64-bit value for each byte, A-Z like a-z; and which bytes are word bytes."""
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    values[65:91] = values[97:123]
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x41:0x5B] = word[0x61:0x7B] = word[0x80:] = True
    return values, word


BASE = 0xD6E8FEB86659FD93
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i below n at least."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            p = np.full(max(n, CHUNK_BYTES + 4096), base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of consecutive texts: runs of letters and digits after lower-casing A-Z, any non-ASCII byte included.

    Returns 64-bit hashes, first bytes, ends (relative to the first text) and each text's first word.
    """
    values, is_word = _byte_values()
    base = int(offsets[0])
    data, offs = data[base : int(offsets[-1])], offsets - base
    n = len(data)
    mask = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    before[:1], after[-1:] = False, False
    before[1:], after[:-1] = mask[:-1], mask[1:]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * power[:n], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, starts, ends, np.searchsorted(starts, offs)


def grams(hashes: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of ``n`` consecutive words from each position, or from those in ``at``."""
    q = np.uint64(0x9FB21C651E98DF25)
    if at is None:
        m = max(0, len(hashes) - n + 1)
        h = hashes[:m].copy()
        for j in range(1, n):
            h *= q
            h += hashes[j : j + m]
    else:
        h = hashes[at]
        for j in range(1, n):
            h = h * q + hashes[at + j]
    return mix64(h)


def row_of(first: np.ndarray) -> np.ndarray:
    """For each element, which row holds it, from the rows' first elements."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def per_row(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each row's elements."""
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[first[1:]] - sums[first[:-1]]


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the different ``size``-word shingles of consecutive texts, by text and hash; a text of fewer words,
    but not none, is one shingle."""
    h, _, _, first = words(data, offsets)
    counts, owner = np.diff(first), row_of(first)
    at = np.flatnonzero(np.arange(len(h)) + size <= first[owner + 1]) if len(h) else np.zeros(0, np.int64)
    texts, values = [owner[at]], [grams(h, size, at)]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        texts.append(short)
        values.append(grams(h, n, first[short]))
    text, value = np.concatenate(texts), np.concatenate(values)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]
