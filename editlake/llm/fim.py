"""Fill-in-the-middle texts, cut by a learned rank index.

A cut is given in code points and a text lies in UTF-8 bytes, so the index answers: at which byte does code point r begin? All boundary
offsets of a text, at most a megabyte at a time, are covered by straight segments from their first to their last offset. A segment that
misses an offset by more than ``ERROR`` bytes is halved until none does; what each is still off by is stored in a byte. A cut is predicted
by its segment and made exact by its residual.

Which texts are cut and where follows from the doc_id and a seed alone, so it is the same on any cluster; rows that share a doc_id have
the same numbers, rows without one those of an empty id. Null texts count as empty; empty texts, and those that hold a marker, stay
plain. The index of a text of any length takes as many bytes as the text at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import chunks, id_and_text, text_buffers

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The largest residual, the longest first segment, and how many bytes are indexed at once.
ERROR, LONGEST, SLICE = 127, 4096, 1 << 20
#: Of 100 texts so many are cut; of 100 that are, so many have the suffix first.
CUT, SUFFIX_FIRST = 90, 20


class RankIndex:
    """Byte offsets of the code points of UTF-8 ``data``, and of its end, by rank."""

    def __init__(self, data: np.ndarray):
        self.n = 0
        ranks, offsets, residuals = [], [], []
        for at in range(0, len(data), SLICE):
            # A slice's last boundary is where the next code point begins, maybe beyond the slice.
            own = np.flatnonzero((data[at : at + SLICE] & 0xC0) != 0x80) + at
            if not len(own):
                continue
            end = at + SLICE
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            first, residual = _fit(np.append(own, min(end, len(data))))
            ranks.append(first + self.n)
            offsets.append(own[first])
            residuals.append(residual)
            self.n += len(own)
        self.rank = np.concatenate([*ranks, [self.n]]).astype(np.int64)
        self.offset = np.concatenate([*offsets, [len(data)]]).astype(np.int64)
        self.residual = np.concatenate([*residuals, [0]]).astype(np.int8)

    def locate(self, rank: int) -> int:
        """The byte at which code point ``rank`` begins."""
        if rank >= self.n:
            return int(self.offset[-1])
        k = int(np.searchsorted(self.rank, rank, side="right")) - 1
        run, rise = self.rank[k + 1] - self.rank[k], self.offset[k + 1] - self.offset[k]
        return int(self.offset[k] + (rank - self.rank[k]) * rise // run + self.residual[rank])


def _fit(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First ranks of segments over all ``bounds`` but the last, and each rank's residual."""
    n = len(bounds) - 1
    residual = np.zeros(n, np.int64)
    starts = np.arange(0, n, LONGEST)
    ends = np.append(starts[1:], n)
    done = []
    while len(starts):
        sizes = ends - starts
        first = np.cumsum(sizes) - sizes
        step = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        at = np.repeat(starts, sizes) + step
        line = np.repeat(bounds[starts], sizes) + step * np.repeat(bounds[ends] - bounds[starts], sizes) // np.repeat(sizes, sizes)
        off = bounds[at] - line
        residual[at] = off
        wide = np.maximum.reduceat(np.abs(off), first) > ERROR
        done.append(starts[~wide])
        middle = (starts[wide] + ends[wide]) // 2
        starts, ends = np.concatenate((starts[wide], middle)), np.concatenate((middle, ends[wide]))
    return np.sort(np.concatenate(done)), residual


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 of a document."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def arrange(data: np.ndarray, h: list[int], cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, code points of prefix and of middle, output) of a text by its four numbers."""
    text = data.tobytes()
    index = RankIndex(data)
    if not text or h[2] % 100 >= cut or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return index.n, "plain", None, None, text
    a, b = sorted((h[0] % (index.n + 1), h[1] % (index.n + 1)))
    x, y = index.locate(a), index.locate(b)
    prefix, middle, suffix = text[:x], text[x:y], text[y:]
    if h[3] % 100 < suffix_first:
        return index.n, "spm", a, b - a, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return index.n, "psm", a, b - a, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(
    docs: DataFrame, seed: int = 1, cut: int = CUT, suffix_first: int = SUFFIX_FIRST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (code points), form (plain, psm or spm), prefix_chars, middle_chars, output."""
    docs = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                ids = batch.column(0).slice(a, b - a)
                made = [
                    arrange(data[x:y], draws(seed, doc_id), cut, suffix_first)
                    for doc_id, x, y in zip(ids.to_pylist(), offsets[a:b], offsets[a + 1 : b + 1], strict=True)
                ]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
                columns = [pa.array([x[k] for x in made], kind) for k, kind in enumerate(kinds)]
                output = pa.array([x[4] for x in made], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids, *columns, output], names)

    return docs.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(form: Column, output: Column) -> Column:
    """The text that an output was made of. A text that was cut holds no marker, so every marker is one of ours."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )
