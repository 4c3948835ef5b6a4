"""Substring dedup by content-defined chunks.

A gear hash of the last 16 bytes rolls over a text; where its value is small enough a chunk ends, every
24 bytes or so, but none of fewer than ``LEAST`` bytes. Where no value is small for ``LONG`` bytes, as in text that repeats one
period, chunks end where the value is the least of that stretch, ``MEAN`` bytes apart at least, so that they are whole periods. Nothing
else decides (but a chunk of 4096 bytes ends anyway), so an insertion moves only the
cuts near it, and a passage has the same chunks wherever it stands, its first and last one or two aside. Chunks
are compared by a 64-bit digest. Runs of neighbouring chunks that all occur elsewhere and
hold at least ``MIN_WORDS`` words are repeats; only what other documents have counts. The first occurrence (by doc_id, then place)
stays. No chunk ends inside a character.

Null and empty texts have no chunks. Rows that share a doc_id are told apart by their texts (96 bits of hashes); rows that are wholly
equal give equal results and don't repeat each other. Rows without doc_id come before all others. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import chunks, id_and_text, materialize, mix64, per_row, powers, row_of, text_buffers

MEAN, LEAST, LONG, MOST = 24, 12, 128, 4096
MIN_WORDS = 25


def _spaced(cuts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """``cuts`` (ascending) without those that follow a kept one by fewer than ``LEAST`` bytes; ends of texts stay."""
    fixed = np.isin(cuts, offs)
    out, last = [], -LEAST
    for c, f in zip(cuts.tolist(), fixed.tolist(), strict=True):
        if f or c - last >= LEAST:
            out.append(c)
            last = c
    return np.array(out, np.int64)


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of consecutive texts: text, start in it, length, words that begin in it, digest."""
    base = int(offsets[0])
    data, offs = data[base : int(offsets[-1])], offsets - base
    n = len(data)
    gear = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(48)).astype(np.uint16)
    h = gear[data]
    for width in (1, 2, 4, 8):
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
    is_cut = np.zeros(n + 1, bool)
    is_cut[1:] = h < 65536 // MEAN
    for k in range(16):  # hashes that reach over a text's start
        at = offs[:-1] + k
        is_cut[at[at <= n]] = False
    inside = (data & 0xC0) == 0x80  # bytes inside a character
    is_cut[:n] &= ~inside
    is_cut[offs] = True
    cuts = np.flatnonzero(is_cut)
    far = np.flatnonzero(np.diff(cuts) > LONG)
    more = [cuts]
    for a, b in zip(cuts[far].tolist(), cuts[far + 1].tolist(), strict=True):
        own = h[a + 15 : b - 1].astype(np.int64) + (inside[a + 16 : b].astype(np.int64) << 16)
        more.append(a + 16 + np.flatnonzero(own == own.min()))
    cuts = _spaced(np.unique(np.concatenate(more)), offs)
    long = np.flatnonzero(np.diff(cuts) > MOST)
    if len(long):
        more = np.concatenate([np.arange(cuts[k] + MOST, cuts[k + 1], MOST) for k in long])
        for _ in range(3):
            more = more - inside[more]
        cuts = np.union1d(cuts, more)
    starts, ends = cuts[:-1], cuts[1:]
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * power[:n], out=sums[1:])
    digest = mix64((sums[ends] - sums[starts]) * inverse[starts]).view(np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~blank
    begins[1:] &= blank[:-1]
    begins[offs[:-1][offs[:-1] < n]] = ~blank[offs[:-1][offs[:-1] < n]]
    texts = np.searchsorted(offs, starts, side="right") - 1
    return texts, starts - offs[texts], ends - starts, per_row(cuts, begins.astype(np.int64)), digest


def repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, repeated (it shares a run with another place), spans
    array<struct<start, end, first, of>> (UTF-8 byte places of its runs; first: this is the occurrence that stays;
    of: the doc_id that holds the first occurrence), kept (the text without spans that aren't first)."""
    docs = id_and_text(docs, id_col, text_col)
    docs = docs.withColumn("key", F.struct(F.xxhash64("text").alias("a"), F.hash("text").alias("b")))
    key_type = "struct<a:bigint,b:int>"

    def chop(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for a, b in chunks(offsets):
                text, start, length, n_words, digest = cut(data, offsets[a : b + 1])
                keep = np.flatnonzero(length >= LEAST)
                place = start[keep] << 26 | length[keep] << 13 | n_words[keep]
                rows = pa.array(a + text[keep])
                columns = [batch.column(0).take(rows).cast(pa.int64()), batch.column(1).take(rows), pa.array(place)]
                columns.append(pa.array(digest[keep]))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "place", "digest"])

    chunked = docs.select("doc_id", "key", "text").mapInArrow(chop, f"doc_id bigint, key {key_type}, place bigint, digest bigint")
    where = F.struct("doc_id", "key", "place")
    stats = chunked.groupBy("digest").agg(F.min(where).alias("first"), F.max(where).alias("last"))
    stats = stats.filter("not (first.doc_id <=> last.doc_id and first.key = last.key)").drop("last")
    # Written, so that the join's two sides come straight from an exchange and a hot chunk's rows can be split.
    stats = materialize(stats, "shared-chunks")
    found = chunked.join(stats, "digest").select(
        "doc_id", "key", F.struct("place", F.col("first").eqNullSafe(where).alias("first"), F.col("first.doc_id").alias("of")).alias("c")
    )
    found = found.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("c")).alias("c"))

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first", pa.bool_()), ("of", pa.int64())]))
        for batch in batches:
            made = [_runs(c, min_words) for c in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(made, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "spans"])

    kind = "array<struct<start:bigint,end:bigint,first:boolean,of:bigint>>"
    spans = found.mapInArrow(runs, f"doc_id bigint, key {key_type}, spans {kind}")
    texts = docs.select("doc_id", "key", F.coalesce("text", F.lit("")).alias("text"))
    same = texts.doc_id.eqNullSafe(spans.doc_id) & (texts.key == spans.key)
    rows = texts.join(spans, same, "left").select(texts.doc_id, "text", F.coalesce("spans", F.array().cast(kind)).alias("spans"))
    rows = rows.withColumns({"raw": F.col("text").cast("binary"), "gone": F.filter("spans", lambda x: ~x["first"])})
    zero, end = F.array(F.lit(0).cast("bigint")), F.array(F.octet_length("text").cast("bigint"))
    pieces = F.arrays_zip(F.concat(zero, F.col("gone.end")).alias("a"), F.concat(F.col("gone.start"), end).alias("b"))
    cut_out = F.aggregate(
        pieces, F.lit(b""), lambda out, x: F.concat(out, F.substring(F.col("raw"), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")))
    )
    return rows.select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        (F.size("spans") > 0).alias("repeated"),
        "spans",
        F.when(F.size("gone") == 0, F.col("text")).otherwise(cut_out.cast("string")).alias("kept"),
    )


def _runs(found: list[dict], min_words: int) -> list[dict]:
    """Spans of runs of enough words; chunks too short to compare don't break a run."""
    out: list[dict] = []
    run: list[tuple[int, int, int, bool, int | None]] = []

    def close() -> None:
        if sum(c[2] for c in run) < min_words:
            return
        for start, end, _, first, of in run:
            if out and out[-1]["first"] == first and out[-1]["of"] == of and start - out[-1]["end"] < 2 * LEAST:
                out[-1]["end"] = end
            else:
                out.append({"start": start, "end": end, "first": first, "of": of})

    for c in found:
        start, length, n_words = c["place"] >> 26, c["place"] >> 13 & 8191, c["place"] & 8191
        if run and start - run[-1][1] >= 2 * LEAST:
            close()
            run = []
        run.append((start, start + length, n_words, c["first"], c["of"]))
    close()
    return out
