"""Token ids in files: an adaptive context-mixing range coder.

A file segment is one binary value: a header, the documents' ids and lengths, the frequencies of the segment's ids, a
directory of blocks and the blocks. A block holds ``BLOCK`` ids (the last one of a segment fewer), begins with a fresh
model and has a CRC-32 of its ids. Three predictions are mixed for each id: the id last seen after the same two ids
(order 2), the one last seen after the same id (order 1) and the frequencies of the segment (order 0). The weight of
the first two grows with how often each was right in a row in its context. A range coder with 16-bit output units is
driven by the mixed frequencies.

All blocks of a segment are coded side by side: a step takes one id of every block.

Segments hold whole documents and are written by Spark as Parquet rows into the shared folder, so task
retries and lost executors leave no partial files. Null texts are encoded as empty (just the end id);
documents without doc_id come first; rows of one doc_id come in the order of their texts' hashes, then of their texts, so
that two runs give the same files. A text of any length is one document of one segment. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import gc
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import CHUNK, PieceEncoder, cut_bytes, gather, joined_text, split_by_bytes, text_slices
from .util import id_and_text, write_table

MAGIC = b"CMRC\x02\x00\x00\x00"
BLOCK = 1024
#: Ids after which a segment is closed.
SEGMENT_IDS = 8192 * BLOCK
#: Contexts of an order that a block tells apart.
SLOTS = 512
#: Binary digits of the weights of the mixture and of the frequencies of order 0.
MIX, STATIC = 10, 18
TOTAL = MIX + STATIC
WINDOW, LEAST_SPAN = 48, 1 << 32
#: Weights of order 1 and order 2 by the state of a context: never seen, and right 0, 1, 2 or more times in a row.
WEIGHTS = np.array([0, 40, 200, 340, 0, 130, 480, 640], np.int32)
I = np.int32  # noqa: E741


class Model:
    """The state of ``lanes`` blocks; lanes only ever drop off the end. Ids are ranks of frequency, from 1.

    A context's entry is the id it saw last, with its state above bit 16. Entries of one context lie side by side.
    """

    def __init__(self, lanes: int, freq: np.ndarray):
        self.lanes = lanes
        self.seen = np.zeros(2 * SLOTS * lanes, I)
        self.lane = (np.arange(lanes) + np.array([[0], [SLOTS * lanes]])).astype(I)
        self.at = self.lane.copy()
        self.before = np.zeros(lanes, I)
        self.freq = np.concatenate(([0], freq)).astype(I)
        self.below = (np.cumsum(self.freq) - self.freq).astype(I)
        self.fresh = np.array([[1 << 16], [5 << 16]], I)

    def predict(self, n: int) -> None:
        """Candidates of both orders and the weights of all three for the next id of the first ``n`` blocks."""
        self.entry = self.seen.take(self.at[:, :n], mode="clip")
        self.guess = self.entry & I(0xFFFF)
        self.weight = WEIGHTS.take(self.entry >> I(16))
        self.rest = I(1 << MIX) - self.weight[0] - self.weight[1]

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower end and width of the ids ``x`` among 1 << TOTAL; then learns them.

        A guessed id has the interval of the orders that guess it and nothing of order 0; order 2 comes first.
        """
        n, rest = len(x), self.rest
        width = self.freq.take(x)
        width *= rest
        low = self.below.take(x)
        low *= rest
        low += (I(1 << MIX) - rest) << I(STATIC)
        right = self.guess == x
        new = x + self.fresh
        k = np.flatnonzero(right[0] | right[1])
        if len(k):
            hit, weight, fresh = right[:, k], self.weight[:, k], new[:, k]
            width[k] = (weight * hit).sum(0, dtype=I) << I(STATIC)
            low[k] = weight[1] * ~hit[1] << I(STATIC)
            new[:, k] = np.where(hit, np.minimum(self.entry[:, k] + I(1 << 16), fresh + I(2 << 16)), fresh)
        at = self.at[:, :n]
        self.seen[at] = new
        at[0] = x
        at[1] = self.before[:n]
        turned = x * I(25033)
        at[1] += turned
        at[1] >>= I(4)
        turned *= I(1618)
        self.before[:n] = turned
        at &= I(SLOTS - 1)
        at *= I(self.lanes)
        at += self.lane[:, :n]
        return low, width


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, ascending, and their frequencies, 1 << STATIC in all and none zero."""
    counts = np.bincount(ids)
    values = np.flatnonzero(counts)
    freq = 1 + counts[values] * ((1 << STATIC) - len(values)) // max(1, len(ids))
    if len(values):
        freq[freq.argmax()] += (1 << STATIC) - freq.sum()
    return values, freq


def _ranked(values: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By falling frequency, of equal ones by the id."""
    order = np.argsort(-freq, kind="stable")
    return values[order], freq[order]


def _rows(total: int) -> tuple[int, int, int]:
    """Blocks, full blocks and ids of the block that isn't full."""
    full, rest = divmod(total, BLOCK)
    return full + (rest > 0), full, rest


def encode_blocks(ids: np.ndarray, values: np.ndarray, freq: np.ndarray) -> list[bytes]:
    """Coded bytes of each block of ``ids`` (below 65535), with their :func:`frequencies`."""
    lanes, full, rest = _rows(len(ids))
    if not lanes:
        return []
    values, freq = _ranked(values, freq)
    rank = np.zeros(1 << 16, np.uint16)
    rank[values] = np.arange(1, len(values) + 1)
    table = np.zeros(lanes * BLOCK, np.uint16)
    table[: len(ids)] = rank[ids]
    table = np.ascontiguousarray(table.reshape(lanes, BLOCK).T)
    model, room = Model(lanes, freq), 2 * BLOCK + 8
    out = np.zeros(lanes * room, np.uint32)
    first = np.arange(lanes) * room
    end = first.copy()
    low, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << WINDOW, np.int64)
    for step in range(BLOCK if full else rest):
        n = full if rest and step >= rest else lanes
        model.predict(n)
        cum, width = model.interval(table[step, :n].astype(I))
        share = span[:n] >> TOTAL
        lo = low[:n]
        lo += cum * share
        share *= width
        which = np.flatnonzero(share < LEAST_SPAN)
        while len(which):
            l, s, e = lo[which], share[which], end[which]
            out[e] = l >> 32  # with what it carries over, above bit 16
            end[which] = e + 1
            lo[which] = (l & (LEAST_SPAN - 1)) << 16
            s <<= 16
            share[which] = s
            which = which[s < LEAST_SPAN]
        span[:n] = share
    last = (low >> 16) + 1
    out[end], out[end + 1] = last >> 16, last & 0xFFFF
    sizes = end + 2 - first
    out = gather(out, first, sizes)
    while True:
        carry = out >> 16
        if not carry.any():
            break
        out &= 0xFFFF
        out[:-1] += carry[1:]
    raw, ends = out.astype("<u2").tobytes(), (2 * np.cumsum(sizes)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def decode_blocks(blocks: list[bytes], total: int, values: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """The ``total`` ids of blocks that :func:`encode_blocks` made."""
    lanes, full, rest = _rows(total)
    if not lanes:
        return np.zeros(0, np.int64)
    values, freq = _ranked(values, freq)
    data = np.frombuffer(b"".join(blocks) + bytes(16), "<u2")
    at = np.concatenate(([0], np.cumsum([len(b) // 2 for b in blocks])))[:-1].astype(np.int64)
    model, table = Model(lanes, freq), np.zeros((BLOCK, lanes), np.uint16)
    rank_of = np.repeat(np.arange(1, len(freq) + 1, dtype=I), freq)
    code, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << WINDOW, np.int64)
    for _ in range(3):
        code = code << 16 | data[at]
        at += 1
    for step in range(BLOCK if full else rest):
        n = full if rest and step >= rest else lanes
        model.predict(n)
        share, c = span[:n] >> TOTAL, code[:n]
        value = np.minimum(c / share, (1 << TOTAL) - 1).astype(I)  # below 2**48, so the quotient's floor is exact
        guessed = I(1 << MIX) - model.rest
        slot = value >> I(STATIC)
        k = np.flatnonzero(slot < guessed)
        value -= guessed << I(STATIC)
        value[k] = 0
        x = rank_of.take((value / model.rest).astype(np.intp))
        x[k] = np.where(slot[k] < model.weight[1, k], model.guess[1, k], model.guess[0, k])
        cum, width = model.interval(x)
        c -= cum * share
        share *= width
        table[step, :n] = x
        which = np.flatnonzero(share < LEAST_SPAN)
        while len(which):
            s, a = share[which], at[which]
            code[which] = code[which] << 16 | data[a]
            at[which] = a + 1
            s <<= 16
            share[which] = s
            which = which[s < LEAST_SPAN]
        span[:n] = share
    return np.concatenate(([0], values)).astype(np.int64)[table.T.ravel()[:total]]


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One segment of the file format."""
    values, freq = frequencies(ids)
    blocks = encode_blocks(ids, values, freq)
    raw = memoryview(ids.astype("<u4")).cast("B")
    crcs = [zlib.crc32(raw[k : k + 4 * BLOCK]) for k in range(0, len(raw), 4 * BLOCK)]
    packed = zlib.compress(np.diff(values, prepend=0).astype("<u2").tobytes() + freq.astype("<u4").tobytes())
    return b"".join(
        [
            MAGIC,
            struct.pack("<QQQQQ", len(doc_ids), len(blocks), len(ids), len(values), len(packed)),
            np.array([x is None for x in doc_ids], np.uint8).tobytes(),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array(lengths, "<u8").tobytes(),
            packed,
            np.array([len(b) for b in blocks], "<u2").tobytes(),
            np.array(crcs, "<u4").tobytes(),
            *blocks,
        ]
    )


def unpack_segment(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids of a segment; raises ValueError if a block's checksum is wrong."""
    if blob[:8] != MAGIC:
        raise ValueError("not a segment")
    n_docs, n_blocks, total, n_values, n_packed = struct.unpack_from("<QQQQQ", blob, 8)
    at = 48

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(blob, kind, n, at)
        at += got.nbytes
        return got

    nulls, doc_ids, lengths = take("u1", n_docs), take("<i8", n_docs), take("<u8", n_docs).astype(np.int64)
    try:
        packed = zlib.decompress(take("u1", n_packed))
        values = np.cumsum(np.frombuffer(packed, "<u2", n_values).astype(np.int64))
        freq = np.frombuffer(packed, "<u4", n_values, 2 * n_values).astype(np.int64)
        sizes, crcs = take("<u2", n_blocks).tolist(), take("<u4", n_blocks).tolist()
        blocks = []
        for size in sizes:
            blocks.append(blob[at : at + size])
            at += size
        with np.errstate(divide="ignore", invalid="ignore"):
            ids = decode_blocks(blocks, total, values, freq)
    except (IndexError, zlib.error) as error:  # what was decoded leads outside the block
        raise ValueError("a block is damaged") from error
    raw = memoryview(ids.astype("<u4")).cast("B")
    for k, crc in enumerate(crcs):
        if zlib.crc32(raw[4 * k * BLOCK : 4 * (k + 1) * BLOCK]) != crc:
            raise ValueError(f"block {k}: wrong checksum")
    return [None if z else x for z, x in zip(nulls.tolist(), doc_ids.tolist(), strict=True)], lengths, ids


@functools.lru_cache(maxsize=1)
def _tokenizer(definition: str) -> PieceEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    gc.disable()  # millions of strings and no cycles
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    sizes = np.zeros(max(tokenizer.get_vocab().values()) + 1, np.int64)
    for token, k in tokenizer.get_vocab().items():
        sizes[k] = len(token)  # a character of a token stands for a byte

    def whole(texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.int64) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        joined = [joined_text(array.slice(k, 500)) for k in range(0, len(array), 500)]
        ids = np.concatenate([np.zeros(0, np.int64), *whole(joined)])
        ends = np.cumsum(np.asarray(pc.binary_length(array)).astype(np.int64))
        return ids, split_by_bytes(ids, sizes[ids], ends)

    return PieceEncoder(whole, parts, "<u2")


def write_ids(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> str:
    """Encode every text, append ``end_id``, write segments in ascending doc_id order; returns the folder.

    Rows: part, segment, n_tokens, blob. part follows doc_id order, segment the order inside a part.
    The tokenizer's definition (below 2 MB) is broadcast; its ids must be below 65536.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    tail = np.array([end_id], "<u2").tobytes()
    schema = "part int, segment int, n_tokens bigint, blob binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, segment = _tokenizer(definition.value), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, held, size, segment
            ids = np.frombuffer(b"".join(held), "<u2")
            blob = pack_segment(doc_ids, [len(x) // 2 for x in held], ids)
            row = [[part], [segment], [len(ids)], [blob]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            doc_ids, held, size, segment = [], [], 0, segment + 1
            names = ["part", "segment", "n_tokens", "blob"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), CHUNK):
                made = cut_bytes(*encoder.encode(texts))
                for doc_id, ids in zip(batch.column(0).slice(a, b - a).to_pylist(), made, strict=True):
                    doc_ids.append(doc_id)
                    held.append(ids + tail)
                    size += len(ids) // 2 + 1
                    if size >= SEGMENT_IDS:
                        yield close()
        if held:
            yield close()

    rows = id_and_text(docs, id_col, text_col).withColumn("own", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "own").sortWithinPartitions("doc_id", "own", "text")
    return write_table(ordered.mapInArrow(run, schema), "ids", compression="uncompressed")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32[, ids array<int>], from the decoded blocks.

    start counts the ids of all documents before; the offsets come from the segments' sizes, summed
    by part first, so that no task sees more rows than there are parts or segments of one part.
    """
    segments = spark.read.parquet(path)
    fields = "part int, segment int, skip bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    schema = fields + ", ids array<int>" * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, segment, blob = (batch.column(k)[row].as_py() for k in range(3))
                doc_ids, lengths, ids = unpack_segment(blob)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4")
                crcs = [zlib.crc32(raw[b - n : b]) for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                n = len(doc_ids)
                columns = [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.full(n, segment, np.int32)),
                    pa.array(ends - lengths),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    sizes = segments.select("part", "segment", "n_tokens")
    by_part = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside"))
    starts = starts.join(by_part, "part").select("part", "segment", (F.col("inside") + F.col("part_start")).alias("at"))
    docs = segments.select("part", "segment", "blob").mapInArrow(run, schema).join(starts, ["part", "segment"])
    return docs.select(
        "doc_id", (F.col("skip") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] * with_ids)
    )
