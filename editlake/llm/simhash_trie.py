"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints: a bit is set if it is set in more than half of the hashes of a text's 3-word shingles.
Equal fingerprints are one vertex. Two fingerprints that differ in at most ``radius`` bits agree in one of
radius + 1 blocks of bits; each block's value is the upper part of a trie, which must agree, and fingerprints with
the same upper part go to the same task. There the trie is joined with itself: pairs of nodes go down
together, a step with different bits uses up one of the allowed errors, and a pair that has used more is dropped.
A pair of nodes whose leaves are one component already is dropped too, so that a dense group costs no
pair of its members. A task gives at most one link for each of its fingerprints.

Upper parts with more than ``HOT`` fingerprints are cut once more: the rest of the bits are blocks again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import text_batches
from .components import components
from .util import LOWER, id_and_text, materialize

HOT = 50_000
#: Node pairs that are gone through at once.
PAIRS = 1 << 19


def shingle_votes(text: str, size: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text, unsigned."""
    tokens = text.encode().translate(LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(size, len(tokens))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(tokens) - k + 1].tolist(), ends[k - 1 :].tolist())]
    h = np.array(hashes, ">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        bits = np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint) for every row; null and empty texts have fingerprint 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_batches(batch.column(1)):
                fps = np.array([shingle_votes(t, size) for t in texts], np.uint64).view(np.int64)
                ids = batch.column(0).slice(a, b - a).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(fps)], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


def _root(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after linking a[k] with b[k]; a root is the least index of its set."""
    while True:
        parent = _root(parent)
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def trie_links(group: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (member, root) that link the fingerprints of each group within ``radius`` bits, directly or by others.

    ``fp`` (uint64) ascends inside each group and is distinct there; equal ``group`` values are adjacent.
    """
    n = len(fp)
    parent = np.arange(n)
    if n < 2:
        return parent[:0], parent[:0]
    # Neighbours in order are often close: unite these first, so that dense groups are one component from the start.
    for turn in (0, 16, 32, 48):
        turned = fp if turn == 0 else (fp << np.uint64(turn)) | (fp >> np.uint64(64 - turn))
        order = np.lexsort((turned, group))
        a, b = order[:-1], order[1:]
        near = (group[a] == group[b]) & (_distance(fp[a], fp[b]) <= radius)
        parent = _unite(parent, a[near], b[near])
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    last = np.append(first[1:], n)
    several = last - first > 1
    lo, hi = first[several], last[several]
    work = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    ones: dict[int, np.ndarray] = {}
    while work:
        depth, a0, a1, b0, b1, errors = work.pop()
        runs = np.concatenate(([0], np.cumsum(parent[1:] != parent[:-1])))
        joined = (runs[a0] == runs[a1 - 1]) & (runs[b0] == runs[b1 - 1]) & (parent[a0] == parent[b0])
        keep = ~joined
        a0, a1, b0, b1, errors = a0[keep], a1[keep], b0[keep], b1[keep], errors[keep]
        if not len(a0):
            continue
        if len(a0) > PAIRS:
            half = len(a0) // 2
            work.append((depth, a0[half:], a1[half:], b0[half:], b1[half:], errors[half:]))
            work.append((depth, a0[:half], a1[:half], b0[:half], b1[:half], errors[:half]))
            continue
        small = (a1 - a0) * (b1 - b0) <= 16
        if small.any():
            wide = (b1 - b0)[small]
            sizes = (a1 - a0)[small] * wide
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x = np.repeat(a0[small], sizes) + at // np.repeat(wide, sizes)
            y = np.repeat(b0[small], sizes) + at % np.repeat(wide, sizes)
            near = (x < y) & (_distance(fp[x], fp[y]) <= radius)
            parent = _unite(parent, x[near], y[near])
        keep = ~small
        a0, a1, b0, b1, errors = a0[keep], a1[keep], b0[keep], b1[keep], errors[keep]
        if not len(a0):
            continue
        for d in [d for d in ones if d < depth - 8 or d > depth]:
            del ones[d]
        if depth not in ones:
            bit = (fp >> np.uint64(depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int32))))
        c = ones[depth]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        same = a0 == b0
        parts = [
            (a0, am, b0, bm, errors),
            (am, a1, bm, b1, errors),
            (a0, am, bm, b1, errors + 1),
            (am[~same], a1[~same], b0[~same], bm[~same], errors[~same] + 1),
        ]
        down = [np.concatenate(z) for z in zip(*parts, strict=True)]
        live = (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= radius)
        work.append((depth - 1, *[z[live] for z in down]))
    member = np.flatnonzero(parent != np.arange(n))
    return member, parent[member]


def _blocks(fp, radius: int, low: int, high: int):
    """(number, value) of radius + 1 blocks of the bits from ``low`` up to ``high``."""
    cuts = [low + (high - low) * k // (radius + 1) for k in range(radius + 2)]
    return [
        F.struct(F.lit(k).alias("k"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("v"))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]


def links(reps: DataFrame, radius: int = 3, hot: int = HOT) -> DataFrame:
    """Links (u, v) between representatives of ``reps`` (fp, rep; one row for each fingerprint, rep not null) that
    join all fingerprints within ``radius`` bits, directly or by others."""
    fp = F.col("fp")
    keyed = reps.select("fp", "rep", F.explode(F.array(*_blocks(fp, radius, 0, 64))).alias("b"))
    keyed = keyed.select("fp", "rep", (F.col("b.k") * 4).cast("int").alias("k"), F.col("b.v").alias("v"))
    large = keyed.groupBy("k", "v").count().filter(F.col("count") > hot).select("k", "v", F.lit(True).alias("hot"))
    keyed = keyed.join(large, ["k", "v"], "left")
    # The bits outside the hot block, as blocks again: one of them agrees.
    width = 64 // (radius + 1)
    turned = F.shiftleft(fp, 0)
    for k in range(radius + 1):
        low = width * k
        rest = fp if low == 0 else F.shiftrightunsigned(fp, low).bitwiseOR(F.shiftleft(fp, 64 - low))
        turned = F.when(F.col("k") == 4 * k, rest).otherwise(turned)
    again = F.array(*_blocks(turned, radius, width, 64))
    none = F.array(F.struct(F.lit(0).alias("k"), F.lit(0).cast("bigint").alias("v")))
    keyed = keyed.select(
        "fp", "rep", "k", "v", F.explode(F.when(F.col("hot"), again).otherwise(none)).alias("s"), F.col("hot")
    )
    keyed = keyed.select(
        "fp",
        "rep",
        F.xxhash64("k", "v", F.col("hot"), F.col("s.k"), F.col("s.v")).alias("g"),
    ).repartition("g")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        fps, reps_, group = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in range(3))
        fps = fps.view(np.uint64)
        order = np.lexsort((fps, group))
        fps, reps_, group = fps[order], reps_[order], group[order]
        member, root = trie_links(group, fps, radius)
        yield pa.RecordBatch.from_arrays([pa.array(reps_[member]), pa.array(reps_[root])], ["u", "v"])

    return keyed.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, size: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable).

    Documents without doc_id have a fingerprint; their component is that of the documents that share it, null
    if none of these has a doc_id. Repeated rows get equal results. An empty table gives no rows.
    """
    fps = materialize(fingerprints(docs, size, id_col, text_col), "fingerprints")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    found = components(links(reps.filter("rep is not null"), radius))
    named = reps.join(found, reps.rep == found.vertex, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
