"""Benchmark decontamination by winnowing.

Both sides are cut into words and 5-word grams are hashed. Of every 6 consecutive grams the one of
least hash is kept, so a run of 10 shared words shares a kept gram at the same place. Kept grams of
the documents are joined with those of the benchmark; a match is extended to the 10-word windows that
can hold it, which are looked up among the benchmark's windows by hash and then compared byte by byte. Items of fewer words are
one window of their own length; there every gram of that length is kept.

A benchmark of at most ``block_bytes`` of text is broadcast as an index, so that documents aren't shuffled. Beyond that the kept grams
of both sides are joined as tables, and each pair of a document and an item that share one is looked at for itself.

Null texts have no words. Items without an id are left out. Repeated items count once, repeated documents
give a row each. Rows that share a doc_id are told apart by their texts. Empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import gather
from .util import chunks, grams, id_and_text, materialize, row_of, text_buffers, words

GRAM = 5
BLOCK_BYTES = 32 << 20


class _Words:
    """The bytes of consecutive texts, A-Z in lower case, and where their words are."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        upper = (data >= 65) & (data <= 90)
        self.data, self.starts, self.sizes = data + (upper * np.uint8(32)), starts, ends - starts

    def equal(self, at: np.ndarray, other: _Words, there: np.ndarray, n: int) -> np.ndarray:
        """Whether the ``n`` words from at[k] are those of ``other`` from there[k]."""
        if not len(at):
            return np.zeros(0, bool)
        # Windows overlap, so each pair of words is compared once.
        pairs = (at[:, None] + np.arange(n)).ravel() * (len(other.starts) + 1) + (there[:, None] + np.arange(n)).ravel()
        pairs, back = np.unique(pairs, return_inverse=True)
        a, b = np.divmod(pairs, len(other.starts) + 1)
        same = self.sizes[a] == other.sizes[b]
        sizes = self.sizes[a[same]]
        differ = gather(self.data, self.starts[a[same]], sizes) != gather(other.data, other.starts[b[same]], sizes)
        ends = np.cumsum(sizes)
        same[np.flatnonzero(same)[np.searchsorted(ends, np.flatnonzero(differ), side="right")]] = False
        return same[back].reshape(-1, n).all(1)


class BenchmarkIndex:
    """Kept grams and windows of one block of items."""

    def __init__(self, items: list[str], texts: list[str], window: int):
        self.window, self.gram = window, min(GRAM, window)
        self.slide = window - self.gram + 1
        self.names = sorted(set(items))
        number = {name: k for k, name in enumerate(self.names)}
        item = np.array([number[x] for x in items], np.int64)
        data, offsets = text_buffers(pa.array(texts, pa.large_string()))
        h, starts, ends, first = words(data, offsets)
        self.text = _Words(data[offsets[0] : offsets[-1]], starts, ends)
        counts, owner = np.diff(first), row_of(first)
        kept: list[np.ndarray] = []
        #: For each length its tables: windows, their places, which set of items each has, the sets. A window whose hash another
        #: one has already is in the next table.
        self.tables: dict[int, list[tuple]] = {}
        for n in np.unique(np.minimum(counts, window)):
            if n == 0:
                continue
            rows = counts >= window if n == window else counts == n
            at = np.flatnonzero(rows[owner] & (np.arange(len(h)) + n <= first[owner + 1]))
            hashes, items_ = grams(h, int(n), at), item[owner[at]]
            self.tables[int(n)] = []
            while len(at):
                _, which, back = np.unique(hashes, return_index=True, return_inverse=True)
                same = self.text.equal(at, self.text, at[which][back], int(n))
                windows, sets_of, sets = _item_sets(hashes[same], items_[same])
                self.tables[int(n)].append((windows, at[which], sets_of, sets))
                at, hashes, items_ = at[~same], hashes[~same], items_[~same]
            if n == window:
                g = grams(h, self.gram)
                keep = kept_grams(g, self.slide)
                inside = rows[owner[: len(g)]] & (np.arange(len(g)) + self.gram <= first[owner[: len(g)] + 1])
                kept.append(g[keep & inside])
        self.kept = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.kept & np.uint64(0xFFFFF)).astype(np.int64)] = True


def _item_sets(hashes: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    pairs = np.unique(np.stack([hashes, items.astype(np.uint64)], 1), axis=0)
    windows, first = np.unique(pairs[:, 0], return_index=True)
    sets: dict[bytes, int] = {}
    which = np.empty(len(windows), np.int64)
    ends = [*first[1:], len(pairs)]
    for k, (a, b) in enumerate(zip(first, ends, strict=True)):
        which[k] = sets.setdefault(pairs[a:b, 1].astype(np.int64).tobytes(), len(sets))
    return windows, which, [np.frombuffer(x, np.int64) for x in sets]


def kept_grams(g: np.ndarray, slide: int) -> np.ndarray:
    """Which grams are the least of some ``slide`` consecutive ones; all of equal ones."""
    if len(g) < slide:
        return np.ones(len(g), bool)
    m = len(g) - slide + 1
    least = g[:m].copy()
    for j in range(1, slide):
        np.minimum(least, g[j : j + m], out=least)
    keep = np.zeros(len(g), bool)
    for j in range(slide):
        keep[j : j + m] |= g[j : j + m] == least
    return keep


def find_hits(index: BenchmarkIndex, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Word counts of consecutive texts; positions of hit words and names of items for each."""
    h, starts, ends, first = words(data, offsets)
    text = _Words(data[offsets[0] : offsets[-1]], starts, ends)
    rows = len(first) - 1
    hits = np.zeros(len(h) + 1, np.int64)
    owner = row_of(first)
    pairs = []
    for n, tables in index.tables.items():
        if len(h) < n:
            continue
        if n == index.window:
            g = grams(h, index.gram)
            at = np.flatnonzero(kept_grams(g, index.slide))
            at = at[index.sieve[(g[at] & np.uint64(0xFFFFF)).astype(np.int64)]]
            at = at[np.isin(g[at], index.kept)]
            at = np.unique((at[:, None] - np.arange(index.slide)).ravel())
            at = at[(at >= 0) & (at + n <= len(h))]
        else:
            at = np.arange(len(h) - n + 1)
        at = at[at + n <= first[owner[at] + 1]]
        got = grams(h, n, at)
        for windows, places, which, sets in tables:
            place = np.minimum(np.searchsorted(windows, got), len(windows) - 1)
            some = np.flatnonzero(windows[place] == got)
            some = some[text.equal(at[some], index.text, places[place[some]], n)]
            here, place = at[some], place[some]
            np.add.at(hits, here, 1)
            np.add.at(hits, here + n, -1)
            of = np.unique(np.stack([owner[here], which[place]], 1), axis=0)
            pairs += [(r, x) for r, s in of for x in sets[s].tolist()]
    at = np.flatnonzero(np.cumsum(hits[:-1]) > 0)
    counts = np.diff(first)
    where = np.searchsorted(at, first)
    places = [at[a:b] - f for a, b, f in zip(where[:-1], where[1:], first[:-1], strict=True)]
    names: list[set[int]] = [set() for _ in range(rows)]
    for r, x in pairs:
        names[r].add(x)
    return counts, places, [sorted(index.names[x] for x in s) for s in names]


def _marked(docs: DataFrame, block: DataFrame, window: int) -> DataFrame:
    items = block.collect()
    index = docs.sparkSession.sparkContext.broadcast(
        BenchmarkIndex([r.item_id for r in items], [r.text for r in items], window)
    )
    schema = "doc_id bigint, text_key bigint, n_words bigint, hit_words array<int>, items array<string>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = index.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                counts, places, names = find_hits(bench, data, offsets[a : b + 1])
                columns = [
                    batch.column(0).slice(a, b - a).cast(pa.int64()),
                    batch.column(2).slice(a, b - a),
                    pa.array(counts.astype(np.int64)),
                    pa.array([p.astype(np.int32) for p in places], pa.list_(pa.int32())),
                    pa.array(names, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(run, schema)


def _document_grams(docs: DataFrame, window: int, short: list[int]) -> DataFrame:
    """(doc_id, text_key, n, gram): the different kept grams of each document, and all grams of the lengths ``short``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                h, _, _, first = words(data, offsets[a : b + 1])
                owner = row_of(first)
                for n, size in ((window, min(GRAM, window)), *((n, n) for n in short)):
                    g = grams(h, size)
                    keep = kept_grams(g, window - size + 1) if n == window else np.ones(len(g), bool)
                    at = np.flatnonzero(keep & (np.arange(len(g)) + size <= first[owner[: len(g)] + 1]))
                    pairs = np.unique(np.stack([owner[at].astype(np.uint64), g[at]], 1), axis=0)
                    rows = pa.array(a + pairs[:, 0].astype(np.int64))
                    columns = [batch.column(0).take(rows).cast(pa.int64()), batch.column(2).take(rows)]
                    columns += [pa.array(np.full(len(pairs), n, np.int32)), pa.array(pairs[:, 1].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n", "gram"])

    return docs.mapInArrow(run, "doc_id bigint, text_key bigint, n int, gram bigint")


def _item_grams(items: DataFrame, window: int) -> DataFrame:
    """(item_id, item_key, n, gram): the kept grams of each item; of one with fewer words that window's hash, and n is its words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index = BenchmarkIndex([item], [text], window)
                for n, tables in index.tables.items():
                    g = index.kept if n == window else tables[0][0]
                    columns = [pa.array([item] * len(g), pa.string()), pa.array([key] * len(g), pa.int64())]
                    columns += [pa.array(np.full(len(g), n, np.int32)), pa.array(g.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["item_id", "item_key", "n", "gram"])

    return items.select("item_id", "item_key", "text").mapInArrow(run, "item_id string, item_key bigint, n int, gram bigint")


def _joined(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """As :func:`_marked`, by a join of both sides' kept grams."""
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    items = items.withColumn("item_key", F.xxhash64("text"))
    item_grams = materialize(_item_grams(items, window), "benchmark-grams")
    short = sorted(r.n for r in item_grams.select("n").distinct().collect() if r.n < window)  # fewer than window
    pairs = _document_grams(docs.select("doc_id", "text", "text_key"), window, short).join(item_grams, ["n", "gram"])
    pairs = pairs.select("doc_id", "text_key", "item_id", "item_key").distinct()
    same = pairs.doc_id.eqNullSafe(docs.doc_id) & (pairs.text_key == docs.text_key)
    both = docs.dropDuplicates(["doc_id", "text_key"]).join(pairs, same).select(docs.doc_id, docs.text_key, "text", "item_id", "item_key")
    both = both.join(items.withColumnRenamed("text", "item_text"), ["item_id", "item_key"])
    schema = "doc_id bigint, text_key bigint, hit_words array<int>, items array<string>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of = None, None
        for batch in batches:
            out = []
            for doc_id, key, text, item, item_text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != (item, item_text):
                    index, of = BenchmarkIndex([item], [item_text], window), (item, item_text)
                _, places, names = find_hits(index, *text_buffers(pa.array([text], pa.large_string())))
                if names[0]:
                    out.append((doc_id, key, places[0].tolist(), names[0]))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    hits = both.select("doc_id", "text_key", "text", "item_id", "item_text").mapInArrow(run, schema)
    places = hits.select("doc_id", "text_key", F.explode("hit_words").alias("at")).groupBy("doc_id", "text_key")
    places = places.agg(F.array_sort(F.collect_set("at")).alias("hit_words"))
    names = hits.select("doc_id", "text_key", F.explode("items").alias("item")).groupBy("doc_id", "text_key")
    names = names.agg(F.array_sort(F.collect_set("item")).alias("items"))
    empty = _marked(docs.select("doc_id", "text"), items.limit(0), window).withColumnsRenamed({"doc_id": "id", "text_key": "own"})
    rows = empty.select("id", "own", "n_words")
    for part in (places, names):
        rows = rows.join(part, rows.id.eqNullSafe(part.doc_id) & (rows.own == part.text_key), "left").drop("doc_id", "text_key")
    none_i, none_s = F.array().cast("array<int>"), F.array().cast("array<string>")
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("hit_words", none_i).alias("hit_words"), F.coalesce("items", none_s).alias("items")
    )


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, hit_words array<int> (places of words inside windows that
    the benchmark has), items array<string> (ids of items with such windows, sorted as strings)."""
    docs = id_and_text(docs, id_col, text_col)
    items = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .filter("item_id is not null and text is not null")
        .distinct()
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("n")).first().n
    if total <= block_bytes:
        return _marked(docs, items, window).drop("text_key")
    return _joined(docs, items, window)
