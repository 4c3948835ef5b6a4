"""Ranked lexical search from the items' side: documents stream past an inverted index of the items.

The items are few and the documents many, so the index is over the items' terms: each term has the items that ask for it. Documents
are counted once, by the index's terms, into a written table; the statistics (documents, terms, document frequencies) come from
that table, and its rows are then streamed through the broadcast index. Every partition keeps a heap of the ``top`` best documents of
each item, and the heaps are merged in two steps.

An index is made of at most ``block_bytes`` of item terms (or of one item, if that has more); more items make several blocks, each
with a pass of its own. The scores are whole numbers, so no order of summing changes a result.

Null and empty texts have no terms: such documents count for nothing, such items have no rows. Rows that share an item_id are one item
with the terms of all of them, rows without item_id likewise. Rows of documents are documents of their own, whatever their doc_id;
of equal scores a document without doc_id comes last. Empty tables give no rows. Texts are counted by the megabyte, whatever their length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .util import chunks, drop_table, id_and_text, materialize, text_buffers, write_table

TOP = 10
BLOCK_BYTES = 4 << 20
#: Bytes of a text that are cut into terms at once, (document, item) cells and additions of a step.
PIECE, CELLS = 1 << 20, 1 << 21
#: Share of a document's length in its damping, in hundredths.
LENGTH_SHARE = 75


def _term_bytes() -> bytes:
    """For bytes.translate: letters and digits and non-ASCII bytes stay, A-Z in lower case; all else is a blank."""
    table = bytearray(b" " * 256)
    for a, b in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
        table[a:b] = bytes(range(a, b))
    table[0x41:0x5B] = bytes(range(0x61, 0x7B))
    return bytes(table)


TERM_BYTES = _term_bytes()


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a text."""
    text = text.translate(TERM_BYTES)
    if len(text) <= PIECE:
        return Counter(text.split())
    counts, at = Counter(), 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        counts.update(text[at:end].split())
        at = end
    return counts


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    data, offsets = text_buffers(batch.column(1))
    for a, b in chunks(offsets):
        part = data[offsets[a] : offsets[b]].tobytes()
        own = (offsets[a : b + 1] - offsets[a]).tolist()
        yield from (part[x:y] for x, y in zip(own, own[1:], strict=False))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id string, term binary, asked bigint) of ``items`` (item_id, text): how often an item has a term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), _texts(batch), strict=True):
                counts = term_counts(text)
                columns = [pa.array([item] * len(counts), pa.string()), pa.array(list(counts), pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["item_id", "term", "asked"])

    rows = items.select("item_id", "text").mapInArrow(run, "item_id string, term binary, asked bigint")
    return rows.groupBy("item_id", "term").agg(F.sum("asked").alias("asked"))


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms array<int>, tfs array<bigint>): all terms of each document with repeats, and the counts of those that
    ``vocabulary`` numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, terms, tfs, first = [], [], [], [0]
            for text in _texts(batch):
                counts = term_counts(text)
                sizes.append(counts.total())
                found = counts.keys() & known.keys() if len(known) < len(counts) else [x for x in counts if x in known]
                terms += [known[x] for x in found]
                tfs += [counts[x] for x in found]
                first.append(len(terms))
            first = pa.array(first, pa.int32())
            lists = [pa.ListArray.from_arrays(first, pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


class ItemIndex:
    """Postings of numbered terms: which numbered items ask for a term, and its weight times how often they do."""

    def __init__(self, rows: list[tuple[str | None, bytes, int]], df: dict[int, int], vocabulary: dict[bytes, int], total: int):
        self.items = sorted({item for item, _, _ in rows}, key=lambda x: (x is None, x or ""))
        number = {item: k for k, item in enumerate(self.items)}
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
        postings = sorted((vocabulary[term], number[item], asked) for item, term, asked in rows)
        term = np.array([x[0] for x in postings], np.int64)
        self.first = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        self.item = np.array([x[1] for x in postings], np.int64)
        self.weight = np.array([x[2] * weight.get(x[0], 0) for x in postings], np.int64)


class Heaps:
    """The ``top`` best documents of each item: highest score, then least doc_id, documents without one last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)
        self.low = np.zeros(items, np.int64)
        self.worst = np.full(items, np.iinfo(np.int64).max)

    def push(self, item: np.ndarray, doc: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        better = (score > self.low[item]) | ((score == self.low[item]) & (doc < self.worst[item]))
        if not better.any():
            return
        new = [x[better] for x in (item, doc, null, score)]
        item, doc, null, score = (np.concatenate(x) for x in zip((self.item, self.doc, self.null, self.score), new, strict=True))
        order = np.lexsort((null, doc, -score, item))
        item = item[order]
        first = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        order = order[place < self.top]
        self.item, self.doc, self.null, self.score = item[place < self.top], doc[order], null[order], score[order]
        full = place[place < self.top] == self.top - 1
        self.low[self.item[full]], self.worst[self.item[full]] = self.score[full], self.doc[full]


def damping(n: np.ndarray, total: int, length: int) -> np.ndarray:
    """What a document's length, ``n`` of the ``length`` terms of all ``total`` documents, adds to a term's count."""
    if int(n.max(initial=0)) * LENGTH_SHARE * total < 1 << 63:
        share = (LENGTH_SHARE * n * total) // length
    else:
        share = np.array([LENGTH_SHARE * int(x) * total // length for x in n], np.int64)
    return 100 - LENGTH_SHARE + share


def _push_scores(heaps: Heaps, index: ItemIndex, doc: np.ndarray, null: np.ndarray, m: np.ndarray, first: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
    """Score documents by their terms; ``first`` is where each document's begin."""
    postings = index.first[term + 1] - index.first[term]
    sums = np.concatenate(([0], np.cumsum(postings)))
    most = max(1, CELLS // len(index.items))
    for a, b in chunks(sums[first], CELLS):
        for lo in range(a, b, most):
            hi = min(b, lo + most)
            x, y = first[lo], first[hi]
            owner = np.repeat(np.arange(hi - lo), np.diff(first[lo : hi + 1]))
            value = (1_000_000_000 * tf[x:y]) // (1000 * tf[x:y] + 8 * m[lo:hi][owner])
            of = np.repeat(np.arange(y - x), postings[x:y])
            at = index.first[term[x:y]][of] + np.arange(len(of)) - (sums[x:y] - sums[x])[of]
            cells = np.zeros((hi - lo, len(index.items)), np.int64)
            np.add.at(cells.reshape(-1), owner[of] * len(index.items) + index.item[at], index.weight[at] * value[of])
            row, item = np.nonzero(cells >= np.maximum(heaps.low, 1))
            heaps.push(item, doc[lo:hi][row], null[lo:hi][row], cells[row, item])


def _stream(counts: DataFrame, index: ItemIndex, total: int, length: int, top: int) -> DataFrame:
    """(item_id, doc_id, score, part) of each partition's heaps."""
    shared = counts.sparkSession.sparkContext.broadcast(index)
    schema = "item_id string, doc_id bigint, score bigint, part int"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        index = shared.value
        heaps = Heaps(len(index.items), top)
        for batch in batches:
            doc, null = batch.column(0).fill_null(np.iinfo(np.int64).max).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            first = batch.column(2).offsets.to_numpy().astype(np.int64)
            term, tf = (batch.column(k).flatten().to_numpy() for k in (2, 3))
            _push_scores(heaps, index, doc, null, damping(batch.column(1).to_numpy(), total, length), first - first[0], term, tf)
        columns = [pa.array([index.items[k] for k in heaps.item.tolist()], pa.string()), pa.array(heaps.doc, mask=heaps.null), pa.array(heaps.score)]
        columns.append(pa.array(np.full(len(heaps.item), TaskContext.get().partitionId(), np.int32)))
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score", "part"])

    return counts.select("doc_id", "n", "terms", "tfs").filter("size(terms) > 0").mapInArrow(run, schema)


def _merge(heaps: DataFrame, top: int) -> DataFrame:
    """The best of all heaps: of 64 groups of partitions first, so that no task sees an item's heaps of all partitions."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = heaps.withColumn("some", F.col("part") % 64)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "some").orderBy(*order))).filter(F.col("rank") <= top)
    every = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return every.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _blocks(terms: DataFrame, most: int) -> int:
    """Into how many blocks items are dealt so that none has more than ``most`` bytes, or more than the largest item."""
    sizes = terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 16).alias("bytes"))
    n = 1
    while True:
        blocks = sizes.groupBy(F.expr(f"pmod(xxhash64(item_id), {n})")).agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("one"))
        worst = blocks.agg(F.max("bytes").alias("bytes"), F.max("one").alias("one")).first()
        if worst.bytes is None or worst.bytes <= max(most, worst.one):
            return n
        n *= 2


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank int, doc_id, score bigint): the ``top`` documents of highest score, above 0, of each item."""
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType
    docs = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = id_and_text(items, item_col, item_text).select(F.col("doc_id").cast("string").alias("item_id"), "text")
    terms_path = write_table(item_terms(asked), "item-terms")
    terms = spark.read.parquet(terms_path)
    n, found = _blocks(terms, block_bytes), None
    for k in range(n):
        rows = [(r.item_id, bytes(r.term), r.asked) for r in terms.filter(F.expr(f"pmod(xxhash64(item_id), {n})") == k).collect()]
        vocabulary = {term: t for t, term in enumerate(sorted({term for _, term, _ in rows}))}
        counts_path = write_table(document_terms(docs, vocabulary), "term-counts")
        counts = spark.read.parquet(counts_path)
        whole = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = {r.term: r.n for r in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
        best = _merge(_stream(counts, ItemIndex(rows, df, vocabulary, whole.docs), whole.docs, max(1, whole.terms), top), top)
        best = materialize(best, "ranked")
        drop_table(spark, counts_path)
        found = best if found is None else found.unionByName(best)
    drop_table(spark, terms_path)
    return found.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")
