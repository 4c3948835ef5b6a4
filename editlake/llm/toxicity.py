"""Toxicity by logistic regression with FTRL-proximal updates over hashed word n-grams and skip-grams.

Features are words, pairs of neighbours and pairs with one word between, hashed to ``1 << BITS`` places; a
document has a feature or not. Learning rates are per coordinate, and the L1 term leaves few weights other than 0,
which are what is broadcast. Learning takes at most ``MAX_ROWS`` labelled documents, those of least hash of
their id, and of these the first ``MAX_BYTES`` of text: a fixed bound on what one task holds. The L1 term is chosen there, by the loss
on a quarter of these rows after learning from the others. Everything else runs over all rows.

Null and empty texts have no features: their score is the bias alone. Without labels every score is 0.5.
Labels other than 0 and 1, null labels and labels of unknown documents are not used and don't count towards the bound; repeated
labels count once, and of rows that share an id the least text is learned from. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import chunks, id_and_text, mix64, row_of, text_buffers, words

BITS = 20
MAX_ROWS = 16_000
MAX_BYTES = 64 << 20
ALPHA, BETA, L2 = 1.0, 1.0, 0.1
#: L1 terms that are tried, and the one of too few rows to try any.
L1_TRIED, L1 = (0.25, 1.0, 4.0), 1.0
EPOCHS = 8


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, place) of every feature occurrence of consecutive texts, and the number of texts."""
    h, _, _, first = words(data, offsets)
    owner = row_of(first)
    parts = [(owner, h)]
    for gap, salt in ((1, 0xA0761D6478BD642F), (2, 0xE7037ED1A0B428DB)):
        inside = np.flatnonzero(owner[:-gap] == owner[gap:]) if len(h) > gap else np.zeros(0, np.int64)
        parts.append((owner[inside], mix64(h[inside] * np.uint64(salt) + h[inside + gap])))
    places = np.concatenate([p for _, p in parts]) >> np.uint64(64 - BITS)
    return np.concatenate([o for o, _ in parts]), places.astype(np.int64), len(first) - 1


class Ftrl:
    """FTRL-proximal logistic regression; the last place is the bias, which has no L1 term."""

    def __init__(self, l1: float = L1):
        size = (1 << BITS) + 1
        self.z, self.n, self.l1 = np.zeros(size), np.zeros(size), l1

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == 1 << BITS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


Row = tuple[np.ndarray, int]


def fitted(rows: list[Row], l1: float) -> Ftrl:
    """A model that has seen ``rows`` (places, the bias among them; label) ``EPOCHS`` times, each time in another order."""
    order, model = np.random.default_rng(7), Ftrl(l1)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            model.learn(*rows[k])
    return model


def chosen_l1(rows: list[Row]) -> float:
    """The term of least loss on every fourth row, of rows in the order of a hash."""
    kept, asked = [r for k, r in enumerate(rows) if k % 4], rows[::4]
    if min(sum(y for _, y in asked), sum(1 - y for _, y in asked)) < 2:
        return L1
    loss = {}
    for l1 in L1_TRIED:
        model = fitted(kept, l1)
        total = np.array([np.clip(model.weights(at).sum(), -35, 35) for at, _ in asked])
        loss[l1] = np.log1p(np.exp(-total * np.array([2 * y - 1 for _, y in asked]))).sum()
    return min(loss, key=loss.get)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(place, weight) of all weights other than 0 from ``labels`` (doc_id, label) of ``docs`` (doc_id, text)."""
    known = labels.filter("doc_id is not null and label in (0, 1)").select("doc_id", "label").distinct()
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    rows = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Row] = []
        size = 0
        for batch in batches:
            labels_ = batch.column(2).to_pylist()
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                owner, places, n = features(data, offsets[a : b + 1])
                pairs = np.unique(owner << (BITS + 1) | places)
                ends = np.searchsorted(pairs, np.arange(n + 1) << (BITS + 1))
                for k in range(n):
                    if seen and size > max_bytes:
                        break
                    own = pairs[ends[k] : ends[k + 1]] & ((1 << (BITS + 1)) - 1)
                    seen.append((np.append(own, 1 << BITS).astype(np.int32), labels_[a + k]))
                    size += int(offsets[a + k + 1] - offsets[a + k])
        if not seen:
            return
        model = fitted(seen, chosen_l1(seen))
        at = np.arange((1 << BITS) + 1)
        w = model.weights(at)
        at = at[w != 0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["place", "weight"])

    # At most max_rows rows meet here.
    rows = rows.select("doc_id", "text", "label").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label")
    return rows.mapInArrow(run, "place bigint, weight double")


def score(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``, repeated ones included; at most ``(1 << BITS) + 1`` weights are broadcast."""
    found = weights.collect()
    sparse = docs.sparkSession.sparkContext.broadcast(
        (np.array([r.place for r in found], np.int64), np.array([r.weight for r in found], np.float32))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((1 << BITS) + 1, np.float32)
        dense[sparse.value[0]] = sparse.value[1]
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                owner, places, n = features(data, offsets[a : b + 1])
                some = np.flatnonzero(dense[places])
                pairs = np.unique(owner[some] << (BITS + 1) | places[some])
                total = np.bincount(pairs >> (BITS + 1), dense[pairs & ((1 << (BITS + 1)) - 1)], minlength=n)
                p = 1 / (1 + np.exp(-np.clip(total + dense[-1], -35, 35)))
                ids = batch.column(0).slice(a, b - a).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(p.astype(np.float64))], ["doc_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double")
