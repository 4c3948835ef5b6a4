"""Document scores by masked pseudo-likelihood.

A small network predicts every word from the two words on either side: each of the four places has an embedding
table; their sum goes through tanh to two softmax layers, one for the word's group and one for its place in the
group. The most frequent ``VOCAB - RARE`` words of the whole corpus are words of their own, all others share ``RARE``
hashed classes. The rows are dealt to shards of about ``SHARD_WORDS`` words by a hash of id and text; each shard trains a copy from the
same start over all its words, in the order of that hash, in numpy with Adagrad; the copies are averaged, weighted by their
words. So the scores don't depend on how the input is partitioned. A word of a shared class has the network's probability of the class
times its own share of the class, from counts of all the corpus's words; these stay distributed and are joined.
A document's score is the sum of its words' log-probabilities.

Null and empty texts have no words, score 0 and a null mean. An untrained model (empty corpus) is the start. Rows without id
are scored like others; repeated rows are trained on again and have one score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import chunks, id_and_text, materialize, per_row, row_of, text_buffers, words

GROUP = 32
VOCAB, RARE, DIM = GROUP * GROUP, 64, 16
PLACES = (-2, -1, 1, 2)
BATCH, RATE = 4096, 0.1
#: Words of a shard, and words after which a shard's rows so far are trained on.
SHARD_WORDS, UNIT_WORDS = 1_000_000, 1 << 20
#: Tasks that sum up the shards' copies; the driver gets their sums.
SUMS = 16
#: Logs of shares are summed as whole multiples of 1 / UNIT, in any order.
UNIT = 1 << 30
SHAPES = {"e": (len(PLACES), VOCAB + 1, DIM), "u": (DIM, 2 * GROUP), "b": (2 * GROUP,), "g": (GROUP, GROUP)}


def start_parameters() -> dict[str, np.ndarray]:
    """The same start for every copy."""
    rng = np.random.default_rng(11)
    return {k: (rng.standard_normal(s) * (0.1 if k in "eu" else 0)).astype(np.float32) for k, s in SHAPES.items()}


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): how often each word (as a hash) stands in the whole corpus."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for a, b in chunks(offsets, 8 << 20):
                word, n = np.unique(words(data, offsets[a : b + 1])[0].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])

    counts = docs.select(text_col).mapInArrow(run, "word bigint, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Class numbers of words: frequent ones by rank, rare ones hashed."""

    def __init__(self, ranked: list[int]):
        by_word = np.argsort(np.array(ranked, np.int64))
        self.words, self.ids = np.array(ranked, np.int64)[by_word], by_word

    def of(self, hashes: np.ndarray) -> np.ndarray:
        rare = VOCAB - RARE + (hashes & np.uint64(RARE - 1)).astype(np.int64)
        if not len(self.words):
            return rare
        signed = hashes.view(np.int64)
        at = np.minimum(np.searchsorted(self.words, signed), len(self.words) - 1)
        return np.where(self.words[at] == signed, self.ids[at], rare)


def rare_shares(counts: DataFrame, head: list) -> DataFrame:
    """(word, share): the log of each word's share of its class, in units of 1 / UNIT, for all words of ``counts``
    but those of ``head`` (its first rows by falling count)."""
    if len(head) < VOCAB - RARE:
        return counts.limit(0).select("word", F.lit(0).cast("bigint").alias("share"))
    word, n, last = F.col("word"), F.col("n"), head[-1]
    rare = counts.filter((n < last.n) | ((n == last.n) & (word > last.word)))
    rare = rare.withColumn("class", word.bitwiseAND(F.lit(RARE - 1)))
    totals = {r["class"]: r.n for r in rare.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    logs = F.array(*[F.lit(float(np.log(totals.get(k, 1)))) for k in range(RARE)])
    share = F.round((F.ln("n") - F.get(logs, F.col("class").cast("int"))) * UNIT).cast("bigint")
    return rare.select("word", share.alias("share"))


def rare_words(docs: DataFrame, ranked: list[int]) -> DataFrame:
    """(doc_id, text_key, word, n): the words of each row of ``docs`` (doc_id, text, text_key) that are not ``ranked``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(ranked)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                h, _, _, first = words(data, offsets[a : b + 1])
                rare = vocab.of(h) >= VOCAB - RARE
                word, row = h[rare].view(np.int64), row_of(first)[rare]
                order = np.lexsort((word, row))
                word, row = word[order], row[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                place = pa.array(row[at] + a)
                columns = [batch.column(0).cast(pa.int64()).take(place), batch.column(2).take(place)]
                columns += [pa.array(word[at]), pa.array(np.diff(np.append(at, len(word))))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "word", "n"])

    return docs.mapInArrow(run, "doc_id bigint, text_key bigint, word bigint, n bigint")


def contexts(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class numbers at the four places around each word; VOCAB beyond a text's ends."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full((len(PLACES), len(ids)), VOCAB, np.int64)
    for k, d in enumerate(PLACES):
        if len(ids) > abs(d):
            here, there = (slice(-d, None), slice(None, d)) if d < 0 else (slice(None, -d), slice(d, None))
            same = owner[here] == owner[there]
            out[k, here] = np.where(same, ids[there], VOCAB)
    return out


def forward(p: dict[str, np.ndarray], ctx: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hidden layer, probabilities of groups and of places in the true group, log-probabilities of ``ids``."""
    hidden = np.tanh(sum(p["e"][k][ctx[k]] for k in range(len(PLACES))))
    out = hidden @ p["u"] + p["b"]
    group = ids // GROUP
    out[:, GROUP:] += p["g"][group]
    at = np.arange(len(ids))
    log = np.zeros(len(ids), np.float64)
    for low, true in ((0, group), (GROUP, ids % GROUP)):
        part = out[:, low : low + GROUP]
        part -= part.max(1, keepdims=True)
        chosen = part[at, true].astype(np.float64)
        np.exp(part, out=part)
        total = part.sum(1, keepdims=True)
        log += chosen - np.log(total[:, 0])
        part /= total
    return hidden, out, log


def train_step(p: dict, seen: dict, ctx: np.ndarray, ids: np.ndarray) -> float:
    """One Adagrad step on a batch; the mean log-probability before it."""
    hidden, out, log = forward(p, ctx, ids)
    n, at = len(ids), np.arange(len(ids))
    out[at, ids // GROUP] -= 1
    out[at, GROUP + ids % GROUP] -= 1
    out /= np.float32(n)
    grad = {"u": hidden.T @ out, "b": out.sum(0), "g": np.zeros(SHAPES["g"], np.float32)}
    for j in range(GROUP):
        grad["g"][:, j] = np.bincount(ids // GROUP, out[:, GROUP + j], minlength=GROUP)
    back = (out @ p["u"].T) * (1 - hidden * hidden)
    grad["e"] = np.empty(SHAPES["e"], np.float32)
    for k in range(len(PLACES)):
        for j in range(DIM):
            grad["e"][k, :, j] = np.bincount(ctx[k], back[:, j], minlength=VOCAB + 1)
    for k, g in grad.items():
        seen[k] += g * g
        p[k] -= np.float32(RATE) * g / (np.sqrt(seen[k]) + np.float32(1e-6))
    return float(log.mean())


def flatten(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def coded(docs: DataFrame, vocabulary: list[int]) -> DataFrame:
    """(own, ids): the class numbers of the words of each row of ``docs`` (own, text) that has words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(vocabulary)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                h, _, _, first = words(data, offsets[a : b + 1])
                raw, ends = vocab.of(h).astype("<u2").tobytes(), (2 * first).tolist()
                some = np.flatnonzero(np.diff(first))
                rows = pa.array([raw[ends[k] : ends[k + 1]] for k in some.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a + some)), rows], ["own", "ids"])

    return docs.select("own", "text").mapInArrow(run, "own bigint, ids binary")


def trained(texts: Iterable[bytes]) -> tuple[np.ndarray, int]:
    """The parameters of a copy, flat, and the words of the texts (class numbers) that it saw, one after the other."""
    p, total = start_parameters(), 0
    seen = {k: np.full(s, 1e-8, np.float32) for k, s in SHAPES.items()}
    held: list[bytes] = []
    size = 0

    def learn() -> None:
        ids = np.frombuffer(b"".join(held), "<u2").astype(np.int64)
        first = np.concatenate(([0], np.cumsum([len(x) // 2 for x in held])))
        ctx = contexts(ids, first)
        for at in range(0, len(ids), BATCH):
            train_step(p, seen, ctx[:, at : at + BATCH], ids[at : at + BATCH])

    for text in texts:
        held.append(text)
        size += len(text) // 2
        if size >= UNIT_WORDS:
            learn()
            total, size, held = total + size, 0, []
    if held:
        learn()
    return flatten(p), total + size


def train(docs: DataFrame, vocabulary: list[int], n_words: int) -> np.ndarray:
    """The averaged parameters, from copies trained over every shard of ``docs`` (own, text)."""
    shards = max(1, -(-n_words // SHARD_WORDS))
    rows = coded(docs, vocabulary).withColumn("shard", F.pmod("own", F.lit(shards)))
    rows = rows.repartition("shard").sortWithinPartitions("shard", "own", "ids").select("shard", "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = ((k, x) for b in batches for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for shard, own in groupby(every, key=itemgetter(0)):
            flat, n = trained(x for _, x in own)
            columns = [pa.array([shard]), pa.array([flat.astype("<f4").tobytes()], pa.binary()), pa.array([n])]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "flat", "n"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for batch in batches:
            for flat, k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                total, n = total + np.frombuffer(flat, "<f4").astype(np.float64) * k, n + k
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n])], ["flat", "n"])

    copies = rows.mapInArrow(run, "shard bigint, flat binary, n bigint")
    sums = copies.repartition(SUMS, "shard").mapInArrow(add, "flat binary, n bigint").collect()
    if not sums:
        return flatten(start_parameters()).astype(np.float64)
    return sum(np.frombuffer(r.flat, np.float64) for r in sums) / sum(r.n for r in sums)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, log_likelihood, mean_log_likelihood.

    The driver holds the ``VOCAB - RARE`` most frequent words and the parameters, both of fixed size; the counts of
    all other words are joined to the documents' words. Rows of one doc_id and text have one score.
    """
    docs = id_and_text(docs, id_col, text_col)
    counts = materialize(word_counts(docs), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCAB - RARE).collect()
    ranked = [r.word for r in top]
    n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    flat = train(docs.select(F.xxhash64("doc_id", "text").alias("own"), "text"), ranked, n_words)
    model = docs.sparkSession.sparkContext.broadcast((ranked, flat))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, p = Vocabulary(model.value[0]), unflatten(model.value[1])
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                h, _, _, first = words(data, offsets[a : b + 1])
                ids = vocab.of(h)
                ctx = contexts(ids, first)
                log = np.zeros(len(ids))
                for at in range(0, len(ids), BATCH):
                    log[at : at + BATCH] = forward(p, ctx[:, at : at + BATCH], ids[at : at + BATCH])[2]
                columns = [batch.column(0).slice(a, b - a).cast(pa.int64()), batch.column(2).slice(a, b - a)]
                columns += [pa.array(np.diff(first)), pa.array(per_row(first, log))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_words", "log"])

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    none = F.lit(0).cast("bigint")
    scored = keyed.mapInArrow(run, "doc_id bigint, text_key bigint, n_words bigint, log double")
    scored = scored.select("doc_id", "text_key", "n_words", "log", none.alias("share"), (none + 1).alias("copies"))
    shares = rare_words(keyed, ranked).join(rare_shares(counts, top), "word").select(
        "doc_id",
        "text_key",
        none.alias("n_words"),
        F.lit(None).cast("double").alias("log"),
        (F.col("n") * F.col("share")).alias("share"),
        none.alias("copies"),
    )
    both = scored.unionByName(shares).groupBy("doc_id", "text_key")
    both = both.agg(*[f(k).alias(k) for f, k in ((F.max, "n_words"), (F.max, "log"), (F.sum, "share"), (F.sum, "copies"))])
    total = F.col("log") + F.col("share") / F.col("copies") / UNIT
    both = both.select("doc_id", "n_words", total.alias("total"), F.explode(F.sequence(none + 1, "copies")))
    mean = F.when(F.col("n_words") > 0, F.col("total") / F.col("n_words"))
    return both.select("doc_id", "n_words", F.col("total").alias("log_likelihood"), mean.alias("mean_log_likelihood"))
