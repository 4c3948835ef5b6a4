"""Language identification by rank-order profiles of character n-grams.

A language's profile is its ``PROFILE`` most frequent n-grams (1 to 3 letters, word ends marked), counted over
every learning document. A document's own most frequent n-grams are compared with each profile: the distance adds
how far each n-gram's rank is out of place, and ``PROFILE`` where the profile lacks it. Ties in frequency go by
the n-gram's code, ties in distance by the language's name.

Null texts and texts without a letter are ``und`` with score 0. Without any learning document all are ``und``.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import text_batches
from .util import id_and_text

PROFILE = 300
STEPS = 1000  # of a score, where floors are learned
END = 1  # stands between words; no letter has this code point


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of the text's words, word ends included."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points = np.where(_letters()[points], points, END)
    points = np.concatenate(([END], points, [END]))
    keep = points != END
    keep[1:] |= points[:-1] != END
    keep[0] = True
    p = points[keep]
    if not (p != END).any():
        return p[:0]
    two = p[:-1] << 21 | p[1:]
    three = two[:-1] << 21 | p[2:]
    return np.concatenate((p[p != END], two, three[p[1:-1] != END]))


def top_ngrams(text: str, most: int = PROFILE) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first."""
    codes, counts = np.unique(ngrams(text), return_counts=True)
    if len(codes) > most:  # ties at the border go by code, so all of them are looked at
        border = np.partition(counts, len(counts) - most)[len(counts) - most]
        near = counts >= border
        codes, counts = codes[near], counts[near]
    return codes[np.lexsort((codes, -counts))][:most]


def learn_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, rank) of every language of ``docs``, from counts over all its rows with text and language."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
            for a, b, texts in text_batches(batch.column(1)):
                by = defaultdict(list)
                for lang, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts, strict=True):
                    by[lang].append(text)
                for lang, own in by.items():
                    held[lang].append(np.unique(ngrams("\n".join(own)), return_counts=True))
            for lang, parts in held.items():
                codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
                names = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(codes), np.int32)))
                yield pa.RecordBatch.from_arrays([names, pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])

    counts = rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PROFILE).drop("n")


class Profiles:
    """Ranks of every profile n-gram in each language; ``PROFILE`` where it is not one."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), PROFILE, np.int32)
        at = {lang: k for k, lang in enumerate(self.langs)}
        where = np.searchsorted(self.grams, [r[1] for r in rows])
        for (lang, _, rank), row in zip(rows, where, strict=True):
            self.ranks[row, at[lang]] = rank - 1

    def distances(self, text: str) -> tuple[int, np.ndarray]:
        """How many n-grams of the text are compared, and its distance from each language."""
        top = top_ngrams(text)
        if not len(self.langs) or not len(top):
            return 0, np.zeros(0, np.int64)
        at = np.searchsorted(self.grams, top)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == top, at, len(self.grams))
        ranks = self.ranks[at]
        out = np.abs(ranks - np.arange(len(top))[:, None])
        out[ranks == PROFILE] = PROFILE
        return len(top), out.sum(0)

    def predict(self, text: str) -> tuple[str, float]:
        """The language of least distance, and 1 less the share that this distance has of the largest possible one."""
        size, distance = self.distances(text)
        if not size:
            return "und", 0.0
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (size * PROFILE))


def predict_language(
    docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, lang_pred, score) for every row. Profiles (``PROFILE`` rows a language) are broadcast."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(Profiles([(r.lang, r.gram, r.rank) for r in profiles.collect()]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for a, b, texts in text_batches(batch.column(1)):
                made = [known.predict(t) for t in texts]
                columns = [
                    batch.column(0).slice(a, b - a).cast(pa.int64()),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def _steps(size: int, distance: np.ndarray) -> np.ndarray:
    """Scores in whole steps of 1 / ``STEPS``, rounded down."""
    return STEPS - -(-STEPS * distance // (size * PROFILE))


def learn_floors(docs: DataFrame, profiles: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(size, floor): the least score, in steps of 1 / ``STEPS``, by which a text is taken to be in a language at all.

    Short texts score higher in languages they are not in, so each size (bits of the number of n-grams) has its own. It is what 99 in
    100 rows of ``docs`` stay below in the best of the languages other than theirs, but no more than what 99 in 100 reach in their own,
    so that texts which can't be told apart stay. With one language there is no floor.
    """
    model = docs.sparkSession.sparkContext.broadcast(Profiles([(r.lang, r.gram, r.rank) for r in profiles.collect()]))
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        at = {lang: k for k, lang in enumerate(known.langs)}
        seen = np.zeros((PROFILE.bit_length() + 1, 2, STEPS + 1), np.int64)
        for batch in batches:
            for a, b, texts in text_batches(batch.column(1)):
                for lang, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts, strict=True):
                    size, distance = known.distances(text)
                    if size and len(at) > 1 and lang in at:
                        steps = _steps(size, distance)
                        seen[size.bit_length(), 1, steps[at[lang]]] += 1
                        seen[size.bit_length(), 0, np.delete(steps, at[lang]).max()] += 1
        where = np.nonzero(seen)
        columns = [*(pa.array(w) for w in where), pa.array(seen[where])]
        yield pa.RecordBatch.from_arrays(columns, ["size", "own", "step", "n"])

    seen = rows.mapInArrow(run, "size bigint, own bigint, step bigint, n bigint").groupBy("size", "own", "step").agg(F.sum("n").alias("n"))
    up = Window.partitionBy("size", "own").orderBy("step")  # at most STEPS + 1 rows each
    seen = seen.withColumn("below", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy("size", "own")))
    other = F.min(F.when((F.col("own") == 0) & (100 * F.col("below") >= 99 * F.col("all")), F.col("step"))) + 1
    own = F.min(F.when((F.col("own") == 1) & (100 * F.col("below") > F.col("all")), F.col("step")))
    return seen.groupBy("size").agg(F.least(other, own).alias("floor"))


def identify_rows(docs: DataFrame, profiles: DataFrame, floors: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text has a language by a score not below its size's floor; ``und`` goes.

    ``floors`` are those of :func:`learn_floors`; sizes without one have none.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(Profiles([(r.lang, r.gram, r.rank) for r in profiles.collect()]))
    least = {} if floors is None else {r["size"]: r["floor"] for r in floors.collect()}
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            keep = []
            for _, _, texts in text_batches(batch.column(at)):
                for size, distance in map(known.distances, texts):
                    keep.append(size > 0 and _steps(size, distance.min()) >= least.get(size.bit_length(), 0))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
