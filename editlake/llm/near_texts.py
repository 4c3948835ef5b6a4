"""Near-copies by shingle similarity: SimHash fingerprints propose pairs, the shingles themselves decide.

A text is the set of its different ``size``-word shingles; two texts are near if their sets have a Jaccard similarity of
``similarity`` or more. The SimHash of a whole set, compared by the trie self-join, finds pairs that differ in few words
only: at a similarity of 0.8 two fingerprints differ in about 10 of 64 bits, and a trie join with that error budget prunes
next to nothing. So pairs are proposed by two means:

* the trie self-join of whole-set fingerprints within ``radius`` bits;
* fingerprints of ``SAMPLES`` small samples of the set. A sample holds, for each of ``PICKS`` orders of all hashes, the
  set's first shingle, so that two texts have the same sample, and then the same fingerprint, with a chance of about
  similarity ** PICKS. At least one of the samples agrees in 0.998 of all pairs of similarity 0.8.

Texts with one fingerprint of a sample are a group, and every two texts of a group are compared unless they are of one component before.
First each group's leader, the one that meets most others in its groups, is compared with all others; copies of one text are one component
then. In the groups that still hold several components those outside of the largest meet all the group: the shingles of some hundred texts
are a block, and a task gets two blocks, counts what all their texts share at once, and gives back no more links than texts. Before that a bound
leaves out texts that can be near to none: of the texts still apart the shingles that no other has are counted, and a set with more than
1 - similarity of its shingles for itself alone is near to no other. Equal sets are compared once. Near pairs are links, and linked texts
are one component.

Texts without words are near only to texts equal to them. Null texts count as empty. The component of a row without id is
that of the rows with its set, null if none of these has an id. Repeated rows get equal results. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import read_components, write_components
from .simhash_trie import links
from .util import chunks, drop_table, id_and_text, mix64, shingles, text_buffers, write_table

SIZE, SIMILARITY, RADIUS = 5, 0.8, 3
SAMPLES, PICKS = 16, 5
#: Shingles of a block, if one text has no more.
BLOCK = 1 << 18


def _majority(h: np.ndarray) -> np.ndarray:
    """Bits that are set in three or more of five hashes; ``h`` is (5, n)."""
    a, b, c, d, e = h
    one, two = a ^ b ^ c, (a & b) | (a & c) | (b & c)
    return (two & (one | d | e)) | (one & d & e)


def samples(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(SAMPLES, texts): SimHash fingerprints of the samples of each text's shingles; a text has at least one."""
    out = np.empty((SAMPLES, len(starts)), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(SAMPLES):
            picked = np.empty((PICKS, len(starts)), np.uint64)
            for j in range(PICKS):
                factor = int(mix64(np.array([t * PICKS + j + 1], np.uint64))[0]) | 1
                least = np.minimum.reduceat(value * np.uint64(factor), starts)
                picked[j] = least * np.uint64(pow(factor, -1, 1 << 64))
            out[t] = _majority(picked)
    return out


def whole_prints(text: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The SimHash of each text's whole set: a bit is set if it is in more than half of the hashes."""
    counts = np.zeros((len(starts), 64), np.int64)
    step = 1 << 14
    for a in range(0, len(value), step):
        part = value[a : a + step].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1)
        own = text[a : a + step]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        at = np.searchsorted(starts, first + a, side="right") - 1
        counts[at] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    sizes = np.diff(np.append(starts, len(value)))
    return np.packbits(2 * counts > sizes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


#: Makes a second hash of a shingle's.
OTHER = np.uint64(0x2545F4914F6CDD1D)


def _binary(values: np.ndarray) -> pa.Array:
    """A binary value of each row."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * (values.itemsize * values.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, own, fp, samples) for each row of ``docs`` (doc_id, text). own, of 128 bits, tells sets apart, and texts without words;
    the latter have null fp and samples."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                text, value = shingles(data, offsets[a : b + 1], size)
                starts = np.flatnonzero(np.diff(text, prepend=-1))
                has = np.zeros(b - a, bool)
                has[text] = True
                own, fp, sample = np.zeros((b - a, 2), np.uint64), np.zeros(b - a, np.uint64), np.zeros((b - a, SAMPLES), np.uint64)
                if len(starts):
                    own[has, 0] = np.add.reduceat(mix64(value), starts)
                    own[has, 1] = np.add.reduceat(mix64(value ^ OTHER), starts)
                    fp[has] = whole_prints(text, value, starts)
                    sample[has] = samples(value, starts).T
                for k in np.flatnonzero(~has).tolist():
                    digest = xxhash.xxh3_128_digest(data[offsets[a + k] : offsets[a + k + 1]].tobytes())
                    own[k] = np.frombuffer(digest, np.uint64)
                offs = pa.array(np.arange(b - a + 1, dtype=np.int32) * SAMPLES)
                columns = [batch.column(0).slice(a, b - a), _binary(own), pa.array(fp.view(np.int64), mask=~has)]
                columns.append(pa.ListArray.from_arrays(offs, pa.array(sample.view(np.int64).ravel()), mask=pa.array(~has)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "own", "fp", "samples"])

    return docs.mapInArrow(run, "doc_id bigint, own binary, fp bigint, samples array<bigint>")


def similar(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The rows (u, v) of ``pairs`` whose ``texts`` (id, text; one row an id) are near; others have ok = false."""
    left = texts.select(F.col("id").alias("u"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("v"), F.col("text").alias("right"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = text_buffers(batch.column(2)), text_buffers(batch.column(3))
            both = one[1] + two[1] - two[1][0]
            for a, b in chunks(both):
                sets = [shingles(data, offs[a : b + 1], size) for data, offs in (one, two)]
                text, value = (np.concatenate(x) for x in zip(*sets, strict=True))
                order = np.lexsort((value, text))
                text, value = text[order], value[order]
                shared = (text[1:] == text[:-1]) & (value[1:] == value[:-1])
                inter = np.bincount(text[1:][shared], minlength=b - a)
                union = np.bincount(text, minlength=b - a) - inter
                ok = pa.array(inter >= similarity * union - 1e-9)
                columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), ok]
                yield pa.RecordBatch.from_arrays(columns, ["u", "v", "ok"])

    joined = pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right")
    return joined.mapInArrow(run, "u bigint, v bigint, ok boolean")


def _groups(members: DataFrame) -> DataFrame:
    """(g, id, weight) of the groups of ``members`` (g, id) with several members. weight is how many an id meets in all its groups: an
    original meets more than its edited copies do."""
    sizes = members.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1")
    members = members.join(sizes, "g")
    return members.join(members.groupBy("id").agg(F.sum("n").alias("weight")), "id").select("g", "id", "weight")


def _with_labels(groups: DataFrame, found: DataFrame) -> DataFrame:
    """``groups`` (g, id, ...) with each id's component as label; only the groups that hold several."""
    rows = groups.join(found, groups.id == found.vertex, "left").withColumn("label", F.coalesce("component", "id")).drop("vertex", "component")
    apart = rows.groupBy("g").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    return rows.join(apart.select("g"), "g")


def _apart_sets(groups: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(id, shingles array<bigint>, ascending) of the ids of ``groups``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                text, value = shingles(data, offsets[a : b + 1], size)
                offs = pa.array(np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32))
                sets = pa.ListArray.from_arrays(offs, pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), sets], ["id", "shingles"])

    asked = texts.join(groups.select("id").distinct(), "id", "left_semi").select("id", "text")
    return asked.mapInArrow(run, "id bigint, shingles array<bigint>")


def _may_be_near(sets: DataFrame, similarity: float) -> DataFrame:
    """The ids of ``sets`` with no more than 1 - similarity of their shingles in no other of ``sets``."""
    once = sets.select("id", F.explode("shingles").alias("h")).groupBy("h").agg(F.count("*").alias("k"), F.min("id").alias("id")).filter("k = 1")
    own = sets.select("id", F.size("shingles").alias("n")).join(once.groupBy("id").agg(F.count("*").alias("own")), "id", "left")
    return own.filter(F.coalesce("own", F.lit(0)) <= (1 - similarity) * F.col("n") + 1e-9).select("id")


def _leaders(groups: DataFrame) -> DataFrame:
    """(g, id) of each group's leader, its member of most weight."""
    lead = groups.groupBy("g").agg(F.max(F.struct("weight", F.xxhash64("id"), "id")).alias("m"))
    return lead.select("g", F.col("m.id").alias("id"))


def _pairs(leaders: DataFrame, groups: DataFrame) -> DataFrame:
    """(u, v), u < v: each leader with those of its group that are of other components."""
    lead = leaders.join(groups, ["g", "id"]).select("g", F.col("id").alias("leader"), F.col("label").alias("leader_label"))
    rows = groups.join(lead, "g").filter("label <> leader_label")
    return rows.select(F.least("id", "leader").alias("u"), F.greatest("id", "leader").alias("v")).distinct()


def _blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(g, block, ids, labels, shingles): the members (g, id, label) of each group in blocks of about BLOCK shingles."""
    rows = members.join(sets, "id")
    parts = rows.groupBy("g").agg(F.ceil(F.sum(F.size("shingles")) / BLOCK).cast("int").alias("parts"))
    rows = rows.join(parts, "g").withColumn("block", F.expr("pmod(xxhash64(id), parts)"))
    held = rows.groupBy("g", "block").agg(F.collect_list(F.struct("id", "label", "shingles")).alias("m"))
    return held.select("g", "block", F.col("m.id").alias("ids"), F.col("m.label").alias("labels"), F.col("m.shingles").alias("shingles"))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """(left, right): how many hashes each two sets share."""
    out = np.zeros((len(left), len(right)), np.float32)
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for a in range(0, len(both), 1 << 12):
        part = both[a : a + (1 << 12)]
        sides = []
        for sets in (left, right):
            every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            at = np.minimum(np.searchsorted(part, every), len(part) - 1)
            inside = part[at] == every
            side = np.zeros((len(sets), len(part)), np.float32)
            side[owner[inside], at[inside]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """Edges that link the same as all edges (u, v), no more than there are vertices."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    out = []
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((min(a, b), max(a, b)))
    return out


def _met(groups: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(u, v), u < v: links between near members of ``groups`` (g, id, label) of different labels."""
    largest = groups.groupBy("g", "label").agg(F.count("*").alias("n")).groupBy("g").agg(F.max(F.struct("n", "label")).alias("m"))
    few = groups.join(largest.select("g", F.col("m.label").alias("largest")), "g").filter("label <> largest").select("g", "id", "label")
    left = _blocks(few, sets).select("g", *[F.col(c).alias(f"left_{c}") for c in ("ids", "labels", "shingles")])
    both = left.join(_blocks(groups.select("g", "id", "label"), sets).drop("block"), "g").drop("g")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sides = []
                for ids, labels, values in ((0, 1, 2), (3, 4, 5)):
                    held = batch.column(values)[k].values
                    offs, flat = held.offsets.to_numpy(), held.values.to_numpy()
                    sets_of = [flat[a:b] for a, b in zip(offs, offs[1:], strict=False)]
                    sides.append((batch.column(ids)[k].values.to_numpy(), batch.column(labels)[k].values.to_numpy(), sets_of))
                (u, u_label, one), (v, v_label, two) = sides
                shared = shared_counts(one, two)
                union = np.array([len(x) for x in one])[:, None] + np.array([len(x) for x in two]) - shared
                near = (shared >= similarity * union - 1e-9) & (u_label[:, None] != v_label)
                a, b = np.nonzero(near)
                links_ = np.array(_forest(u[a], v[b]), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(links_[:, 0]), pa.array(links_[:, 1])], ["u", "v"])

    return both.mapInArrow(run, "u bigint, v bigint")


def near_texts(
    docs: DataFrame, size: int = SIZE, similarity: float = SIMILARITY, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs``: the least id linked to the row's, itself included.

    Rows that share an id are one component; of their texts the least is the one that others are compared with.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    paths: list[str] = []

    def table(df: DataFrame, label: str) -> DataFrame:
        paths.append(write_table(df, label))
        return spark.read.parquet(paths[-1])

    rows = table(sketches(docs, size), "sketches")
    sets = rows.filter("doc_id is not null").groupBy("own").agg(
        F.min("doc_id").alias("id"), F.first("fp").alias("fp"), F.first("samples").alias("samples")
    )
    sets = table(sets, "sets")
    several_sets = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("own").alias("a"), F.max("own").alias("b")).filter("a <> b")
    several_sets = rows.join(several_sets.select("doc_id"), "doc_id").join(sets.select("own", "id"), "own")
    one_id = several_sets.select(F.least("doc_id", "id").alias("u"), F.greatest("doc_id", "id").alias("v")).filter("u <> v")

    grouped = sets.select("id", F.posexplode("samples").alias("t", "s")).select("id", F.xxhash64("t", "s").alias("g")).distinct()
    groups = table(_groups(grouped), "groups")
    prints = table(sets.filter("fp is not null").groupBy("fp").agg(F.min("id").alias("rep")), "prints")
    same = sets.join(prints, "fp").filter("id <> rep").select(F.col("rep").alias("u"), F.col("id").alias("v"))
    near = links(prints, radius).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    near = table(near.unionByName(same), "trie-links")

    asked = groups.select("id").unionByName(near.select(F.col("u").alias("id"))).unionByName(near.select(F.col("v").alias("id")))
    texts = docs.withColumnRenamed("doc_id", "id").join(asked.distinct(), "id", "left_semi")
    texts = table(texts.groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "texts")
    one_id = table(one_id, "one-id")
    known = table(similar(near.distinct(), texts, size, similarity), "judged")

    def linked(edges: DataFrame) -> DataFrame:
        paths.append(write_components(edges))
        return read_components(spark, paths[-1])

    links_ = known.filter("ok").select("u", "v").unionByName(one_id)
    groups = table(_with_labels(groups, linked(links_)), "apart")
    lead = table(_leaders(groups), "leaders")
    pairs = _pairs(lead, groups).join(known, ["u", "v"], "left_anti")
    judged = table(similar(pairs, texts, size, similarity), "judged")
    links_ = links_.unionByName(judged.filter("ok").select("u", "v"))
    found = linked(links_)
    groups = groups.join(lead, ["g", "id"], "left_anti").select("g", "id")
    groups = table(_with_labels(groups, found), "still-apart")
    if not groups.isEmpty():
        values = table(_apart_sets(groups, texts, size), "shingles")
        groups = groups.join(_may_be_near(values, similarity), "id").select("g", "id")
        groups = table(_with_labels(groups, found), "bounded")
        found = linked(links_.unionByName(table(_met(groups, values, similarity), "met")))
    named = sets.join(found, sets.id == found.vertex, "left").select("own", F.coalesce("component", "id").alias("component_id"))
    named = spark.read.parquet(write_table(rows.join(named, "own", "left").select("doc_id", "component_id"), "components"))
    for path in paths:
        drop_table(spark, path)
    return named
