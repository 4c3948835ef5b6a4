"""Document fingerprints (SimHash) with DataFrame functions only.

Terms are a text's words, runs of characters other than white space, in lower case; a term weighs its number of
characters, 8 at most, at each occurrence. Each term's 64-bit hash votes with its weight on every bit. The votes
are counted two bits to a long, 32 bits apart, so that one pass over the words gives all 64 sums. Searching goes
through permuted block tables: of ``radius + extra`` blocks of bits ``extra`` agree in any pair within ``radius``.

Null and empty texts have fingerprint 0.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import drop_table, id_and_text, materialize, write_table

MOST_WEIGHT = 8
PAIR = (1 << 32) | 1
#: Equal rows that are given back at once.
BLOCK = 1 << 16


def simhash(rows: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """``keys`` of ``rows`` (unique) and a bigint fingerprint for each text column, named as ``texts`` says.

    The words are exploded and their votes summed by key, before any shuffle as far as a task has them; rows that
    are partitioned by one of the keys already aren't shuffled at all.
    """
    names = list(texts)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lower(F.coalesce(c, F.lit(""))).alias("t")) for k, c in enumerate(names)])
    terms = rows.select(*keys, F.explode(kinds).alias("k")).select(
        *keys, F.col("k.kind").alias("kind"), F.explode(F.split("k.t", r"[ \t-\r]+")).alias("term")
    )
    weight = F.least(F.length("term"), F.lit(MOST_WEIGHT)).cast("bigint")
    terms = terms.select(*keys, "kind", F.xxhash64("term").alias("h"), weight.alias("w"))  # an empty word weighs nothing
    h, w = F.col("h"), F.col("w")
    votes = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(PAIR)) * w).alias(f"b{j}") for j in range(32)]
    sums = terms.groupBy(*keys, "kind").agg(*votes, F.sum("w").alias("w"))
    bits = []
    for j in range(32):
        low, high = F.col(f"b{j}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"b{j}"), 32)
        for bit, ones in ((j, low), (j + 32, high)):
            value = (1 << bit) - (1 << 64 if bit == 63 else 0)
            bits.append(F.when(ones * 2 > w, F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    prints = sums.select(*keys, "kind", bits[0].alias("fp"))
    return prints.groupBy(*keys).agg(*[F.max(F.when(F.col("kind") == k, F.col("fp"))).alias(texts[c]) for k, c in enumerate(names)])


def hex16(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """1 less the share of bits that differ."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _tables(fp: Column, radius: int, extra: int) -> list[Column]:
    n = radius + extra
    cuts = [64 * k // n for k in range(n + 1)]
    masks = [sum(1 << b for b in range(cuts[k], cuts[k + 1])) for k in range(n)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [
        F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(signed(sum(masks[k] for k in c)))).alias("key"))
        for t, c in enumerate(combinations(range(n), extra))
    ]


def search(queries: DataFrame, fingerprints: DataFrame, radius: int = 3, extra: int = 3) -> DataFrame:
    """(query_fp, fp, distance): for each different fingerprint of ``queries`` (column fp) all different ones of
    ``fingerprints`` within ``radius`` bits. Copies are left out: join a table of (fp, doc_id) to have them.

    A pair is given by the first table in which it agrees, so that none comes twice. Null fingerprints match nothing.
    """
    q = queries.select("fp").dropna().distinct().select(F.col("fp").alias("query_fp"))
    d = fingerprints.select("fp").dropna().distinct()
    q = q.select("query_fp", F.inline(F.array(*_tables(F.col("query_fp"), radius, extra))))
    d = d.select("fp", F.inline(F.array(*_tables(F.col("fp"), radius, extra))))
    near = q.join(d, ["t", "key"]).withColumn("distance", F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp"))))
    near = near.filter(F.col("distance") <= radius)
    agree = [
        F.when(a["key"] == b["key"], F.lit(t))
        for t, (a, b) in enumerate(
            zip(_tables(F.col("query_fp"), radius, extra), _tables(F.col("fp"), radius, extra), strict=True)
        )
    ]
    return near.filter(F.col("t") == F.coalesce(*agree)).select("query_fp", "fp", "distance")


def near_counts(queries: DataFrame, fingerprints: DataFrame, radius: int = 3) -> DataFrame:
    """(query_fp, n_near): for each different fingerprint of ``queries`` (fp) how many rows of ``fingerprints`` (fp) are within ``radius`` bits."""
    sizes = fingerprints.dropna(subset=["fp"]).groupBy("fp").agg(F.count("*").alias("n"))
    return search(queries, fingerprints, radius).join(sizes, "fp").groupBy("query_fp").agg(F.sum("n").alias("n_near"))


def following(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` (columns ``key``, unique and not null, and others) with next: a struct of the key before it in ascending order; the least
    key has the greatest as next.

    Rows are ordered by ranges, in as many partitions as shuffles have, and numbered by partition; each partition's greatest key goes to the
    one before it. Both steps are written, so that a lost executor can't move a range's bounds.
    """
    spark = rows.sparkSession
    down = [F.desc(c) for c in key]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = write_table(rows.repartitionByRange(parts, *down).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    ranged = spark.read.parquet(path)
    across = Window.orderBy("part")  # a row a partition
    tops = ranged.groupBy("part").agg(F.max(F.struct(*key)).alias("top"))
    tops = tops.select("part", F.coalesce(F.lead("top").over(across), F.first("top").over(across)).alias("after"))
    inside = F.lead(F.struct(*key)).over(Window.partitionBy("part").orderBy(*down))
    out = ranged.withColumn("next", inside).join(tops, "part").withColumn("next", F.coalesce("next", "after")).drop("part", "after")
    out = materialize(out, "fingerprint-next")
    drop_table(spark, path)
    return out


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp.

    The edited text has its last half replaced by the next text's beginning; next is by descending doc_id and the first
    after the last. Rows of one doc_id are in descending order of their texts' hashes (96 bits), rows without doc_id come after all others. A
    table of one row has itself as next; an empty one gives no rows. Of wholly equal rows all but one have an equal row as next; they are
    one row until the end, so that no key is hot. Only keys are ordered; each text is shuffled once, and the beginning that
    its predecessor asks for once more.
    """
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Flat columns without nulls: joins and sums by them share one shuffle.
    key = ["known", "id", "own", "check"]
    own = [F.xxhash64("text").alias("own"), F.hash("text").alias("check")]
    rows = rows.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"), *own, "text")
    half = F.expr("cast(n_chars div 2 as int)")
    links = following(rows.groupBy(*key).agg(F.count("*").alias("n"), F.max(F.length("text")).cast("bigint").alias("n_chars")), key)
    texts = rows.groupBy(*key).agg(F.min("text").alias("text"))
    asked = links.select("next.*", F.struct(*key).alias("by"), half.alias("half"))
    sent = texts.join(asked, key).select("by.*", F.left("text", F.col("half")).alias("begin"))
    rows = texts.join(links.drop("next"), key).join(sent, key)
    stays = F.left("text", (F.col("n_chars") - half).cast("int"))
    copied = F.when(F.col("n") > 1, F.concat(stays, F.left("text", half)))  # the edited text of rows with an equal row as next
    rows = rows.select(*key, "n", "n_chars", "text", F.concat(stays, "begin").alias("edited"), copied.alias("copied"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    rows = rows.withColumns({"edited_sha256": digest("edited"), "copied_sha256": digest("copied")})
    keys = [*key, "n", "n_chars", "edited_sha256", "copied_sha256"]
    prints = materialize(simhash(rows, keys, {"text": "fp", "edited": "edited_fp", "copied": "copied_fp"}), "fingerprint-texts")
    asked = links.select("next.*", F.struct(*key).alias("by"))
    after = prints.select(*key, F.col("fp").alias("next_fp")).join(asked, key).select("by.*", "next_fp")
    out = prints.join(after, key).withColumn("doc_id", F.when(F.col("known"), F.col("id")))
    kinds = F.array(
        F.struct(F.lit(1).cast("bigint").alias("times"), "edited_sha256", "edited_fp", "next_fp"),
        F.struct(
            (F.col("n") - 1).alias("times"),
            F.col("copied_sha256").alias("edited_sha256"),
            F.col("copied_fp").alias("edited_fp"),
            F.col("fp").alias("next_fp"),
        ),
    )
    out = out.select("doc_id", "n_chars", "fp", F.inline(kinds)).filter("times > 0")
    # Copies come back in blocks, so that no array grows with their number.
    out = out.withColumn("block", F.explode(F.expr(f"sequence(0, (times - 1) div {BLOCK})")))
    out = out.withColumn("copy", F.explode(F.expr(f"sequence(1, least({BLOCK}, times - block * {BLOCK}))")))
    return out.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row of ``docs``."""
    rows = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return simhash(rows, ["doc_id", "row"], {"text": "fp"}).select("doc_id", "fp")
