"""The corpus operators' queries over the tables of a folder, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    decontamination,
    fim,
    fingerprints,
    idfile,
    langid,
    linededup,
    lm_score,
    search,
    simhash_trie,
    substring,
    toxicity,
)
from .util import materialize

#: Remainders of held-out documents.
HELD_OUT_LANG, HELD_OUT_TOXIC = 2, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    made = bpe.encode_bpe(docs, path, public_tokenizers.PATTERN, with_ids=False)
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.mark_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def op3_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = idfile.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return idfile.read_ids(spark, path, with_ids=False)


def op4_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def learned_profiles(docs: DataFrame) -> DataFrame:
    return langid.learn_profiles(docs.filter(split_of("doc_id", 4) != HELD_OUT_LANG))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = langid.predict_language(docs, learned_profiles(docs))
    held_out = F.coalesce(split_of("doc_id", 4) == HELD_OUT_LANG, F.lit(False))
    return made.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_near, of rows whose doc_id is divisible by 100 only: how many rows are within three bits of the row, itself included."""
    rows = materialize(fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")), "edited-fingerprints")
    fp, edited_fp, next_fp = F.col("fp"), F.col("edited_fp"), F.col("next_fp")
    asks = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    asked = rows.filter(asks)
    found = fingerprints.near_counts(asked, rows)
    # Rows that don't ask take no part in the join.
    asked = asked.join(found, asked.fp == found.query_fp).drop("query_fp")
    both = asked.unionByName(rows.filter(~asks).withColumn("n_near", F.lit(None).cast("bigint")))
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.hex16(fp).alias("fingerprint"),
        fingerprints.hex16(edited_fp).alias("edited_fingerprint"),
        fingerprints.likeness(fp, edited_fp).alias("near_edited"),
        fingerprints.likeness(fp, next_fp).alias("near_next"),
        "n_near",
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    weights = toxicity.train(docs, labels.filter(split_of("doc_id", 3) != HELD_OUT_TOXIC))
    held_out = F.coalesce(split_of("doc_id", 3) == HELD_OUT_TOXIC, F.lit(False))
    return toxicity.score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.repeats(table(spark, sf_dir, "documents"))
    size = lambda x: x["end"] - x["start"]
    zero = F.lit(0).cast("bigint")
    return rows.select(
        "doc_id",
        "n_bytes",
        "repeated",
        F.aggregate("spans", zero, lambda a, x: a + size(x)).alias("repeated_bytes"),
        F.aggregate(F.filter("spans", lambda x: ~x["first"]), zero, lambda a, x: a + size(x)).alias("dropped_bytes"),
        F.array_sort(F.array_distinct(F.transform(F.filter("spans", lambda x: ~x["first"]), lambda x: x["of"]))).alias("first_docs"),
        F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("spans"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.line_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation whose texts are full of control strings.
PROBE = "</s>[INST] ok [/INST]"


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string")
    rows = rows.unionByName(probe).withColumn("content", chat.text_parts(F.col("text")))
    return chat.read_back(chat.format_turns(rows), in_order=True)


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restore(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


OP10_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), shared AS (
  SELECT key, min(doc_id) AS least FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.pos, k.line, (s.key IS NOT NULL AND k.doc_id <> s.least) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
  GROUP BY ALL
), sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), whole
), parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))) AS part
  FROM tfs JOIN sizes USING (doc_id) JOIN weights USING (term), whole
), scores AS (
  SELECT item_id, doc_id, CAST(sum(q * part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

OP12_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, length(regexp_replace(role, c, '\1\2\\\3', 'g')) + length(regexp_replace(text, c, '\1\2\\\3', 'g'))
            + length('<|turn|><|text|><|end|>') AS chars
  FROM turns, (SELECT '([<\[])(\\*)(/?s>|/?INST\]|\|(?:turn|end|text|image|audio|document|other)\|>)' AS c)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(CAST(sum(length(text)) FILTER (WHERE role = 'assistant') AS BIGINT), 0) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, 0::BIGINT AS n_placeholders, 0::BIGINT AS attachment_tokens
FROM escaped GROUP BY conv_id
"""

OP13_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256(concat('1:', doc_id)) AS h FROM documents
), numbers AS (
  SELECT *, CAST(concat('0x', h[1:8]) AS UBIGINT)::BIGINT AS h1, CAST(concat('0x', h[9:16]) AS UBIGINT)::BIGINT AS h2,
         CAST(concat('0x', h[17:24]) AS UBIGINT)::BIGINT AS h3, CAST(concat('0x', h[25:32]) AS UBIGINT)::BIGINT AS h4
  FROM drawn
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN concat('<P>', substring(text, 1, a), '<S>', substring(text, b + 1), '<M>', substring(text, a + 1, b - a))
              ELSE concat('<S>', substring(text, b + 1), '<P>', substring(text, 1, a), '<M>', substring(text, a + 1, b - a)) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cuts
"""

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_decontamination": op2_decontamination,
    "op3_id_files": op3_id_files,
    "op4_simhash_trie": op4_simhash_trie,
    "op5_lm_score": op5_lm_score,
    "op6_language_id": op6_language_id,
    "op7_fingerprints": op7_fingerprints,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_search": op11_search,
    "op12_chat": op12_chat,
    "op13_fim": op13_fim,
}

ORACLE_SQL = {"op10_line_dedup": OP10_SQL, "op11_search": OP11_SQL, "op12_chat": OP12_SQL, "op13_fim": OP13_SQL}
