"""The pipeline against a plain restatement of its stages on a small folder."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from test_near_texts import brute
from test_operators import LOWER, TEXTS, brute_contamination, prose

import corpus_pipeline
from editlake.llm import bpe

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def after_line_dedup(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = {}
    for k, t in rows:
        for line in t.split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(k)
    out = []
    for k, t in rows:
        kept = [x for x in t.split("\n") if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == k]
        if "\n".join(kept).strip(" \t\n\x0b\x0c\r"):
            out.append((k, "\n".join(kept)))
    return out


def after_near_dedup(rows):
    label = brute(rows)
    return [r for r in rows if r[0] == label[r[0]]]


class Collected:
    """Just enough of a DataFrame for the brute-force helper."""

    def __init__(self, rows):
        self.rows = rows

    def collect(self):
        return [type("Row", (), {"doc_id": k, "text": t}) for k, t in self.rows]


def test_run(spark, tmp_path):
    texts = [*TEXTS, prose(77, 90), prose(77, 89) + " changed", prose(88, 120) + " " + prose(3, 60)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], COLUMNS)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame([(1, prose(3, 60)), (2, prose(99, 30))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")

    rows = [(k, t) for k, t in enumerate(texts) if t and any(c.isalpha() for c in t)]
    rows = after_near_dedup(after_line_dedup(rows))
    hit = {k for k, _, places, _ in brute_contamination(Collected(rows), bench) if places}
    rows = [r for r in rows if r[0] not in hit]
    assert hit and len(rows) > 5
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tk = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for k, t in rows:
        ids = tk.encode_ordinary(t)
        want[k] = (len(ids), ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "plain words here", "en", "s", 16, "more")], COLUMNS + ", extra string")
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == corpus_pipeline.COLUMNS, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        assert out.count() == 1, name
    assert "n_tokens" in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).columns


def test_null_and_repeated_ids(spark, tmp_path):
    spark.createDataFrame([(1, prose(3, 60))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    a, b, dirty, near = prose(1, 90), prose(2, 90), prose(3, 60), prose(77, 90)
    docs = [(None, prose(4, 90), "en", "s", 1), (None, prose(5, 90), "de", "t", 1)]
    docs += [(7, a, "en", "s", 1), (7, b, "de", "t", 1), (7, dirty, "fr", "u", 1)]
    docs += [(9, near, "en", "s", 1), (None, near, "en", "s", 1), (8, near, "en", "s", 1), (8, near, "en", "s", 1)]
    df = spark.createDataFrame(docs, COLUMNS).repartition(3)
    rows = lambda out: sorted([(r.doc_id or 0, r.text, r.lang, r.source) for r in out.collect()])
    plain = lambda part: sorted((k or 0, t, lang, source) for k, t, lang, source, _ in part)
    # The copy in document 9 is its only line and goes; rows of the least id and those without one keep theirs.
    assert rows(corpus_pipeline.line_dedup(spark, df, str(tmp_path))) == plain([d for d in docs if d[0] != 9])
    assert rows(corpus_pipeline.near_dedup(spark, df, str(tmp_path))) == plain([*docs[:5], docs[8]])
    assert rows(corpus_pipeline.decontaminate(spark, df, str(tmp_path))) == plain([d for d in docs if d[1] != dirty])
