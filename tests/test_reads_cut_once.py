"""Reads are cut in one pass over a document; adapters shorter than the least overlap."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd

from editlake.operators import targeted
from editlake.plans import bindings


def test_reads_of_long_documents(spark, tmp_path):
    rng = np.random.default_rng(4)
    long = "".join(rng.choice(list("abcXYZ éß\n1"), 6_000))
    texts = [long, "", None, "12 !", "a" * 150, "B" * 151, "one"]
    rows = [(k, t, "en", f"s{k % 2}") for k, t in enumerate(texts)] + [(9, "c" * 8_000_000, "en", None)]
    pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]).to_parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for k, t, _, source in rows:
        letters = "".join(c for c in t or "" if c.isascii() and c.isalpha()).lower()
        for i in range(0, len(letters), 150):
            cut = letters[i : i + 150]
            want[k * 1000000 + i // 150] = (source, *("".join(x[(ord(c) - 97) % 4] for c in cut) for x in ("ACGT", "+5?I")))
    began = time.monotonic()
    got = {r.read_id: (r.sample, r.seq, r.qual) for r in bindings.reads(spark, str(tmp_path)).collect()}
    assert got == want
    # 53,334 reads, each found from the document's beginning, go over 213 billion letters.
    assert time.monotonic() - began < 60


def test_adapter_shorter_than_the_overlap(spark):
    df = spark.createDataFrame([(1, "TTTTACGTTT"), (2, "TTTTTTAC")], "id int, seq string")
    for indels in (True, False):
        got = targeted.trim_adapters(df, ["AC", "ACGT"], 3, 0.0, min_overlap=3, indels=indels)
        assert {r.id: (r.seq, r.adapter) for r in got.collect()} == {1: ("TTTT", 1), 2: ("TTTTTTAC", None)}
