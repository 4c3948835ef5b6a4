"""Every opN query over a small folder, against restatements in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_operators import LOWER, PLAIN, RANKS, brute_contamination, brute_fingerprint, prose
from tokenizers import Tokenizer

from editlake.llm import bpe, langid, queries

hexed = lambda b: hashlib.sha256(b).hexdigest()
crc = lambda k, n: zlib.crc32(str(k).encode()) % n


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(21)
    rows = []
    for k in range(240):
        lang = r.choice(list(PLAIN))
        t = " ".join(r.choice(PLAIN[lang].split()) for _ in range(r.randrange(5, 40)))
        if k % 9 == 0:
            t += "\n  A Shared line for Many \n" + prose(7, 60)
        if k % 6 == 0:
            t += " nasty vile"
        rows.append((k, t, None if k % 31 == 0 else lang, "s", len(t), "clash"))
    rows += [(300, None, "en", "s", 0, "x"), (301, "", None, None, 0, None), (302, "12 !?", "de", "s", 5, None), (303, prose(1, 3000), "en", "s", 1, None)]
    rows += [(304 + k, rows[5][1], "en", "s", 1, None) for k in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{out}/documents.parquet")
    bench = [(1, prose(7, 30)), (2, prose(8, 5)), (3, None), (None, "x")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    labels = [(k, 1, int(k % 6 == 0)) for k in range(240) if k % 5] + [(9999, 0, 1), (7, 0, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out, [(k, t or "", lang) for k, t, lang, *_ in rows], spark.createDataFrame(bench, "item_id long, text string")


def result(spark, folder, name, types):
    df = queries.QUERIES[name](spark, folder[0])
    assert [(f.name, f.dataType.simpleString()) for f in df.schema][: len(types)] == types
    got = df.collect()
    assert sorted(r.doc_id for r in got) == [k for k, *_ in folder[1]]
    return {r.doc_id: r for r in got}


def test_op1(spark, folder):
    got = result(spark, folder, "op1_byte_bpe", [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")])
    tk = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for k, t, _ in folder[1]:
        ids = tk.encode_ordinary(t)
        assert got[k][1:4] == (len(ids), hexed(np.array(ids, "<u4").tobytes()), hexed(t.encode()))


def test_op2(spark, folder):
    types = [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"), ("items_sha256", "string"), ("contaminated", "boolean")]
    got = result(spark, folder, "op2_decontamination", types)
    rows = type("Table", (), {"collect": lambda self: [type("Row", (), {"doc_id": k, "text": t}) for k, t, _ in folder[1]]})()
    for k, n, hit, items in brute_contamination(rows, folder[2]):
        assert got[k][1:6] == (n, len(hit), len(items), hexed(",".join(items).encode()), bool(hit))
    assert any(r.contaminated for r in got.values())


def test_op3(spark, folder):
    got = result(spark, folder, "op3_id_files", [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")])
    t, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for k, text, _ in sorted(folder[1]):
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        assert got[k][1:4] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op4(spark, folder):
    got = result(spark, folder, "op4_simhash_trie", [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")])
    fp = {k: brute_fingerprint(t) for k, t, _ in folder[1]}
    label = {k: k for k in fp}
    for _ in range(8):
        label = {k: min(label[j] for j in fp if (fp[j] ^ fp[k]).bit_count() <= 3) for k in fp}
    assert {k: r[1:3] for k, r in got.items()} == {k: (f"{fp[k]:016x}", label[k]) for k in fp}


def test_op5(spark, folder):
    got = result(spark, folder, "op5_lm_score", [("doc_id", "bigint"), ("n_words", "bigint"), ("log_likelihood", "double"), ("mean_log_likelihood", "double")])
    assert got[300].log_likelihood == 0 and got[302].log_likelihood < 0
    assert got[304].log_likelihood == pytest.approx(got[5].log_likelihood, rel=1e-6) and got[305].log_likelihood == pytest.approx(got[5].log_likelihood, rel=1e-6)


def grams(t):
    """1- to 3-grams of the words, with an end mark on either side of each."""
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in t.lower()).split():
        w = f"\x01{word}\x01"
        out.update(word)
        out.update(w[i : i + 2] for i in range(len(w) - 1))
        out.update(w[i : i + 3] for i in range(len(w) - 2))
    return out


def code(g):
    n = 0
    for c in g:
        n = n << 21 | ord(c)
    return n


def top(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[: langid.PROFILE]]


def test_op6(spark, folder):
    got = result(spark, folder, "op6_language_id", [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")])
    counts = {}
    for k, t, lang in folder[1]:
        if lang and crc(k, 4) != 2:
            counts.setdefault(lang, Counter()).update(grams(t))
    profiles = {lang: {g: rank for rank, g in enumerate(top(c))} for lang, c in counts.items()}
    for k, t, _ in folder[1]:
        own = top(grams(t))
        want = ("und", 0.0)
        if own:
            away = {lang: sum(abs(p[g] - i) if g in p else langid.PROFILE for i, g in enumerate(own)) for lang, p in profiles.items()}
            best = min(sorted(away), key=away.get)
            want = (best, 1 - away[best] / (len(own) * langid.PROFILE))
        assert got[k].held_out == (crc(k, 4) == 2) and got[k].lang_pred == want[0] and abs(got[k].score - want[1]) < 1e-12, k
    held = [k for k, _, lang in folder[1] if lang and crc(k, 4) == 2 and k < 240]
    assert sum(got[k].lang_pred == dict((k, lang) for k, _, lang in folder[1])[k] for k in held) >= 0.95 * len(held)


def test_op7(spark, folder):
    types = [("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string")]
    types += [("near_edited", "double"), ("near_next", "double"), ("n_near", "bigint")]
    got = result(spark, folder, "op7_fingerprints", types)
    order = sorted(folder[1], reverse=True)
    far = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    for (k, t, _), (j, after, _) in zip(order, order[1:] + order[:1], strict=True):
        r, half = got[k], len(t) // 2
        assert (r.n_chars, r.edited_sha256) == (len(t), hexed((t[: len(t) - half] + after[:half]).encode()))
        assert r.near_edited == 1 - far(r.fingerprint, r.edited_fingerprint) / 64 and r.near_next == 1 - far(r.fingerprint, got[j].fingerprint) / 64
        near = sum(far(r.fingerprint, x.fingerprint) <= 3 for x in got.values())
        assert r.n_near == (near if k % 100 == 0 else None)
    assert got[304].fingerprint == got[5].fingerprint


def test_op8(spark, folder):
    got = result(spark, folder, "op8_toxicity", [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")])
    for k, r in got.items():
        assert r.held_out == (crc(k, 3) == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [k for k in range(240) if crc(k, 3) == 1]
    assert sum(got[k].predicted == int(k % 6 == 0) for k in held) >= 0.95 * len(held)


def test_op9(spark, folder):
    got = result(spark, folder, "op9_substring_dedup", [("doc_id", "bigint"), ("n_bytes", "bigint"), ("repeated", "boolean")])
    for k, t, _ in folder[1]:
        assert got[k].n_bytes == len(t.encode())
        if k < 240 and k % 9 == 0:
            assert got[k].repeated and (got[k].dropped_bytes > 0) == (k > 0)
            assert (got[k].kept_sha256 == hexed(t.encode())) == (k == 0)


def test_op10(spark, folder):
    got = result(spark, folder, "op10_line_dedup", [("doc_id", "bigint"), ("n_lines", "bigint"), ("n_dropped", "bigint"), ("kept_sha256", "string")])
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = {}
    for k, t, _ in folder[1]:
        for line in t.split("\n"):
            holders.setdefault(key(line), set()).add(k)
    for k, t, _ in folder[1]:
        lines = t.split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == k]
        assert got[k][1:4] == (len(lines), len(lines) - len(kept), hexed("\n".join(kept).encode()))
