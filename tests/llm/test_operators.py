"""The corpus operators against brute force, on small tables with nulls, empty and long texts, ties and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
from pyspark.sql import types as T
from tokenizers import Tokenizer

from editlake.llm import (
    bpe,
    components,
    decontamination,
    fingerprints,
    idfile,
    langid,
    linededup,
    lm_score,
    simhash_trie,
    substring,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, score double, n_words int, text_key string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}x{r.randrange(9)}" for _ in range(n))


BASE = prose(1, 200)
TEXTS = [
    BASE, BASE, BASE.replace("w", "W", 3), BASE + " tail", prose(2, 150) + "\n" + prose(3, 60), prose(4, 60) + " " + prose(3, 60) + " " + prose(5, 60),
    "", None, " \n\t ", "one", "Ünïcode ÀÉ 日本語 😀 " * 5, prose(6, 3000), "a\n\nA shared line here\n  A SHARED LINE HERE \nb", "A Shared Line Here",
    "\r\n", "x" * 5000, "12 34 56 !!", "trailing newline\n", "two words",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", 0.5, 7, "clash") for k, t in enumerate(TEXTS)]
    rows += [(3, BASE + " tail", None, None, None, None), (None, BASE, "en", 1.0, 1, "x"), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# 1


def test_bpe_like_the_library(docs, empty):
    ranks = bpe.read_ranks(RANKS)
    tk = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for k, t in texts_of(docs):
        ids = tk.encode_ordinary(t)
        want.append((k, len(ids), ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), True))
    assert by_id(bpe.encode_bpe(docs, RANKS, public_tokenizers.PATTERN)) == sorted(want, key=str)
    assert bpe.encode_bpe(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_on_odd_strings():
    ranks = bpe.read_ranks(RANKS)
    tk = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = bpe.ByteBPE(bpe.serialize_model(ranks), public_tokenizers.PATTERN)
    r = random.Random(3)
    odd = ["".join(r.choice("ab 1'\n\t\x1c\x85 é日😀.,sS") for _ in range(r.randrange(40))) for _ in range(3000)]
    odd += [f"a{chr(c)}1 {chr(c)} b" for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    made = b.encode(odd)
    assert [np.frombuffer(x, "<u4").tolist() for x in made] == [tk.encode_ordinary(x) for x in odd]
    assert [b.decode(x) for x in made] == [x.encode() for x in odd]


# 2


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, BASE[300:700]), (2, prose(3, 60)), (10, "two words"), (11, "one"), (12, ""), (13, None), (None, BASE), (2, prose(3, 60)), (14, prose(99, 30)), (3, BASE[350:650].upper())]
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_contamination(docs, bench):
    windows = {}
    for r in bench.collect():
        w = plain_words(r.text)
        if r.item_id is not None and w:
            for k in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[k : k + 10]), set()).add(str(r.item_id))
    out = []
    for k, t in texts_of(docs):
        w, hit, items = plain_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    items |= windows[tuple(w[i : i + n])]
        out.append((k, len(w), sorted(hit), sorted(items)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [decontamination.BLOCK_BYTES, 1500])
def test_contamination(docs, empty, bench, block):
    want = brute_contamination(docs, bench)
    assert by_id(decontamination.mark_contamination(docs, bench, block_bytes=block)) == want
    assert any(x[2] for x in want)
    assert decontamination.mark_contamination(empty, bench).count() == 0
    assert decontamination.mark_contamination(docs, bench.limit(0)).filter("size(items) > 0").count() == 0


def test_winnowing_keeps_one_of_every_window():
    g = np.random.default_rng(2).integers(0, 50, 400).astype(np.uint64)
    keep = decontamination.kept_grams(g, 6)
    assert all(keep[k : k + 6].any() for k in range(len(g) - 5))


# 3


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 9000])
def test_coder_round_trip(n):
    r = np.random.default_rng(n)
    for ids in (np.minimum(r.zipf(1.2, n), 65535), r.integers(0, 65536, n), np.full(n, 7), np.tile(r.integers(0, 65536, 40), n // 40 + 1)[:n]):
        ids = ids.astype(np.int64)
        ids = np.minimum(ids, 65534)
        model = idfile.frequencies(ids)
        assert n == 0 or model[1].sum() == 1 << idfile.STATIC and model[1].min() > 0
        assert (idfile.decode_blocks(idfile.encode_blocks(ids, *model), n, *model) == ids).all()


def test_checksum_is_checked():
    blob = bytearray(idfile.pack_segment([1, None], [3000, 10], np.arange(3010) % 50))
    idfile.unpack_segment(bytes(blob))
    blob[-40] ^= 1
    with pytest.raises(ValueError):
        idfile.unpack_segment(bytes(blob))


def test_id_files(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(idfile, "SEGMENT_IDS", 500)
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32, r.ids) for r in idfile.read_ids(spark, idfile.write_ids(docs, path)).collect())
    t, at = Tokenizer.from_file(path), 0
    left = {}
    for k, text in texts_of(docs):
        left.setdefault(k, []).append([*t.encode(text, add_special_tokens=False).ids, 0])
    order = sorted(left, key=lambda k: -1 if k is None else k)
    assert [g[1] for g in got] == [k for k in order for _ in left[k]]
    for start, k, n, crc, ids in got:
        left[k].remove(ids)
        assert (start, n, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    assert idfile.read_ids(spark, idfile.write_ids(empty, path)).count() == 0


# 4


def brute_fingerprint(t):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", t.translate(LOWER)) if x]
    if not w:
        return 0
    s = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark, docs, empty):
    rows = texts_of(docs)
    fp = [brute_fingerprint(t) for _, t in rows]
    label = [k for k, _ in rows]
    for _ in rows:
        label = [min((label[j] for j in range(len(rows)) if label[j] is not None and (fp[i] ^ fp[j]).bit_count() <= 3), default=None) for i in range(len(rows))]
    want = sorted(((k, f"{f:016x}", c) for (k, _), f, c in zip(rows, fp, label, strict=True)), key=str)
    assert by_id(simhash_trie.near_duplicates(docs)) == want
    assert simhash_trie.near_duplicates(empty).count() == 0


def near_fingerprints(seed, n, spread):
    r = np.random.default_rng(seed)
    base = r.integers(0, 2**63, max(1, n // 20)).astype(np.uint64)
    out = []
    for _ in range(n):
        x = base[r.integers(len(base))]
        for b in r.integers(0, 64, r.integers(0, spread)):
            x = x ^ (np.uint64(1) << np.uint64(b))
        out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("hot", [simhash_trie.HOT, 3])
def test_trie_join_loses_no_link(spark, hot):
    fp = near_fingerprints(4, 400, 6)
    reps = spark.createDataFrame([(int(x), k) for k, x in enumerate(fp.view(np.int64))], "fp long, rep long")
    got = {r.vertex: r.component for r in components.components(simhash_trie.links(reps, 3, hot)).collect()}
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    label = np.arange(len(fp))
    while True:
        new = np.array([label[near[k]].min() for k in range(len(fp))])
        if (new == label).all():
            break
        label = new
    assert [got.get(k, k) for k in range(len(fp))] == label.tolist()


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 300)] + [(500, 500)]
    got = {r.vertex: r.component for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {k: 100 for k in range(101, 300)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# 5


def test_pseudo_likelihood(spark, docs, empty):
    got = {r.doc_id: r for r in lm_score.score_documents(docs).collect() if r.doc_id is not None}
    assert set(got) == set(range(len(TEXTS)))
    assert (got[6].n_words, got[6].log_likelihood, got[6].mean_log_likelihood) == (0, 0.0, None)
    assert got[7].n_words == 0 and got[0].log_likelihood == got[1].log_likelihood < 0
    assert lm_score.score_documents(empty).count() == 0


def test_network_learns_both_sides(spark):
    r = random.Random(1)
    sentence = lambda: " ".join(f"a{k} b{k} c{k}" for k in (r.randrange(20) for _ in range(30)))
    train = spark.createDataFrame([(k, sentence()) for k in range(1500)], "doc_id long, text string").coalesce(1)
    held = [(9000, sentence()), (9001, " ".join(r.sample(sentence().split(), 90)))]
    scored = lm_score.score_documents(train.unionByName(spark.createDataFrame(held, "doc_id long, text string")))
    got = {x.doc_id: x.mean_log_likelihood for x in scored.filter("doc_id >= 9000").collect()}
    assert got[9000] > got[9001] + 0.5 and got[9000] > np.log(1 / 60) + 0.5


def test_rare_words_have_their_share_of_a_class(spark):
    r = random.Random(5)
    rows = [(k % 700, " ".join(f"head{r.randrange(lm_score.VOCAB - lm_score.RARE)}" for _ in range(60))) for k in range(800)]
    rare = [f"rare{k}" for k in range(3000)]
    rows += [(1000 + k, " ".join(rare[k : k + 3] * (1 + k % 5))) for k in range(0, 3000, 3)]
    rows += [(5000, rare[0]), (5000, rare[0]), (None, rare[1]), (None, rare[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts = lm_score.word_counts(docs).collect()
    head = sorted(counts, key=lambda x: (-x.n, x.word))[: lm_score.VOCAB - lm_score.RARE]
    shares = {x.word: x.share / lm_score.UNIT for x in lm_score.rare_shares(spark.createDataFrame(counts), head).collect()}
    left = [x for x in counts if x.word not in {y.word for y in head}]
    totals = np.bincount([x.word & 63 for x in left], [x.n for x in left])
    assert len(left) >= 2900 and set(shares) == {x.word for x in left}
    for x in left:
        assert abs(shares[x.word] - np.log(x.n / totals[x.word & 63])) < 1e-8
    got = lm_score.score_documents(docs).collect()
    assert sorted(x.doc_id or -1 for x in got) == sorted(k or -1 for k, _ in rows)
    alone = spark.createDataFrame([(1, rare[0], 7)], "doc_id long, text string, text_key long")
    word = lm_score.rare_words(alone, []).first().word
    # One word alone: the class's probability is at most 1, so the score is at most the word's share.
    one = [x.log_likelihood for x in got if x.doc_id == 5000]
    assert len(one) == 2 and one[0] == one[1] < shares[word] < -2


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_WORDS", 3000)
    rows = [(k % 90, prose(k, 100, 60)) for k in range(120)] + [(None, prose(3, 50))] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = []
    for n in (1, 4, 16):
        cut = docs.coalesce(1) if n == 1 else docs.repartition(n)
        made.append(sorted((x.doc_id or -1, x.log_likelihood) for x in lm_score.score_documents(cut).collect()))
    for other in made[1:]:
        assert [k for k, _ in made[0]] == [k for k, _ in other]
        np.testing.assert_allclose([x for _, x in made[0]], [x for _, x in other], rtol=1e-6)


def test_scores_against_a_plain_forward_pass(spark):
    """Every word's probability, word by word, from the parameters of one shard trained here."""
    rows = [(k, prose(k, 40, 50)) for k in range(30)] + [(99, "one"), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.log_likelihood for x in lm_score.score_documents(docs).collect()}
    hashes = lambda t: lm_score.words(*[np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])])[0].view(np.int64).tolist()
    counts = {}
    for _, t in rows:
        for w in hashes(t):
            counts[w] = counts.get(w, 0) + 1
    number = {w: k for k, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w)))}
    own = {r.doc_id: r.own for r in docs.selectExpr("doc_id", "xxhash64(doc_id, text) own").collect()}
    texts = [np.array([number[w] for w in hashes(t)], "<u2").tobytes() for k, t in sorted(rows, key=lambda x: own[x[0]]) if hashes(t)]
    p = {k: v.astype(np.float64) for k, v in lm_score.unflatten(lm_score.trained(texts)[0].astype(np.float64)).items()}
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    g = lm_score.GROUP
    for k, t in rows:
        ids, total = [number[w] for w in hashes(t)], 0.0
        for i, w in enumerate(ids):
            around = [ids[i + d] if 0 <= i + d < len(ids) else lm_score.VOCAB for d in (-2, -1, 1, 2)]
            hidden = np.tanh(sum(p["e"][j][c] for j, c in enumerate(around)))
            out = hidden @ p["u"] + p["b"]
            total += np.log(softmax(out[:g])[w // g]) + np.log(softmax(out[g:] + p["g"][w // g])[w % g])
        assert abs(got[k] - total) < 1e-3 * max(1, abs(total))


def test_network_gradient():
    r = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in lm_score.start_parameters().items()}
    ctx, ids = r.integers(0, lm_score.VOCAB + 1, (4, 50)), r.integers(0, lm_score.VOCAB, 50)
    loss = lambda q: -lm_score.forward(q, ctx, ids)[2].mean()
    seen = {k: np.zeros(s) for k, s in lm_score.SHAPES.items()}
    before = {k: v.copy() for k, v in p.items()}
    lm_score.train_step(p, seen, ctx, ids)
    for name, at in (("u", (3, 5)), ("b", (40,)), ("e", (1, int(ctx[1, 0]), 2))):
        up, down = {k: v.copy() for k, v in before.items()}, {k: v.copy() for k, v in before.items()}
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        slope = (loss(up) - loss(down)) / 2e-5
        assert abs(abs(slope) - np.sqrt(seen[name][at])) < 1e-6


# 6

PLAIN = {
    "en": "the and of that with from this have been which their would there people about house water",
    "de": "der und die das nicht mit von einer werden haben durch wurde zwischen straße über menschen wasser",
    "ru": "это который было человек время только может после должен вода дом люди через между работа",
}


def test_languages(spark, docs, empty):
    r = random.Random(2)
    rows = [(lang, " ".join(r.choice(w.split()) for _ in range(60))) for lang, w in PLAIN.items() for _ in range(30)] + [(None, "x"), ("en", None)]
    profiles = langid.learn_profiles(spark.createDataFrame(rows, "lang string, text string"))
    held = [(k, " ".join(r.choice(w.split()) for _ in range(12)), lang) for k, (lang, w) in enumerate(PLAIN.items())]
    asked = spark.createDataFrame([*held, (10, None, "und"), (11, "12 !? 34", "und"), (12, "", "und")], "doc_id long, text string, want string")
    made = langid.predict_language(asked, profiles)
    got = {x.doc_id: (x.lang_pred, x.score) for x in made.collect()}
    assert all(got[x.doc_id][0] == x.want and 0 <= got[x.doc_id][1] <= 1 for x in asked.collect())
    assert langid.predict_language(empty, profiles).count() == 0
    assert {x.lang_pred for x in langid.predict_language(docs, profiles.limit(0)).collect()} == {"und"}
    kept = langid.identify_rows(docs, profiles)
    assert kept.columns == docs.columns and {16, 6, 7}.isdisjoint({x.doc_id for x in kept.collect()}) and kept.filter("doc_id = 0").count() == 1


def test_profile_is_the_count_over_all(spark):
    rows = [("l", "ab ab b"), ("l", "b")]
    got = [x.gram for x in langid.learn_profiles(spark.createDataFrame(rows, "lang string, text string")).orderBy("rank").collect()]
    assert got[0] == ord("b") and set(got[1:3]) <= {ord("b") << 21 | 1, ord("a"), 1 << 21 | ord("a"), 1 << 21 | ord("b")}


# 7


def test_edited_fingerprints(spark, empty):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    plain = {r.doc_id: r.fp for r in fingerprints.fingerprints(docs).collect()}
    for k, t in rows:
        t, after = t or "", k - 1 if k else len(rows) - 1
        half = len(t) // 2
        edited = t[: len(t) - half] + (TEXTS[after] or "")[:half]
        assert (got[k].n_chars, got[k].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got[k].next_fp == plain[after] and got[k].fp == plain[k]
    assert plain[0] == plain[1] and plain[6] == plain[7] == 0
    alone = fingerprints.edited_fingerprints(docs.filter("doc_id = 4")).first()
    assert alone.next_fp == alone.fp
    assert fingerprints.edited_fingerprints(empty).count() == 0


def test_edited_fingerprints_of_null_and_repeated_ids(spark):
    r = random.Random(12)
    rows = [(k, prose(k, 20)) for k in range(40)] + [(7, prose(100 + k, 12)) for k in range(60)] + [(None, prose(300 + k, 9)) for k in range(50)]
    rows += [(7, prose(100, 12))] * 3 + [(None, None), (None, ""), (11, None)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    own = {t.text: t.own for t in docs.selectExpr("coalesce(text, '') text", "xxhash64(coalesce(text, '')) own").collect()}
    order = sorted(((k, t or "") for k, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, own[x[1]]), reverse=True)
    fp = {x.doc_id: x.fp for x in fingerprints.fingerprints(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")).collect()}
    fp = {t: fp[k] for k, t in enumerate(own)}
    want = []
    for (k, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        want.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), fp[t], fp[after]))
    got = [(x.doc_id, x.n_chars, x.edited_sha256, x.fp, x.next_fp) for x in fingerprints.edited_fingerprints(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_counts(spark):
    fp = near_fingerprints(5, 120, 5).view(np.int64).tolist()
    every = [(x,) for x in fp] + [(fp[3],)] * 5 + [(None,)]
    table = spark.createDataFrame(every, "fp long")
    got = {x.query_fp: x.n_near for x in fingerprints.near_counts(table.limit(50), table).collect()}
    asked = {x.fp for x in table.limit(50).collect()}
    assert got == {q: sum(x is not None and ((x ^ q) & (2**64 - 1)).bit_count() <= 3 for (x,) in every) for q in asked}


def test_votes_by_hand(spark):
    fp = lambda t: fingerprints.fingerprints(spark.createDataFrame([(1, t)], "doc_id long, text string")).first().fp
    h = {w: xxhash.xxh64_intdigest(w.encode(), 42) for w in ("alpha", "of", "gamma")}
    weight = {"alpha": 5, "of": 2 * 2, "gamma": 5}
    want = sum(1 << b for b in range(64) if 2 * sum(weight[w] for w in h if h[w] >> b & 1) > 14)
    assert fp("Alpha of\tof  gamma") == want - (1 << 64 if want >> 63 else 0)


def test_search_finds_all_within_the_radius(spark):
    fp = near_fingerprints(9, 300, 5)
    table = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)] + [(None,)], "fp long")
    got = {(r.query_fp, r.fp): r.distance for r in fingerprints.search(table, table).collect()}
    d = np.bitwise_count(fp[:, None] ^ fp[None, :])
    s = fp.view(np.int64).tolist()
    assert got == {(s[i], s[j]): int(d[i, j]) for i, j in zip(*np.nonzero(d <= 3), strict=True)}


# 8


def test_toxicity(spark, docs, empty):
    r = random.Random(4)
    rows, labels = [], []
    for k in range(600):
        bad = r.random() < 0.3
        w = prose(1000 + k, 30, 40).split()
        if bad:
            w[3], w[17] = "nasty", "vile"
        rows.append((k, " ".join(w)))
        if k < 400:
            labels.append((k, int(bad)))
    labels += [(7, None), (None, 1), (99999, 1), (8, 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    weights = toxicity.train(table, spark.createDataFrame(labels, "doc_id long, label int"))
    assert 0 < weights.count() < 4000
    got = {x.doc_id: x.score for x in toxicity.score(table, weights).collect()}
    assert all((got[k] >= 0.7) == ("nasty" in t) for k, t in rows[400:])
    assert all(0 <= x.score <= 1 for x in toxicity.score(docs, weights).collect())
    assert toxicity.score(empty, weights).count() == 0
    none = toxicity.train(table, spark.createDataFrame([], "doc_id long, label int"))
    assert {x.score for x in toxicity.score(docs, none).collect()} == {0.5}


def test_ftrl_against_the_plain_rule():
    """One coordinate after the other, as the method is published."""
    r = random.Random(6)
    rows = [(sorted(r.sample(range(12), 4)), r.randrange(2)) for _ in range(200)]
    model = toxicity.Ftrl(0.5)
    z, n = [0.0] * 12, [0.0] * 12
    for at, y in rows:
        model.learn(np.array(at), y)
        w = {}
        for i in at:
            w[i] = 0.0
            if abs(z[i]) > 0.5:
                w[i] = -(z[i] - (0.5 if z[i] > 0 else -0.5)) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for i in at:
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
            z[i] += g - sigma * w[i]
            n[i] += g * g
    np.testing.assert_allclose(model.z[:12], z)
    np.testing.assert_allclose(model.n[:12], n)


def test_toxicity_bounds_hold_with_repeated_ids(spark):
    rows = [(k % 5, f"w{k} vile" if k % 2 else f"w{k}") for k in range(200)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(5)] * 3 + [(77, 1)] * 50, "doc_id long, label int")
    a = sorted((x.place, x.weight) for x in toxicity.train(docs, labels, max_rows=20).collect())
    b = sorted((x.place, x.weight) for x in toxicity.train(docs.repartition(7), labels.repartition(3), max_rows=20).collect())
    assert a == b and 0 < len(a)
    assert toxicity.train(docs, labels, max_bytes=1).count() <= 10


# 9


def test_repeated_passages(spark, empty):
    passage, other = prose(50, 70), prose(51, 70)
    texts = {k: prose(100 + k, 120) for k in range(30)}
    for k in (3, 9, 21):
        texts[k] = f"{prose(200 + k, 40)} {passage} {prose(300 + k, 50)}"
    texts[12] = texts[5]
    texts[13] = texts[5].replace(" ", " inserted ", 1)
    texts[25] = f"{other} {prose(70, 90)} {other}"  # repeats itself only
    texts[26], texts[27] = None, ""
    docs = spark.createDataFrame([*texts.items(), (None, prose(400, 90))], "doc_id long, text string")
    got = {r.doc_id: r for r in substring.repeats(docs).collect()}
    assert {k for k, r in got.items() if r.repeated} == {3, 9, 21, 5, 12, 13}
    at = texts[9].index(passage)
    assert sum(min(s.end, at + len(passage)) - max(s.start, at) for s in got[9].spans) > 0.6 * len(passage)
    assert all(s.first for s in got[3].spans) and all(not s.first and s.of == 3 for s in got[21].spans)
    assert got[26].n_bytes == 0 and substring.repeats(empty).count() == 0


def test_kept_text_and_repeats_against_brute_force(spark):
    """Every passage of 60 or more words that two documents share is in a span nearly whole; kept is the text without spans."""
    r = random.Random(11)
    passages = [prose(700 + k, r.randrange(60, 200)) for k in range(12)] + ["and " * 300, "é日 " * 200]
    rows = []
    for k in range(60):
        parts = [prose(800 + k, r.randrange(1, 60)) for _ in range(3)]
        if k % 2:
            parts.insert(r.randrange(4), passages[r.randrange(len(passages))].strip())
        rows.append((k, " ".join(parts)))
    got = {x.doc_id: x for x in substring.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for k, t in rows:
        holders = [p for p in passages if p.strip() in t and sum(p.strip() in u for _, u in rows) > 1]
        assert got[k].repeated == bool(holders), k
        raw, at = t.encode(), 0
        kept = b""
        for s in got[k].spans:
            assert s.start >= at
            if not s.first:
                kept += raw[at : s.start]
                at = s.end
        assert got[k].kept == (kept + raw[at:]).decode()
        for p in holders:
            a = raw.index(p.strip().encode())
            b = a + len(p.strip().encode())
            inside = sum(max(0, min(s.end, b) - max(s.start, a)) for s in got[k].spans)
            assert inside > 0.6 * (b - a) and sum(s.end - s.start for s in got[k].spans) - inside < 60, k


def test_cuts_depend_on_near_bytes_only():
    text = prose(60, 500).encode()
    a, b = text, b"inserted " + text

    def pieces(x):
        data, offs = np.frombuffer(x, np.uint8), np.array([0, len(x)])
        _, start, length, _, digest = substring.cut(data, offs)
        assert start.tolist() == [0, *np.cumsum(length)[:-1]] and length.sum() == len(x)
        return digest.tolist()

    assert len(set(pieces(a)) - set(pieces(b))) <= 2


# 10


def test_line_dedup(docs, empty):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = {}
    for k, t in rows:
        for line in t.split("\n"):
            if k is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(k)
    want = []
    for k, t in rows:
        lines = t.split("\n")
        kept = [x for x in lines if k is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == k]
        want.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert by_id(linededup.line_dedup(docs)) == sorted(want, key=str)
    assert any(w[2] for w in want) and linededup.line_dedup(empty).count() == 0


def test_native_operators_run_no_python(docs):
    for df in (linededup.line_dedup(docs), fingerprints.edited_fingerprints(docs), fingerprints.search(fingerprints.fingerprints(docs), fingerprints.fingerprints(docs))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_all_null_columns(spark):
    docs = spark.createDataFrame([(None, None)] * 3, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    assert simhash_trie.near_duplicates(docs).collect()[0].component_id is None
    for df in (linededup.line_dedup(docs), fingerprints.edited_fingerprints(docs), lm_score.score_documents(docs), substring.repeats(docs)):
        assert df.count() == 3


def test_following_over_many_ranges(spark):
    r = random.Random(21)
    ids = [*range(1, 150), *(10**12 + k for k in range(150)), *(r.randrange(2**62) for _ in range(150))]
    keys = spark.createDataFrame([(True, k, own, str(k)) for k in ids for own in (1, 2)] + [(False, 0, 5, None)], "known boolean, id long, own long, note string")
    want = sorted(((k, own) for k in ids for own in (1, 2)), reverse=True) + [(0, 5)]
    want = dict(zip(want, want[1:] + want[:1], strict=True))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "37", "1200"):  # more ranges than keys too
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = fingerprints.following(keys, ["known", "id", "own"]).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert {(x.id, x.own): (x.next.id, x.next.own) for x in got} == want and len(got) == len(want)
    assert fingerprints.following(keys.limit(0), ["known", "id", "own"]).count() == 0
