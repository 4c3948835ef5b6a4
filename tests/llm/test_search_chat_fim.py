"""Search, chat formatting and fill-in-the-middle against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import LOWER, prose

from editlake.llm import chat, fim, queries, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
hexed = lambda t: hashlib.sha256(t.encode()).hexdigest()


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, top=10):
    counts = [(k, Counter(terms(t))) for k, t in docs]
    sizes = [c.total() for _, c in counts]
    n_docs, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(Counter)
    for k, t in items:
        asked[k].update(terms(t))
    out = set()
    for item, wanted in asked.items():
        scored = []
        for (k, c), n in zip(counts, sizes, strict=True):
            m = 25 + (75 * n * n_docs) // length if n else 0
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in wanted.items() if c[t])
            if score > 0:
                scored.append((-score, k is None, k or 0, k))
        out |= {(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])}
    return out


DOCS = [(k, prose(k % 70, 5 + k % 40, 60)) for k in range(200)]
DOCS += [(500, None), (501, ""), (502, "?! _ \t"), (503, "ÀÉ über W1X1 w1x1-w2x2 日本語"), (504, "w3x3 " * 300_000), (505, DOCS[3][1]), (505, DOCS[4][1]), (None, DOCS[3][1]), (None, None)]
ITEMS = [(k, prose(900 + k, 12, 60)) for k in range(30)]
ITEMS += [(40, None), (41, ""), (42, "W1X1 w1x1 À über"), (42, "w3x3"), (None, "w5x5 w6x6"), (43, "absent words"), (7, ITEMS[7][1])]


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_search_is_brute_force(spark, block_bytes):
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in DOCS], "doc_id long, text string, item_id string, rank int").repartition(5)
    items = spark.createDataFrame([(k, t, 9) for k, t in ITEMS], "item_id long, text string, score int")
    got = search.search(docs, items, block_bytes=block_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == brute_search(DOCS, ITEMS)


def test_search_in_small_steps(spark, monkeypatch):
    """Heaps that are pushed often, with many equal scores."""
    docs = [(k, "a b c" if k % 3 else "a b") for k in random.Random(1).sample(range(5000), 600)]
    rows = [(k, np.array([0, 1], np.int64), len(t.split())) for k, t in docs]
    vocabulary = {b"a": 0, b"c": 1}
    index = search.ItemIndex([("x", b"a", 2), ("y", b"c", 1)], {0: 600, 1: 400}, vocabulary, 900)
    monkeypatch.setattr(search, "CELLS", 7)
    heaps = search.Heaps(2, 10)
    for a in range(0, len(rows), 50):
        part = rows[a : a + 50]
        held = [[0, 1] if n == 3 else [0] for _, _, n in part]
        first = np.concatenate(([0], np.cumsum([len(x) for x in held])))
        ids = np.array([k for k, _, _ in part])
        n = np.array([n for *_, n in part])
        search._push_scores(heaps, index, ids, np.zeros(len(part), bool), search.damping(n, 900, 2600), first, np.concatenate(held), np.ones(first[-1], np.int64))
    short = sorted(k for k, t in docs if t == "a b")[:10]
    assert heaps.doc[heaps.item == 0].tolist() == short
    assert heaps.doc[heaps.item == 1].tolist() == sorted(k for k, t in docs if t == "a b c")[:10]


def test_search_of_nothing(spark):
    docs = spark.createDataFrame(DOCS[:5], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0
    assert search.search(docs.withColumn("text", queries.F.lit(None).cast("string")), items).count() == 0


def test_damping_beyond_64_bits():
    n = np.array([10**9, 7])
    assert search.damping(n, 10**10, 10**13).tolist() == [25 + 75 * 10**9 * 10**10 // 10**13, 25]


CONTROL = ["<|turn|>", "<|end|>", "<|text|>", "<|image|>", "</s>", "<s>", "[INST]", "[/INST]", "<", "[", "\\", "|end|>", "s>", "/INST]", "é", "\n", "x", " "]


def test_escaping_is_reversible(spark):
    r = random.Random(5)
    texts = ["".join(r.choice(CONTROL) for _ in range(r.randrange(12))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(chat.F.col("t")).alias("e")).collect()
    for t, e in rows:
        assert chat.unescape(e) == t
        assert not re.search(r"</?s>|\[/?INST\]|<\|(turn|end|text|image)\|>", e)


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return kind, text, ref, width, height, seconds, pages


def test_parts_become_placeholders(spark):
    content = [part("text", "look <"), part("text", "|end|>"), part("image", ref="s3://a", width=57, height=28), part("audio", ref="b", seconds=1.5), None]
    more = [part("document", ref="c", pages=3), part("image"), part("video", ref="d"), part("text", "é</s>"), part(None, "plain")]
    rows = [(1, 0, "user", content, 3), (1, 1, "assistant", more, 3), (1, 2, None, None, 3), (1, 3, "assistant", [], 3), (None, None, "assistant", [part("text", "a")], 1)]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>, start int").repartition(3)
    made = chat.format_turns(turns)
    got = made.orderBy("conv_id", "start").collect()
    one = [r for r in got if r.conv_id == 1]
    text = "".join(r.formatted for r in one)
    want = (
        "<|turn|>user<|text|>look <<|text|>|end|><|image|><|audio|><|text|><|end|>"
        "<|turn|>assistant<|document|><|image|><|other|><|text|>é<\\/s><|text|>plain<|end|><|turn|><|text|><|end|><|turn|>assistant<|text|><|end|>"
    )
    assert text == want
    assert [(r.kind, r.attachment_no, r.ref, r.tokens) for r in one if r.tokens is not None] == [
        ("image", 1, "s3://a", 3), ("audio", 2, "b", 38), ("document", 3, "c", 1536), ("image", 4, None, 1), ("video", 5, "d", 0),
    ]
    assert [chat.unescape(text[r.loss_start : r.loss_end]) for r in one if r.loss_start is not None] == ["é</s>", "plain", ""]
    for read in (chat.read_back(made, in_order=True), chat.read_back(made.repartition(4, "start"))):
        back = {r.conv_id: r for r in read.collect()}
        assert set(back) == {1, None} and back[None].loss_chars == 1
        assert back[1].turns_sha256 == hexed("user\nlook <|end|>\nassistant\né</s>plain\n\n\nassistant\n\n")
        assert back[1][1] == 4 and back[1].loss_chars == 10 and back[1].loss_sha256 == hexed("é</s>plain") and back[1].formatted_chars == len(want)
        assert back[1].n_placeholders == 5 and back[1].attachment_tokens == 3 + 38 + 1536 + 1


def test_conversations_read_back_are_the_turns(spark, tmp_path):
    r = random.Random(3)
    rows = []
    for k in range(60):
        for t in range(300 if k == 7 else r.randrange(1, 9)):
            text = "".join(r.choice(CONTROL) for _ in range(r.randrange(30)))
            rows.append((k, t, r.choice(["user", "assistant", "a\n<|end|>"]), None if r.random() < 0.1 else text, "clash"))
    rows += [(99, 0, "assistant", "twice", "x")] * 2 + [(100, None, "assistant", "z" * 3_000_000, "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, content string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    rows += [(-7, 0, "user", queries.PROBE, ""), (-7, 1, "assistant", queries.PROBE, "")]
    by = defaultdict(list)
    for k, t, role, text, _ in sorted(rows, key=lambda x: (x[0], x[1] is None, x[1] or 0)):
        by[k].append((role, text or ""))
    got = {x.conv_id: x for x in queries.op12_chat(spark, str(tmp_path)).collect()}
    assert set(got) == set(by)
    for k, turns in by.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[k].n_turns == len(turns) and got[k].turns_sha256 == hexed("".join(f"{a}\n{b}\n" for a, b in turns))
        assert got[k].loss_chars == len(loss) and got[k].loss_sha256 == hexed(loss)
    empty = spark.createDataFrame([], f"conv_id long, turn long, role string, content array<{chat.PART}>")
    assert chat.read_back(chat.format_turns(empty), in_order=True).count() == 0


def test_rank_index_is_exact_and_bounded(monkeypatch):
    r = random.Random(2)
    texts = ["", "a", "é", "😀", "plain ascii " * 900, "".join(r.choice("aé日😀") for _ in range(9000)), "a" * 5000 + "日" * 5000 + "b" * 300 + "😀" * 7000]
    for size in (1 << 20, 64, 7):
        monkeypatch.setattr(fim, "SLICE", size)
        for t in texts if size > 64 else [x[:700] for x in texts]:
            data = np.frombuffer(t.encode(), np.uint8)
            index = fim.RankIndex(data)
            want = np.concatenate(([0], np.cumsum([len(c.encode()) for c in t]))) if t else [0]
            assert index.n == len(t)
            assert [index.locate(k) for k in range(len(t) + 1)] == list(map(int, want))
    monkeypatch.setattr(fim, "SLICE", 1 << 20)
    index = fim.RankIndex(np.frombuffer(texts[-1].encode(), np.uint8))
    assert np.abs(index.residual.astype(int)).max() <= fim.ERROR and len(index.rank) < 200


def brute_fim(doc_id, text):
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_is_brute_force(spark, tmp_path):
    r = random.Random(4)
    rows = [(k, "".join(r.choice("ab é日😀<PSM>\n") for _ in range(r.randrange(40)))) for k in range(600)]
    rows += [(700, None), (701, ""), (702, "a<M>b"), (703, "<S"), (704, "日本é " * 700_000), (5, "again"), (5, "again"), (None, "without id"), (None, None)]
    df = spark.createDataFrame([(k, t, 3, "clash") for k, t in rows], "doc_id long, text string, n int, form string").repartition(3)
    made = fim.fill_in_middle(df)
    got = made.withColumn("restored", fim.restore(made.form, made.output)).drop("text").collect()
    key = lambda x: tuple("" if v is None else str(v) for v in x)
    assert sorted((tuple(x) for x in got), key=key) == sorted(((k, *brute_fim(k, t or ""), t or "") for k, t in rows), key=key)
    assert {x.form for x in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(df.limit(0)).count() == 0
