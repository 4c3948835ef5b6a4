"""Near-copies against all pairs' Jaccard similarities."""

from __future__ import annotations

import random

import pytest
from test_operators import TEXTS, plain_words, prose

from editlake.llm import near_texts

SCHEMA = "doc_id long, text string, samples string"


def shingle_set(t):
    w = plain_words(t)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else None


def likeness(a, b):
    return len(a & b) / len(a | b)


def brute(rows):
    """Components by all pairs; rows (id, text) with different ids."""
    sets = [shingle_set(t) for _, t in rows]
    label = [k for k, _ in rows]
    near = [
        [j for j in range(len(rows)) if (sets[i] is None and (rows[i][1] or "") == (rows[j][1] or "")) or (sets[i] and sets[j] and likeness(sets[i], sets[j]) >= 0.8)]
        for i in range(len(rows))
    ]
    for _ in rows:
        label = [min(label[j] for j in near[i]) for i in range(len(rows))]
    return {k: c for (k, _), c in zip(rows, label, strict=True)}


def edited(t, r, share):
    w = t.split()
    for k in r.sample(range(len(w)), max(1, int(len(w) * share))):
        w[k] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_components_are_those_of_all_pairs(spark):
    r = random.Random(8)
    texts = list(TEXTS)
    for k in range(40):
        base = prose(500 + k, r.choice((12, 60, 300, 900)))
        texts += [base, *(edited(base, r, share) for share in (0.002, 0.01, 0.02, 0.04))]
    hub = prose(900, 80)
    texts += [edited(hub, r, 0.0125) for _ in range(60)] + [hub] * 3
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], SCHEMA).repartition(3)
    want = brute(rows)
    got = {x.doc_id: x.component_id for x in near_texts.near_texts(df).collect()}
    assert got == want and len(set(want.values())) < len(rows) - 100


def test_unlike_members_of_a_group_get_leaders_of_their_own(spark):
    """Two families that share 30 of 40 words share samples, but are near inside each family only."""
    r = random.Random(3)
    common = prose(40, 400)
    rows = []
    for family in range(6):
        own = common + " " + prose(50 + family, 150)
        rows += [(100 * family + k, edited(own, r, 0.004)) for k in range(8)]
    got = {x.doc_id: x.component_id for x in near_texts.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert set(got.values()) == {100 * f for f in range(6)}


def test_null_ids_repeated_rows_and_empty_tables(spark):
    a, b = prose(1, 90), prose(2, 90)
    rows = [(5, a), (5, a), (None, a), (None, b), (7, None), (8, ""), (9, "!?"), (10, "!!"), (11, b + " more")]
    got = near_texts.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(x.doc_id, x.component_id) for x in got], key=str) == sorted(
        [(5, 5), (5, 5), (None, 5), (None, None), (7, 7), (8, 7), (9, 9), (10, 10), (11, 11)], key=str
    )
    assert near_texts.near_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("words", [5, 40, 400])
def test_samples_agree_as_often_as_they_should(words):
    """Near pairs of a similarity just above 0.8 share a sample in nearly all cases."""
    import numpy as np

    r, hits, n = random.Random(words), 0, 0
    while n < 60:
        base = prose(r.randrange(10**6), words)
        other = edited(base, r, 0.02)
        if likeness(shingle_set(base), shingle_set(other)) < 0.8:
            other = base + " one" if words > 20 else base
        if likeness(shingle_set(base), shingle_set(other)) < 0.8:
            continue
        data = np.frombuffer((base + other).encode(), np.uint8)
        text, value = near_texts.shingles(data, np.array([0, len(base), len(data)]), 5)
        s = near_texts.samples(value, np.flatnonzero(np.diff(text, prepend=-1)))
        hits += bool((s[:, 0] == s[:, 1]).any())
        n += 1
    assert hits >= 59


def trio(seed):
    """A text with two that are a little too far from it, but near to each other."""
    r = random.Random(seed)
    base = [f"t{seed}w{r.randrange(10**6)}" for _ in range(204)]
    one, two = list(base), list(base)
    for k in (30, 70, 110, 150):
        one[k] = two[k] = f"t{seed}both{k}"
    one[190], two[12] = f"t{seed}one", f"t{seed}two"
    return [" ".join(x) for x in (base, one, two)]


def test_texts_far_from_a_leader_find_each_other(spark):
    """Every group that the nearer two share is led by the third, as it meets as many; 300 times."""
    rows = [(3 * s + k, t) for s in range(300) for k, t in enumerate(trio(s))]
    sets = [[shingle_set(t) for t in trio(s)] for s in (0, 1)]
    assert all(likeness(a, b) < 0.8 and likeness(a, c) < 0.8 and likeness(b, c) >= 0.8 for a, b, c in sets)
    got = {x.doc_id: x.component_id for x in near_texts.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[3 * s] == 3 * s for s in range(300))
    assert sum(got[3 * s + 2] == got[3 * s + 1] == 3 * s + 1 for s in range(300)) >= 298


def test_a_group_of_copies_and_strangers(spark, monkeypatch):
    """Groups of many small blocks."""
    monkeypatch.setattr(near_texts, "BLOCK", 1000)
    r = random.Random(7)
    common = prose(70, 300)
    rows = [(k, edited(common + " " + prose(71, 20), r, 0.002)) for k in range(30)]
    rows += [(100 + k, common + " " + prose(200 + k, 110 + k)) for k in range(12)]
    got = {x.doc_id: x.component_id for x in near_texts.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_shared_counts_and_forest():
    import numpy as np

    r = random.Random(5)
    one, two = ([np.array(sorted(r.sample(range(9000), r.randrange(0, 6000)))) for _ in range(n)] for n in (7, 5))
    assert near_texts.shared_counts(one, two).tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in two] for a in one]
    u, v = np.array([1, 2, 3, 9, 1]), np.array([2, 3, 1, 8, 3])
    assert near_texts._forest(u, v) == [(1, 2), (2, 3), (8, 9)]


def test_copies_with_many_changes(spark):
    r = random.Random(11)
    base = prose(90, 300, 10**6)
    rows = [(k, edited(base, r, r.choice((0.01, 0.03, 0.04, 0.05)))) for k in range(400)]
    got = {x.doc_id: x.component_id for x in near_texts.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
