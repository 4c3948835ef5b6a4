"""Steps changed in the fourth round: languages that were not learned."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from editlake.llm import langid

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and that with from this which there their would about people house water because through between".split(),
    "de": "der die und nicht werden zwischen schon auch über ich wir sprechen häuser möglich wasser durch gegen strasse".split(),
    "es": "los las que para como pero también entre porque ciudad gente agua sobre donde nosotros hablar mañana noche".split(),
}


def test_languages_that_were_not_learned_go(spark, tmp_path):
    rng = np.random.default_rng(5)
    said = lambda lang, n: " ".join(rng.choice(WORDS[lang], n))
    rows = [(lang, said(lang, n)) for n in (4, 12, 40, 150) for lang in WORDS for _ in range(40)]
    strange = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3,
        "Olen kotoisin Suomesta ja puhun suomea, talo on kaunis mutta maksaa liikaa meille kaikille tänään",
        " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxyz"), 7)) for _ in range(12)),
    ]
    rows += [(None, text) for text in strange] + [(None, said("de", 12)), (None, "12 34"), (None, None)]
    docs = spark.createDataFrame([(k, t, lang, "s", len(t or "")) for k, (lang, t) in enumerate(rows)], COLUMNS).repartition(3)
    kept = {r.doc_id: r.text for r in corpus_pipeline.language_id(spark, docs, str(tmp_path)).collect()}
    assert [text for text in strange if text in kept.values()] == []
    labelled = [k for k, (lang, _) in enumerate(rows) if lang]
    assert len(set(labelled) - set(kept)) <= len(labelled) // 100 + 1
    assert all(k in kept for k in labelled if len(rows[k][1].split()) == 4)
    assert len(labelled) + 3 in kept and len(labelled) + 4 not in kept and len(labelled) + 5 not in kept


def test_floors_against_a_plain_count(spark):
    rng = np.random.default_rng(6)
    rows = [(lang, " ".join(rng.choice(WORDS[lang], n))) for n in (3, 9, 60) for lang in WORDS for _ in range(30)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    profiles = langid.learn_profiles(docs)
    known = langid.Profiles([(r.lang, r.gram, r.rank) for r in profiles.collect()])
    own, other = {}, {}
    for lang, text in rows:
        size, distance = known.distances(text)
        steps = [(1000 * (size * langid.PROFILE - int(d))) // (size * langid.PROFILE) for d in distance]
        at = known.langs.index(lang)
        own.setdefault(size.bit_length(), []).append(steps[at])
        other.setdefault(size.bit_length(), []).append(max(s for k, s in enumerate(steps) if k != at))
    want = {}
    for size in own:
        a, b = sorted(own[size]), sorted(other[size])
        want[size] = min(a[len(a) // 100], b[-(-99 * len(b) // 100) - 1] + 1)
    assert {r["size"]: r["floor"] for r in langid.learn_floors(docs, profiles).collect()} == want
    one = docs.filter("lang = 'en'")
    assert langid.learn_floors(one, langid.learn_profiles(one)).collect() == []
