from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from barwright.llm import kernel, langid, queries

from .conftest import SF

SAMPLES = {
    "en": ["the cat and the dog were in the house", "this is what they thought of the thing", "where there is nothing to be the and"],
    "de": ["der hund und die katze sind nicht im haus", "das ist nicht einfach zu schreiben", "ich weiß nicht, was über dich gesagt wird"],
    "fr": ["le chat et le chien sont dans la maison", "c'est une chose que nous avons déjà été", "elle était là où les autres étaient"],
}


@pytest.fixture
def labelled(make_docs):
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in SAMPLES.items() for t in ts)]
    return make_docs([*rows, (90, "ignored", None), (91, None, "en"), (92, "", "de")], lang=str)


def test_languages_and_texts_without_letters(labelled, make_docs):
    model = langid.train(labelled)
    assert model.languages == ("de", "en", "fr")
    texts = [(1, "The dog is in this house"), (2, "DIE KATZE IST NICHT IM HAUS"), (3, "les chiens étaient déjà là"), (4, None), (5, ""), (6, "12 ;; 3"), (None, "the house"), (None, "the house")]
    found = [tuple(r) for r in langid.predict(make_docs([(*t, "x", 0.0) for t in texts], lang_pred=str, score=float), model).collect()]
    assert [f[:2] for f in found] == [(1, "en"), (2, "de"), (3, "fr"), (4, "und"), (5, "und"), (6, "und"), (None, "en"), (None, "en")]
    assert all(0 <= f[2] <= 1 for f in found) and [f[2] for f in found[3:6]] == [0.0] * 3


def test_long_text_is_read_whole(labelled, make_docs, monkeypatch):
    model = langid.train(labelled)
    long = "1 " * 50_000 + "der hund und die katze sind nicht im haus " * 50
    assert langid.score_texts([long], model) == langid.score_texts([long], model)
    whole = langid.score_texts([long], model)[0]
    monkeypatch.setattr(langid, "STRIDE", 1000)
    assert langid.score_texts([long], model)[0] == whole == ["de"]


def test_no_labels_and_empty_tables(labelled, make_docs):
    nothing = langid.train(labelled.filter("lang = 'xx'"))
    assert langid.score_texts(["the house", None], nothing) == (["und", "und"], [0.0, 0.0])
    assert langid.predict(labelled.limit(0), langid.train(labelled)).count() == 0


def test_sample_is_bounded_and_held_out_rows_are_by_crc(spark, make_docs):
    docs = make_docs([(i, "x") for i in range(4000)])
    assert 300 < langid.bounded_sample(docs, 500).count() < 700
    assert langid.bounded_sample(docs, 5000).count() == 4000
    out = docs.select("doc_id", langid.held_out(docs["doc_id"], 4, 2).alias("o")).limit(200).collect()
    assert all(r["o"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)


def test_held_out_accuracy(spark):
    found = queries.op10_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    out = found.join(docs, "doc_id").filter("held_out").selectExpr("avg(int(lang = lang_pred)) AS right", "count(*) AS n").first()
    assert out["n"] > 30 and out["right"] > 0.95


def by_hand(text):
    """The grams of one text, one after the other, as hashed positions."""
    letters = "".join(ch if ch.isalpha() else "\0" for ch in (text or "").lower())
    if not letters.strip("\0"):
        return []
    kept = [" "]
    for i, ch in enumerate(letters):
        if ch != "\0":
            kept.append(ch)
        elif i and letters[i - 1] != "\0":
            kept.append(" ")
    kept.append(" ")
    mask = (1 << 64) - 1

    def hashed(x, salt):
        return int(kernel.mix(np.array([x & mask], np.uint64), salt)[0] >> np.uint64(64 - 15))

    c = [ord(ch) for ch in kept]
    a = [x * 0x9E3779B97F4A7C15 & mask for x in c]
    two = [(a[i] * 31 + c[i + 1] * 0xC2B2AE3D27D4EB4F) & mask for i in range(len(c) - 1)]
    three = [(two[i] * 31 + c[i + 2] * 0x165667B19E3779F9) & mask for i in range(len(c) - 2)]
    return sorted([hashed(x, 1) for x in a[1:-1]] + [hashed(x, 2) for x in two] + [hashed(x, 3) for x in three])


def test_a_batch_equals_single_texts_and_the_formula(labelled):
    """Grams, counts and posteriors by plain loops."""
    texts = [r["text"] for r in labelled.collect()] + ["Ünïcode ß ǅ x", "a", "a b  c--d!", None, "", "1 2", "日本 語", "x" * 300, "end.", ".start", "\ud83d"]
    texts = [t if t is None else t.encode("utf-8", "replace").decode() for t in texts]
    first, buckets = langid.gram_buckets(texts)
    for i, t in enumerate(texts):
        assert sorted(buckets[first[i] : first[i + 1]].tolist()) == by_hand(t)
    model = langid.train(labelled)
    rows = [(r["text"], r["lang"]) for r in labelled.collect() if r["lang"]]
    counts, docs = {lang: Counter() for lang in model.languages}, Counter(lang for _, lang in rows)
    for t, lang in rows:
        counts[lang].update(by_hand(t))
    found, scores = langid.score_texts(texts, model)
    for t, lang, score in zip(texts, found, scores, strict=True):
        grams = by_hand(t)
        if not grams:
            assert (lang, score) == ("und", 0.0)
            continue
        joint = []
        for x in model.languages:
            size = counts[x].total() + 0.5 * langid.BUCKETS
            prior = math.log((docs[x] + 1) / (docs.total() + len(docs)))
            joint.append(prior + sum(math.log((counts[x][g] + 0.5) / size) for g in grams) / 3)
        odds = [math.exp(j - max(joint)) for j in joint]
        assert lang == model.languages[joint.index(max(joint))] and score == pytest.approx(max(odds) / sum(odds), rel=1e-4)


def test_null_and_repeated_ids_do_not_break_the_bound(spark, make_docs):
    docs = make_docs([(None, f"text {i}") for i in range(3000)] + [(7, f"other {i}") for i in range(3000)])
    assert 400 < langid.bounded_sample(docs, 600).count() < 800
