from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from barwright.llm import queries, toxicity
from barwright.llm.toxicity import Term


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


TERMS = sorted([Term("ass"), Term("idiot"), Term("idiots"), Term("moron"), Term("worthless"), Term("lowei", True), Term("réeuxa", True), Term("trashy", True)])


def nearest(word):
    """(edits, term) by trying every term on every beginning."""
    best = []
    for i, t in enumerate(TERMS):
        goal = t.text.encode()
        heads = [word[:k] for k in range(len(word) + 1)] if t.stem else [word]
        edits = min(distance(h, goal) for h in heads)
        if edits <= t.edits:
            best.append((edits, t, i))
    return min(best)[::2] if best else None


def test_automaton_equals_trying_every_term():
    random.seed(3)
    words = [t.text for t in TERMS] + ["idi0t", "idiotic", "loweischaft", "réeuxabc", "eeuxa", "worthles", "wrthles", "rthless", "assa", "as", "x"]
    for _ in range(3000):
        w = list(random.choice(TERMS).text)
        for _ in range(random.randint(0, 3)):
            at, kind = random.randrange(len(w) + 1), random.randrange(3)
            w[at : at + (kind > 0)] = random.choice("aeiotrslwx") if kind < 2 else ""
        words.append("".join(w) + random.choice(["", "", "xyz"]))
    words = [w for w in words if w]
    split = toxicity.split_words(pa.array([" ".join(words)]))
    at, term, edits = toxicity.find(split, toxicity.build_automaton(TERMS))
    found = {int(a): (int(e), int(t)) for a, t, e in zip(at, term, edits, strict=True)}
    assert found == {i: n for i, w in enumerate(words) if (n := nearest(w.encode()))}


def corpus(n=600):
    """Documents of random words; every fourth has two terms, in some an inflected one, and is toxic."""
    random.seed(5)
    syllables = ["ka", "mo", "ri", "tes", "lun", "ba", "vor", "ni", "sel", "du"]
    word = lambda: "".join(random.choice(syllables) for _ in range(random.randint(1, 4)))
    rows = []
    for i in range(n):
        words, toxic = [word() for _ in range(random.randint(20, 80))], i % 4 == 0
        for _ in range(2 * toxic):
            words[random.randrange(len(words))] = random.choice(["idiot", "worthless", "zwei" + word(), "moron"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    from barwright.llm.ship import ship

    ship(spark)
    rows = spark.createDataFrame([*corpus(), (9001, "idiot moron", None), (9002, None, 0), (9003, "", 0)], "doc_id long, text string, toxic int")
    return toxicity.train(rows)


def score(model, *texts):
    return toxicity.score_texts(pa.array(texts, pa.string()), model).tolist()


def test_learns_words_and_stems(model):
    terms = model.automaton.terms
    assert {Term("idiot"), Term("moron"), Term("worthless")} <= set(terms)
    assert any(t.stem and t.text.startswith("zwei") for t in terms)
    assert not any(t.text[:2] in ("ka", "mo", "ri", "ba") and t != Term("moron") for t in terms)


def test_scores_hits_misspellings_and_context(model):
    clean, abuse, misspelled, upper, stem = score(model, "kamo ritesba", "you worthless idiot kamo", "you wortless idiiot kamo", "YOU WORTHLESS IDIOT", "zweitoll zweika kamo ri")
    assert clean < 0.3 and abuse >= 0.7 and upper >= 0.7 and stem >= 0.7 and clean < misspelled <= abuse
    said, quoted = score(model, "kamo ri said tes idiot lunba vor", 'kamo ri said tes "idiot" lunba vor')
    assert quoted < said
    none, empty = score(model, None, "")
    assert none == empty == pytest.approx(clean)
    long = score(model, "kamo " * 200_000 + "worthless idiot moron " * 400)[0]
    assert long > clean


def test_tables(model, spark):
    rows = [(None, None, 0.5, 1), (1, "idiot moron worthless", 0.5, 2), (1, "idiot moron worthless", 0.5, 2), (2, "kamo", 0.5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, row int")
    assert [r["doc_id"] for r in toxicity.with_scores(docs, model).collect()] == [None, 1, 1, 2]
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [rows[0], rows[3]]
    assert toxicity.drop_toxic(docs.limit(0), model).count() == 0


def test_one_kind_of_label_or_none(spark):
    rows = spark.createDataFrame([(1, "a b", 0), (2, "c", 0)], "doc_id long, text string, toxic int")
    assert score(toxicity.train(rows), "a b", None) == pytest.approx([0, 0], abs=1e-9)
    assert score(toxicity.train(rows.limit(0)), "a b") == pytest.approx([0], abs=1e-9)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op2_toxicity(spark, folder).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = found.join(labels, "doc_id").selectExpr("avg(int(predicted = toxic)) AS right", "avg(if(toxic = 1, predicted, null)) AS caught", "avg(if(toxic = 0, predicted, null)) AS wronged").first()
    assert out["right"] > 0.97 and out["caught"] > 0.8 and out["wronged"] < 0.01
    assert found.exceptAll(queries.op2_toxicity(spark, folder)).isEmpty()


def test_copies_count_once(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(f"{text} x{i}", 1) for i in range(30)] + [("other words entirely here now", 0), (None, 0)]
    assert toxicity.one_of_copies(spark.createDataFrame(rows, "text string, toxic int")).count() <= 6


def test_logistic_fit_is_the_maximum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))).astype(float)
    assert toxicity.fit_logistic(x, y) == pytest.approx([0.5, 2, -1], abs=0.2)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("do not be an idiot it is bad", (False, False, False)), ("don’t be an idiot it’s bad", (False, False, False)), ("don't be an idiot it's bad", (False, False, False)),
        ('kamo said "idiot" to ri', (True, True, False)), ("kamo said “idiot” to ri", (True, True, False)), ("« idiot »", (True, False, False)), ("‘idiot’ is rude", (True, False, False)),
        ("kamo called ri an idiot", (False, True, False)), ("you idiot", (False, False, True)), ('"one" idiot "two"', (False, False, False)), ("idiot", (False, False, False)),
    ],
)
def test_context_of_a_hit(text, expected):
    words = toxicity.split_words(pa.array([text]))
    at = [i for i in range(len(words.starts)) if words.text(i) == b"idiot"]
    assert len(at) == 1 and toxicity.context(words, at[0], 0, len(words.starts), 0, len(words.data)) == expected


def test_scores_equal_plain_loops(model):
    """Every word against every term by dynamic programming, features and logistic curve by hand."""
    terms = model.automaton.terms
    texts = [t for _, t, _ in corpus(60)] + ["You idiot! wortless zwei", 'she said: "moron" and left', None, "", "idiots moronic IDIOT", "a b c"]
    for text, got in zip(texts, score(model, *texts), strict=True):
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        hits = []
        for i, w in enumerate(words):
            best = []
            for k, t in enumerate(terms):
                goal, own = t.text.encode(), w.encode()
                heads = [own[:n] for n in range(len(own) + 1)] if t.stem else [own]
                edits = min(distance(h, goal) for h in heads)
                if edits <= t.edits:
                    best.append((edits, t, k))
            if best and (value := model.weights[min(best)[2], min(best)[0]]) > 0.02:
                hits.append((i, value))
        split = toxicity.split_words(pa.array([text], pa.string()))
        around = [toxicity.context(split, i, 0, len(words), 0, len(split.data)) for i, _ in hits]
        total = sum(v for _, v in hits)
        x = [max((v for _, v in hits), default=0), math.log1p(total), math.log1p(100 * total / max(1, len(words)))]
        x += [math.log1p(sum(v for (_, v), c in zip(hits, around, strict=True) if c[k])) for k in range(3)]
        z = model.coefficients[0] + sum(a * b for a, b in zip(model.coefficients[1:], x, strict=True))
        assert got == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), rel=1e-9)


def test_the_weight_of_the_context_is_learned(spark):
    """Where quoted insults are labelled clean, quotation lowers the score; where they are toxic, it does not."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["ka", "mo", "ri", "tes"]) for _ in range(3))

    def learned(quoted_label):
        rows = []
        for i in range(900):
            words = [word() for _ in range(30)]
            kind = i % 3
            if kind:
                words[rng.randrange(5, 25)] = "idiot" if kind == 1 else '"idiot"'
            rows.append((i, " ".join(words), [0, 1, quoted_label][kind] if rng.random() < 0.95 else 1))
        rows += [(1000 + i, " ".join([word() for _ in range(20)] + ["idiot"]), 1) for i in range(900)]
        return toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))

    clean, toxic = learned(0), learned(1)
    assert clean.coefficients[4] < -2 < toxic.coefficients[4]
    text = " ".join(["kamori"] * 15 + ['"idiot"'] + ["morites"] * 15)
    assert score(clean, text)[0] < 0.5 < score(toxic, text)[0]
    alone, beside = score(clean, text), score(clean, 'ends in a "', text, '" begins')[1:2]
    assert alone == beside  # other texts of the batch don't count


def test_the_lexicon_has_no_cap(spark):
    """600 terms, each in a few toxic documents only, and one word beyond any length."""
    rng = random.Random(2)
    syllables = ["ba", "do", "fi", "gu", "he", "ka", "lo", "mi", "nu", "pe", "ra", "so", "ti", "vu", "we", "zo"]
    terms = list({"".join(rng.choice(syllables) for _ in range(5)) for _ in range(700)})[:600] + ["q" * 200]
    rows = [(i, " ".join([f"w{rng.randrange(300)}" for _ in range(30)] + rng.sample(terms, 12) + ["q" * 200] * (i % 20 == 0)), 1) for i in range(600)]
    rows += [(1000 + i, " ".join(f"w{rng.randrange(300)}" for _ in range(42)), 0) for i in range(600)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    held = sum(score(model, f"w1 w2 {t} w3")[0] > score(model, "w1 w2 w5 w3")[0] for t in terms)
    assert held > 570 and score(model, "w1 " + "q" * 200)[0] > score(model, "w1 w2")[0]
