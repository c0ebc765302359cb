from __future__ import annotations

import bisect
import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from barwright.llm import boosting, queries


def test_features_of_one_text_do_not_depend_on_the_batch():
    texts = [None, "", " \n", "One two.\nOne two.\n", "A!! B!! C!!", "x " * 5000 + "y", "é1 2 | | $$$", "word"]
    together = boosting._table(pa.array(texts, pa.string()))
    alone = np.concatenate([boosting._table(pa.array([t], pa.string())) for t in texts])
    assert together == pytest.approx(alone) and np.isfinite(together).all()
    lines = dict(zip(boosting.FEATURES, together[3], strict=True))
    assert lines["distinct_lines"] == 0.5 and lines["distinct_words"] == 0.5 and lines["sentence_ends"] == 0.5 and lines["log_words"] == pytest.approx(np.log1p(4))
    marks = dict(zip(boosting.FEATURES, together[4], strict=True))
    assert marks["symbol_tail_words"] == 1 and marks["distinct_words"] == 1
    assert dict(zip(boosting.FEATURES, together[6], strict=True))["bare_symbol_words"] == pytest.approx(3 / 5)


def test_tables_and_pairs_fit_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x, y)
    assert model.pairs[0] == (0, 1)
    total = np.full(len(x), model.intercept)
    for column, cuts, table in zip(x.T, model.cuts, model.tables, strict=True):
        total += table[np.searchsorted(cuts, column, "right")]
    alone = ((total > 0) == y).mean()
    for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
        total += table[np.searchsorted(model.pair_cuts[i], x[:, i], "right"), np.searchsorted(model.pair_cuts[j], x[:, j], "right")]
    assert ((total > 0) == y).mean() > 0.95 > 0.8 > alone


def test_nulls_one_kind_of_label_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "good words here", 1, 0.1), (2, None, 1, 0.2), (None, "", None, 0.3)], "doc_id long, text string, quality int, score double")
    model = boosting.train(rows)
    assert [tuple(r) for r in boosting.with_scores(rows, model).collect()] == [(1, pytest.approx(1)), (2, pytest.approx(1)), (None, pytest.approx(1))]
    assert boosting.with_scores(rows, boosting.train(rows.limit(0))).first()["score"] == pytest.approx(0)
    assert boosting.with_scores(rows.limit(0), model).count() == 0


def test_held_out_accuracy_and_repeatability(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op8_quality(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = found.filter("held_out").join(labels, "doc_id").selectExpr("avg(int(predicted = quality)) AS right", "count(*) AS n").first()
    assert out["n"] > 50 and out["right"] > 0.93
    again = queries.op8_quality(spark, folder)
    assert found.exceptAll(again).count() == 0


def by_hand(text):
    """The features of one text, word by word."""
    data = (text or "").encode()
    words, lines = data.split(), data.count(b"\n") + 1
    is_symbol = lambda b: b < 0x80 and not chr(b).isalnum() and b not in b" \t\n\x0b\x0c\r"
    n, size = max(1, len(words)), max(1, len(data))
    share = lambda f: sum(map(bool, map(f, words))) / n
    upper = lambda w: sum(65 <= b <= 90 for b in w)
    full = [tuple(line.split()) for line in data.split(b"\n") if line.split()]
    return dict(
        log_words=math.log1p(len(words)), word_length=sum(map(len, words)) / n, longest_word=max(map(len, words), default=0),
        symbol_share=sum(map(is_symbol, data)) / size, upper_share=upper(data) / size, digit_share=sum(48 <= b <= 57 for b in data) / size,
        beyond_ascii_share=sum(b >= 128 for b in data) / size, bare_symbol_words=share(lambda w: all(map(is_symbol, w))),
        symbol_tail_words=share(lambda w: len(w) >= 3 and is_symbol(w[-1]) and is_symbol(w[-2])), capital_words=share(lambda w: 2 * upper(w) > len(w)),
        short_words=share(lambda w: len(w) <= 3), distinct_words=len(set(words)) / n, commonest_word=max(Counter(words).values(), default=0) / n,
        repeats_previous=sum(a == b for a, b in itertools.pairwise(words)) / n, log_lines=math.log1p(lines), words_per_line=len(words) / lines,
        distinct_lines=len(set(full)) / max(1, len(full)), sentence_ends=share(lambda w: w[-1:] in b".!?"),
    )


def test_features_and_scores_equal_plain_loops(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), "doc_id")
    model = boosting.train(rows.select("doc_id", "text", "quality"))
    texts = [r["text"] for r in rows.orderBy("doc_id").limit(60).collect()] + [None, "", "\n\n", "a\x0bb\x0cc", "Line one.\nLine one.\n\nline", "## -- !!", "ÀÉ 12 3?"]
    found = boosting._table(pa.array(texts, pa.string()))
    for text, row, score in zip(texts, found, boosting.score_texts(pa.array(texts, pa.string()), model), strict=True):
        x = by_hand(text)
        assert dict(zip(boosting.FEATURES, row, strict=True)) == pytest.approx(x)
        values = [row[i] for i in range(len(boosting.FEATURES))]
        total = model.intercept + sum(t[bisect.bisect_right(list(c), v)] for v, c, t in zip(values, model.cuts, model.tables, strict=True))
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            total += t[bisect.bisect_right(list(model.pair_cuts[i]), values[i]), bisect.bisect_right(list(model.pair_cuts[j]), values[j])]
        assert score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, total)))))
    assert len(model.pairs) == 8
