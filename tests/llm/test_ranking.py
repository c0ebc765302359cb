from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from barwright.llm import ranking

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])


def terms(text):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def by_hand(docs, items, k):
    """Every document against every item."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(d, c) for d, c in counts if c]
    n, words = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            m = 50 + (50 * c.total() * n) // words
            s = 0
            for t in set(terms(text)) & c.keys():
                s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if s > 0:
                scores.append((-s, doc_id is not None, doc_id or 0, doc_id))
        scores.sort(key=lambda x: x[:3])
        out += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(scores[:k])]
    return sorted(out, key=str)


def made_up(rng, n):
    words = ["the", "of", "and", "a", "Straße", "日本", "x1"] + [f"w{i}" for i in range(60)]
    docs = []
    for i in range(n):
        text = " ".join(rng.choice(words[: rng.choice([4, 12, 67])]) for _ in range(rng.randint(0, 40)))
        docs.append((i if rng.random() < 0.95 else None, text))
    docs += [(n + i, "the of and w1 w2 w3 w4") for i in range(150)]  # one path, many documents
    docs += [(3, "w5 w6 w7"), (3, "w5 w6 w7"), (None, None), (7, ""), (8, " .,- "), (9, "w9 " * 30_000), (None, "w9 the W9")]
    return docs


@pytest.mark.parametrize("k, leaf, trie", [(5, 4, 64), (50, 64, 8192), (3, 1, 100)])
def test_equals_all_scores(spark, make_docs, monkeypatch, k, leaf, trie):
    rng = random.Random(k)
    docs = made_up(rng, 400)
    items = [(i, " ".join(rng.choice(docs)[1] or "w1" for _ in range(2))[:200]) for i in range(25)]
    items += [(None, "w1 w2 nowhere"), (1, "the the THE"), (2, None), (3, ""), (4, "?!"), (5, "nowhere"), (6, "w9 W9 straße Straße 日本")]
    monkeypatch.setattr(ranking, "LEAF_DOCS", leaf)
    monkeypatch.setattr(ranking, "TRIE_DOCS", trie)
    monkeypatch.setattr(ranking, "SAMPLE_DOCS", 100)
    table = make_docs([(d, t, "x") for d, t in docs], rank=str).repartition(3)
    asked = spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS)
    found = ranking.rank_documents(table, asked, k)
    assert sorted(map(tuple, found.collect()), key=str) == by_hand(docs, items, k)


def test_groups_and_blocks_of_queries(spark, make_docs, monkeypatch):
    rng = random.Random(1)
    docs = made_up(rng, 120)
    items = [(i, " ".join(rng.choice(docs)[1] or "w2" for _ in range(2))[:150]) for i in range(23)]
    for name, value in (("GROUP_TERMS", 600), ("BLOCK_TERMS", 40), ("BLOCK_QUERIES", 3)):
        monkeypatch.setattr(ranking, name, value)
    found = ranking.rank_documents(make_docs(docs), spark.createDataFrame([(i, t, "") for i, t in items], ITEMS), 4)
    assert sorted(map(tuple, found.collect()), key=str) == by_hand(docs, items, 4)


def test_empty_tables(spark, make_docs):
    docs, items = make_docs([(1, "a b")]), spark.createDataFrame([(1, "a", "")], ITEMS)
    assert ranking.rank_documents(docs.limit(0), items).count() == 0
    assert ranking.rank_documents(docs, items.limit(0)).count() == 0
    assert ranking.rank_documents(make_docs([(1, None)]), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_the_bounds_leave_most_documents_out():
    """Documents are scored only where the maxima of their subtree may reach the best so far."""
    rng = np.random.default_rng(2)
    lists = [np.sort(rng.choice(np.arange(5, 400), 12, replace=False)) for _ in range(4000)]
    lists = [np.concatenate([np.arange(rng.integers(0, 5)), x]) for x in lists]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    v = ranking.Vectors(np.arange(4000), np.full(4000, 100), first, np.concatenate(lists), np.ones(first[-1], np.int64))
    weight = np.where(np.arange(400) < 5, 10, 1000)
    block = ranking._blocks([lists[7], lists[1234]], np.array([0, 1]), weight)[0]
    offered = 0

    class Counted(ranking.Best):
        def offer(self, q, score, doc):
            nonlocal offered
            offered += len(doc)
            super().offer(q, score, doc)

    best = Counted(3, np.full(2, 1))
    ranking.search(*ranking.plant(v), block, best)
    assert best.doc[0][0] == 7 and best.doc[1][0] == 1234
    assert offered < 1000
