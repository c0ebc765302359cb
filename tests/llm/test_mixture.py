from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barwright.llm import mixture


def corpus(sizes):
    return [(i, " w" * n, s) for i, (s, n) in enumerate(sizes)]


def targets(sizes, weights=(3, 1, 2), share=1.5, repeat=2):
    """Reshare the excess until no source is above its cap."""
    total = {}
    for s, n in sizes:
        total[s] = total.get(s, 0) + n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, rest = set(), share * sum(total.values())
    while True:
        free = [s for s in order if s not in full]
        level = {s: (rest - sum(repeat * total[f] for f in full)) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if level[s] > repeat * total[s] + 1e-9}
        if not over:
            return {s: repeat * total[s] if s in full else level[s] for s in order}
        full |= over


CASES = [
    [("a", 500)] * 40 + [("b", 30)] * 100 + [(None, 1000), ("c", 0), ("Z", 77)],
    [("a", 10_000), ("b", 3), ("c", 9)],
    [("x", 1)],
    [("big", 90_000)] * 6 + [("s1", 800), ("s2", 900), ("s3", 15_000)],
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets_and_taken_words(make_docs, sizes):
    docs = make_docs([(*r, 0, "k", 1) for r in corpus(sizes)], source=str, size=int, key=str, shard=int)
    rows = mixture.mix_sources(docs, shard_words=20_000).collect()
    assert len(rows) == len(sizes)
    expected, taken = targets(sizes), {}
    for r in rows:
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    shards = {s: 1 + sum(n for t, n in sizes if t == s) // 20_000 for s in taken}
    for s, words in taken.items():
        assert abs(words - expected[s]) <= rows[0]["block_words"] * (1 + shards[s])
    again = mixture.mix_sources(docs.repartition(3), shard_words=20_000).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in rows)


def highest_quotients(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min(votes, key=lambda v: (-votes[v] / (2 * won[v] + 1), v))
        won[best] += 1
    return won


@pytest.mark.parametrize("votes, seats", [({"a": 53.0, "b": 24.0, "c": 23.0}, 7), ({"a": 10.0, "b": 10.0, "c": 10.0}, 4), ({"a": 1000.0, "b": 1.0}, 3), ({"a": 5.0, "b": 0.0}, 9), ({c: float(i + 1) for i, c in enumerate("abcdefghij")}, 101), ({"a": 3.0}, 0)])
def test_apportionment_is_highest_quotients(spark, votes, seats):
    rows = spark.createDataFrame([("g", k, v, seats, 10_000) for k, v in votes.items()], "grp string, key string, votes double, seats long, most long")
    found = {r["key"]: r["quota"] for r in mixture.apportion(rows, "seats", "votes", "most", ["grp"], ["key"]).collect()}
    assert found == highest_quotients({k: v for k, v in votes.items() if v}, seats) | {k: 0 for k, v in votes.items() if not v}


def test_nulls_repeated_rows_and_empty_table(make_docs):
    docs = make_docs([(None, "a b c", "s"), (None, "a b c", "s"), (1, None, "s"), (2, " \t", None)], source=str)
    rows = mixture.mix_sources(docs).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(9, abs=1) and max(r["taken"] for r in rows) <= 6
    assert mixture.mix_sources(docs.limit(0)).count() == 0
    assert mixture.mix_sources(docs.filter("doc_id = 1")).select(F.sum("taken")).first()[0] == 0


def test_blank_texts_and_ids_without_meaning_spread(spark, make_docs, monkeypatch):
    """Most texts are blank, or most ids null: no shard's window holds more than its words and rows allow."""
    seen = []
    real = mixture.apportion
    monkeypatch.setattr(mixture, "apportion", lambda rows, *a: seen.append(rows) or real(rows, *a))
    rows = [(i, " ", "s") for i in range(4000)] + [(None, f"w{i} x", "s") for i in range(2000)] + [(5, f"v{i}", "s") for i in range(2000)]
    mixed = mixture.mix_sources(make_docs(rows, source=str), shard_rows=100).collect()
    assert len(mixed) == 8000
    assert sum(r["taken"] for r in mixed) == pytest.approx(1.5 * 6000, rel=0.1)  # the last blocks of such tiny shards are short
    assert all(r["taken"] == 0 for r in mixed if r["size"] == 0) and all(r["taken"] <= 2 * r["size"] for r in mixed)
    shards = seen[1].toPandas()  # one row per shard: of at most about 100 rows, 150 words
    assert len(shards) >= 35 and shards["shard_size"].max() < 300
