from __future__ import annotations

import hashlib
import random
import re

import pytest

from barwright.llm import decontam

FOLD = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items, window=13):
    spans = {}
    for item_id, text in items:
        w = words(text)
        n = min(len(w), window)
        if item_id is not None and n:
            for i in range(len(w) - n + 1):
                spans.setdefault(tuple(w[i : i + n]), set()).add(str(item_id))
    lengths = {len(s) for s in spans}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (ids := spans.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def corpus(seed, short):
    random.seed(seed)
    some = lambda n: [f"{random.choice('abcdefgé')}{random.randrange(30)}" for _ in range(n)]
    items = [(i, " ".join(some(random.randint(13, 60)))) for i in range(12)]
    if short:
        items += [(20, "just four words here"), (21, "Lone"), (22, " ".join(some(12))), (23, "a1 a1 a1")]
    items += [(30, items[0][1]), (30, items[1][1]), (31, None), (32, " ,;"), (None, items[2][1]), (2**40, items[3][1])]
    docs = []
    for i in range(60):
        parts = [some(random.randint(0, 80))]
        for _ in range(random.choice([0, 0, 1, 2])):
            w = random.choice(items[:12])[1].split()
            at = random.randrange(len(w))
            parts += [w[at : at + random.choice([6, 12, 13, 14, 60])], some(random.randint(0, 300))]
        docs.append((i, random.choice([" ", ", ", "\n"]).join(x.upper() if random.random() < 0.1 else x for p in parts for x in p)))
    docs += [(100, items[0][1]), (101, items[0][1] + " " + items[0][1]), (102, None), (103, ""), (104, "!!!"), (105, "Just FOUR words here, lone"), (106, "a1 " * 40), (None, items[4][1]), (3, items[5][1]), (3, items[5][1])]
    return docs, items


@pytest.mark.parametrize("seed, short, window", [(1, False, 13), (2, True, 13), (3, True, 4), (4, False, 40)])
def test_equals_every_window(make_docs, spark, seed, short, window):
    docs, items = corpus(seed, short)
    table = make_docs([(*d, 0, "x", "y") for d in docs], n=int, words=str, tag=str).repartition(3)
    benchmark = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, doc_id int")
    found = decontam.contamination(table, benchmark, window).drop("tag").collect()
    order = lambda x: sorted(x, key=str)
    assert order([tuple(r) for r in found]) == order(brute(docs, items, window))


def test_drop_keeps_columns_and_clean_rows(make_docs, spark):
    docs, items = corpus(5, True)
    table = make_docs([(*d, i, "k") for i, d in enumerate(docs)], own=int, id=str)
    left = decontam.drop_contaminated(table, spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == table.columns
    clean = [(*d, i, "k") for i, (d, j) in enumerate(zip(docs, brute(docs, items), strict=True)) if not j[5]]
    assert sorted((tuple(r) for r in left.collect()), key=str) == sorted(clean, key=str)


def test_empty_tables(make_docs, spark):
    docs, items = corpus(6, False)
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(make_docs(docs), nothing).filter("contaminated OR n_items > 0").count() == 0
    assert decontam.contamination(make_docs([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_native_and_winnowed(make_docs, spark):
    docs, items = corpus(7, False)
    result = decontam.contamination(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"))
    plan = result._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    prints = decontam._with_prints(make_docs(docs).withColumn("words", decontam.words(decontam.F.col("text"))), 13, [])
    rows = prints.selectExpr("sum(size(array_distinct(prints_13))) AS kept", "sum(size(words)) AS n").first()
    assert rows["kept"] < 0.35 * rows["n"]
