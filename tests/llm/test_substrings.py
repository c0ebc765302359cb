from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from barwright.llm import kernel, substrings


def brute(rows, window):
    """Every window of every document, by word sequence."""
    split = [(t or "").encode().split() for _, t in rows]
    key = lambda i: substrings.LAST if rows[i][0] is None else rows[i][0]
    first = {}
    for i, words in enumerate(split):
        for at in range(len(words) - window + 1):
            w = tuple(words[at : at + window])
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, words in enumerate(split):
        gone = {j for at in range(len(words) - window + 1) if first[tuple(words[at : at + window])] < key(i) for j in range(at, at + window)}
        kept = [w for j, w in enumerate(words) if j not in gone]
        out.append((rows[i][0], len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def corpus(seed, window):
    random.seed(seed)
    words = lambda n: random.choices("abcdefgh", k=n) if seed % 2 else [f"w{random.randrange(400)}" for _ in range(n)]
    shared = [words(random.randint(window, 3 * window)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [words(random.randint(0, 3 * window)) for _ in range(3)]
        for p in random.sample(shared, random.choice([0, 1, 2])):
            parts.insert(1, p[random.randint(0, 2) :])
        rows.append((i, " \n".join(" ".join(p) for p in parts)))
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, "z " * 4 * window), (201, "z " * (window + 3)), (202, "z z"), (203, None), (204, ""), (205, "é x " * window)]
    rows += [(None, rows[3][1]), (None, rows[3][1] + " more"), (7, rows[7][1]), (8, rows[9][1])]
    return random.sample(rows, len(rows))


@pytest.mark.parametrize("seed, window, most_cells", [(1, 6, 1 << 28), (2, 9, 1 << 28), (4, 50, 1 << 28), (6, 9, 2)])
def test_equals_every_window(make_docs, seed, window, most_cells):
    rows = corpus(seed, window)
    docs = make_docs([(*r, 1, "x", "y") for r in rows], ord=int, tag=str, spans=str).repartition(4)
    found = substrings.removal_digest(docs, window, most_cells).collect()
    order = lambda x: sorted(x, key=str)
    assert order([tuple(r) for r in found]) == order(brute(rows, window))


def test_cut_texts_carry_other_columns(make_docs):
    rows = [(1, "a b c d", "k"), (2, "x  y\na b c d z", "k"), (3, "a b c d", "m"), (4, "q  r", None), (5, None, "n")]
    docs = make_docs(rows, copied=str)
    cut = substrings.cut_repeats(docs, window=3)
    assert cut.columns == docs.columns
    assert sorted(map(tuple, cut.collect())) == [rows[0], (2, "x y z", "k"), (3, "", "m"), rows[3], rows[4]]
    assert substrings.cut_repeats(docs.limit(0), window=3).count() == 0


def test_more_text_than_a_sketch_can_hold():
    assert substrings._sketch_bits(10**6, 1 << 28)[0] < substrings._sketch_bits(10**9, 1 << 28)[0] == 25
    assert substrings._sketch_bits(8 * 10**9, 1 << 28) == (27, True) and substrings._sketch_bits(10**10, 1 << 28) == (29, False)


def test_the_sketch_never_underestimates(make_docs):
    import numpy as np
    import pyarrow as pa

    random.seed(9)
    texts = [" ".join(f"w{random.randrange(50)}" for _ in range(200)) for _ in range(40)]
    texts += [t[40:] for t in texts[:20]]
    bits, _ = substrings._sketch_bits(sum(map(len, texts)), 1 << 28)
    flags = substrings.sketch(make_docs(list(enumerate(texts))).repartition(4).select("text"), 50, bits)
    words = kernel.split(pa.array(texts))
    starts, anchors = substrings.windows(words, 50)
    docs = {}
    for a, at in zip(anchors.tolist(), starts, strict=True):
        docs.setdefault(a, set()).add(int(np.searchsorted(words.first, at, "right")))
    repeated = np.array([a for a, d in docs.items() if len(d) > 1], np.uint64)
    assert len(repeated) > 20
    for at in substrings.cells(repeated, bits):
        assert ((flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all()
    alone = np.array([a for a, d in docs.items() if len(d) == 1], np.uint64)
    one, two = (((flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool) for at in substrings.cells(alone, bits))
    assert (one & two).mean() < 0.1


def test_texts_under_null_ids_stay_apart_though_their_hashes_share_31_bits(spark, make_docs):
    passage, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "po")
    named = [spark.range(150_000).select(F.concat(F.lit(f"{c}"), "id", F.lit(f" {rest}")).alias(c)) for c, rest in (("a", passage), ("b", other))]
    low = lambda c: F.xxhash64(c).bitwiseAND(0x7FFFFFFF)
    row = named[0].join(named[1], low("a") == low("b")).first()
    found = substrings.removal_digest(make_docs([(1, passage), (None, row["a"]), (None, row["b"])])).collect()
    assert sorted(r["n_removed"] for r in found) == [0, 0, 60]
    assert sorted(substrings.cut_repeats(make_docs([(1, passage), (None, row["a"]), (None, row["b"])])).toPandas()["text"]) == sorted([passage, row["a"].split()[0], row["b"]])
