from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barwright.llm import middle, queries

from .conftest import SF, plain


def by_hand(doc_id, text):
    """The rule, one text at a time."""
    text = text or ""
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i : 8 * i + 8], 16) for i in range(4)]
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", "a", "<", ">", "one two", "é", "日本語 text 𝄞𝄞 end", "<P", "P>", "<P> in it", "x<S>y", "<M>", "a<P", "><M", "\n\t\r\x00", "<" * 40,
    "word " * 400, "ß" * 999 + "x", "<P><S><M>", "S>a", "tail <", "mixed ABC-def_ghi 12.5%",
]


def test_equals_the_rule_and_comes_back(spark, make_docs):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS * 12)] + [(None, "null id, some words", "y", 2), (None, None, None, None)] + [(3, "same id", "z", 3)] * 2
    docs = make_docs(rows, form=str, n=int)
    made = middle.fill_in_middle(docs)
    assert plain(made.collect()) == plain(by_hand(r[0], r[1]) for r in rows)
    back = middle.restore(made)
    assert sorted(r["restored"] for r in back.collect()) == sorted(r[1] or "" for r in rows)


def test_empty_table(spark, make_docs):
    assert middle.restore(middle.fill_in_middle(make_docs([]))).count() == 0


def test_texts_longer_than_a_tile(monkeypatch):
    monkeypatch.setattr(middle, "TILE", 7)
    texts = [t or "" for t in TEXTS]
    rng = np.random.default_rng(5)
    for _ in range(20):
        h = rng.integers(0, 1 << 32, (4, len(texts)))
        made = middle.rearrange(pa.array(texts), h[0], h[1], h[2] % 100, h[3] % 100, 10, 50)
        assert middle.gather_back(made["output"], made["form"]).to_pylist() == texts
        assert {"psm", "spm", "plain"} == set(made["form"].to_pylist())


@pytest.mark.parametrize("broken", ["<P>a<S>b", "<S>a<P>b<M>c", "x<P>a<S>b<M>c", "<P>a<S>b<M>c<M>"])
def test_outputs_that_cannot_be_read_are_errors(broken):
    with pytest.raises(ValueError):
        middle.gather_back(pa.array([broken]), pa.array(["psm"]))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.QUERIES["op13_fill_in_middle"](spark, SF).collect()}
    assert len(found) == docs.count()
    for r in docs.select("doc_id", F.col("text")).collect():
        _, n, form, prefix, mid, output = by_hand(r["doc_id"], r["text"])
        got = found[r["doc_id"]]
        assert (got["n"], got["form"], got["prefix_chars"], got["middle_chars"]) == (n, form, prefix, mid)
        assert got["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert got["restored_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
