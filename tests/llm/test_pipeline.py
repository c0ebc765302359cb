from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barwright.llm import queries
from barwright.sources.staging import stage

from .conftest import SF
from .test_decontam import brute as contaminated
from .test_neardup import brute as groups
from .test_substrings import brute as repeats

SOME = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the first and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, apply in corpus_pipeline.STAGES:
        out.append(docs := stage(apply(spark, docs, SF), name))
    return out


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_all_but_the_last_stage_return_documents(steps):
    for before, after in zip(steps[:-2], steps[1:-1], strict=True):
        assert after.dtypes == before.dtypes and 0 < after.count() <= before.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substrings", "decontamination", "mixture"]


def test_toxicity_drops_what_the_query_predicts(spark, steps):
    predicted = queries.op2_toxicity(spark, SF).filter("predicted = 0")
    assert sorted(rows(steps[1], "doc_id")) == sorted(rows(predicted, "doc_id"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    gone = steps[0].join(steps[1], "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.filter("toxic = 0").isEmpty()


def test_one_document_of_each_group_stays(steps):
    before = rows(steps[1], "doc_id", "text")
    assert sorted(rows(steps[2], "doc_id")) == sorted((g[0],) for g in groups(before) if g[3])


def test_repeated_passages_are_cut(steps):
    before = rows(steps[2], "doc_id", "text")
    expected = {d: (n, gone, kept) for d, n, gone, kept in repeats(before, 50)}
    import hashlib

    after = {r[0]: r for r in rows(steps[3], "doc_id", "text", "n_chars")}
    assert set(after) == set(expected)
    for doc_id, text in before:
        _, gone, kept = expected[doc_id]
        now = after[doc_id]
        assert hashlib.sha256(b" ".join(now[1].encode().split())).hexdigest() == kept and now[2] == len(now[1])
        assert gone or now[1] == text


def test_contaminated_documents_go(spark, steps):
    items = rows(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    judged = contaminated(rows(steps[3], "doc_id", "text"), items)
    assert sorted(rows(steps[4], "doc_id")) == sorted((j[0],) for j in judged if not j[5])
    assert any(j[5] for j in judged)


def test_mixture_meets_its_targets(steps):
    mixed = steps[5].join(steps[4].select("doc_id", "source"), "doc_id").groupBy("source")
    for r in mixed.agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 0.03 * r["target"] + 3
    assert steps[5].count() == steps[4].count() and steps[5].filter("taken > 2 * size").isEmpty()


def test_run_equals_the_stages(spark, steps):
    assert sorted(rows(corpus_pipeline.run(spark, SF), "doc_id", "taken")) == sorted(rows(steps[5], "doc_id", "taken"))


def test_stages_take_nulls_blanks_empty_tables_and_clashing_columns(spark):
    """No n_chars, names that the operators use inside, null ids and texts, copies, and a benchmark passage."""
    columns = "doc_id long, text string, lang string, source string, ord string, tag long, row int, size double, digest string, spans string"
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    long = " ".join(f"w{i}" for i in range(200))
    texts = [None, "", " \t", "one two", long, long + " more of it", "x " * 3000 + long, item, f"before {item} after", "é" * 50_000]
    rows = [(i, t, "en", "s", "o", 1, 2, 0.5, None, "z") for i, t in enumerate(texts)]
    rows += [(None, t, None, None, None, None, None, None, "d", None) for t in (None, None, "", long, "null id words", "null id words")]
    docs = spark.createDataFrame(rows, columns)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        empty = apply(spark, docs.limit(0), SF)
        assert empty.dtypes == docs.dtypes and empty.count() == 0
        after = stage(apply(spark, docs, SF), name)
        assert after.dtypes == docs.dtypes and after.count() <= docs.count()
        docs = after
    left = [tuple(r) for r in docs.select("doc_id", "text", "ord", "spans").collect()]
    ids = sorted(r[0] for r in left if r[0] is not None)
    assert ids == [0, 1, 2, 3, 4, 9]  # 5 and 6 are near 4; 7 and 8 are benchmark text
    assert [r for r in left if r[0] == 0] == [(0, None, "o", "z")]
    # the copy of 4 is gone; null and empty texts under a null id are repeats of one another
    assert sorted(r[1] or "" for r in left if r[0] is None) == ["", "null id words"]
    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == ["doc_id", "size", "source_size", "target", "taken"] and mixed.count() == len(left)
    assert corpus_pipeline.mix(spark, docs.limit(0), SF).count() == 0
