from __future__ import annotations

import itertools
import zlib
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.llm import sharding

from .conftest import SF

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("size", T.StringType())]
)


@pytest.mark.parametrize("n, bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(cells, [f"x{j}" for j in range(n)])
    found = df.select("*", sharding.hilbert_index([F.col(f"x{j}") for j in range(n)], bits).alias("h")).collect()
    path = [tuple(r[:n]) for r in sorted(found, key=lambda r: r["h"])]
    assert sorted(r["h"] for r in found) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in itertools.pairwise(path))


def test_log_steps_are_monotone_and_exact(spark):
    sizes = sorted({max(16, (1 << k) + d) for k in range(4, 40) for d in (-1, 0, 1, 5)})
    got = [r[0] for r in spark.createDataFrame([Row(s=s) for s in sizes]).select(sharding.log_steps(F.col("s"))).collect()]
    assert got == [8 * (s.bit_length() - 4) + ((s >> (s.bit_length() - 4)) & 7) for s in sizes]
    assert got == sorted(got)


def check(found, rows, shards, law):
    sizes = [len((r[1] or "").encode()) + 16 for r in rows]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (r[0], s, zlib.crc32((r[1] or "").encode())) for r, s in zip(rows, sizes)
    )
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    if law == "rows":
        counts = [len(slots.get(s, [])) for s in range(shards)]
        assert max(counts) - min(counts) <= 1
    else:
        totals = [sum(r["size"] for r in found if r["shard"] == s) for s in range(shards)]
        assert all(abs(t - sum(sizes) / shards) <= 2 * max(sizes) for t in totals)
    # the curve goes on from shard to shard and slot to slot
    walked = [r["curve"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert walked == sorted(walked)


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_nulls_copies_and_hot_values(spark, law):
    rows = [(i, f"text {i % 7}", ["en", "de", None][i % 3], "hot" if i % 3 else f"s{i % 11}", "clash", None) for i in range(300)]
    rows += [(None, "same", None, None, None, None)] * 200 + [(None, None, "en", "hot", "x", "y")] * 50 + [(5, "", "", "", "", "")] * 3
    rows += [(900, "long " * 20_000, "fr", "hot", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = sharding.hilbert_shards(docs, shards=40, law=law).collect()
    check(found, rows, 40, law)
    again = sharding.hilbert_shards(docs.repartition(7), shards=40, law=law).collect()
    key = lambda r: (r["shard"], r["slot"], r["doc_id"] or -1, r["size"], r["text_crc32"])
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_empty_table_and_fewer_rows_than_shards(spark):
    assert sharding.hilbert_shards(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "a", None, None, None, None), (2, "b", "en", "s", None, None)]
    check(sharding.hilbert_shards(spark.createDataFrame(rows, DOCS), shards=5).collect(), rows, 5, "rows")


def test_files_keep_all_rows_and_can_be_skipped(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("Shard", F.lit("own"))
    sharding.write_shards(docs, str(tmp_path / "curve"), shards=16)
    back = spark.read.parquet(str(tmp_path / "curve"))
    assert sorted(map(tuple, back.select("doc_id", "text", "lang", "source", "n_chars").collect())) == sorted(
        map(tuple, docs.select("doc_id", "text", "lang", "source", "n_chars").collect())
    )
    files = sharding.manifest(spark, str(tmp_path / "curve")).collect()
    assert sum(f["rows"] for f in files) == docs.count()

    def opened(condition):
        return sum(condition(f) for f in files) / len(files)

    # each of three conditions on different columns rules most files out, in one layout
    assert opened(lambda f: f["min_lang"] <= "de" <= f["max_lang"]) < 0.5
    assert opened(lambda f: f["min_source"] <= "src7" <= f["max_source"]) < 0.5
    assert opened(lambda f: f["max_n_chars"] >= 10_000) < 0.5
