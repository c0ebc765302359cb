"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A fingerprint is the smallest hash among the
``window - GRAM + 1`` GRAM-word runs of a window, so any ``window`` words that a document shares with an
item give both the same fingerprint there: no shared span of that length is missed. Fingerprints of
documents (each once per document, about two in nine positions) are joined with those of the benchmark; in
documents with a common one, the positions it stands for are extended to whole windows, which must be equal word
for word to a window of an item. Items shorter than a window are one window of their own length; each length
that occurs (below ``window``, so at most a dozen) has fingerprints of its own, the hash of every run.

All of it is DataFrame code. The benchmark's side has no size hint: it is written first, so Spark knows
whether it is small enough to send or has to be shuffled.

Null and empty texts have no words and no hit. Items without id, text or words are left out; items with
one id are one item. Rows that repeat doc_id and text are judged alike. A null doc_id is a value like others. Empty
tables give no rows, or no hits. Columns beside doc_id, item_id and text are only carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.carry import packed, sent, unpacked
from barwright.sources.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
GRAM = 6


def words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(folded, SEPARATORS), "")


def _each(of: str, width: str, value: str) -> str:
    """An array of ``value`` at every i for which i .. i + width - 1 lies in the array ``of``."""
    return f"CASE WHEN size({of}) >= {width} THEN transform(sequence(1, size({of}) - {width} + 1), i -> {value}) ELSE array() END"


def _with_prints(rows: DataFrame, window: int, short: list[int]) -> DataFrame:
    """From ``words``: the column prints_<length>, the fingerprint of every window of that length."""
    gram = min(GRAM, window)
    grams = ", ".join(f"element_at(words, i + {j})" for j in range(gram))
    rows = rows.withColumn("grams", F.expr(_each("words", gram, f"xxhash64({grams})")))
    reach = window - gram + 1
    lowest = ", ".join(f"element_at(grams, i + {j})" for j in range(reach))
    lowest = f"least({lowest})" if reach > 1 else "element_at(grams, i)"
    rows = rows.withColumn(f"prints_{window}", F.expr(_each("grams", reach, lowest)))
    for length in short:
        rows = rows.withColumn(f"prints_{length}", F.expr(_each("words", length, f"xxhash64({length}, slice(words, i, {length}))")))
    return rows.drop("grams")


def _windows(rows: DataFrame, keep: list[str], lengths: list[int], wanted: str = "") -> DataFrame:
    """One row per window: ``keep``, at, length, print, gram (its words). ``wanted`` names a column with the prints to keep."""
    chosen = "x -> x.print IS NOT NULL" + (f" AND array_contains({wanted}, x.print)" if wanted else "")
    lists = [f"transform(prints_{n}, (p, i) -> named_struct('at', i, 'length', {n}, 'print', p))" for n in lengths]
    spread = rows.withColumn("found", F.explode(F.expr(f"filter(concat({', '.join(lists)}), {chosen})")))
    gram = F.expr("array_join(slice(words, found.at + 1, found.length), ' ')")
    return spread.select(*keep, "found.at", "found.length", "found.print", gram.alias("gram"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, windows, items): doc_id, tag, n_words of every row; the windows that benchmark items
    have (doc_id, tag, at, length, gram); item_id of each gram. ``tag`` tells apart texts of one doc_id."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    items = items.filter("item_id IS NOT NULL AND size(words) > 0")
    items = stage(items.withColumn("n", F.size("words")), "items")
    short = sorted(r[0] for r in items.filter(F.col("n") < window).select("n").distinct().collect())  # below window values
    lengths = [window, *short]
    # an item gives windows of its own length only: shorter ones are items themselves
    own = _windows(_with_prints(items, window, short), ["item_id", "n"], lengths).filter(f"length = least(n, {window})")
    own = stage(own.select("item_id", "length", "print", "gram").distinct(), "item-windows")

    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    named = docs.select("doc_id", tag.alias("tag"), "text")
    texts = named.withColumn("words", words(F.col("text")))
    printed = _with_prints(texts, window, short)
    prints = F.array_distinct(F.concat(*[F.col(f"prints_{n}") for n in lengths]))
    printed = stage(printed.select("doc_id", "tag", F.size("words").cast("long").alias("n_words"), prints.alias("prints")), "prints")
    common = printed.select("doc_id", "tag", F.explode("prints").alias("print")).join(own.select("print").distinct(), "print")
    common = stage(common.groupBy("doc_id", "tag").agg(F.collect_set("print").alias("wanted")), "common")
    common = sent(common, "wanted")
    same = [F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), F.col("d.tag") == F.col("c.tag")]
    near = named.alias("d").join(common.alias("c"), same[0] & same[1]).select("d.doc_id", "d.tag", "d.text", "c.wanted")
    near = near.withColumn("words", words(F.col("text"))).drop("text")
    extended = _windows(_with_prints(near, window, short), ["doc_id", "tag"], lengths, "wanted")
    grams = own.select("length", "gram").distinct()
    hits = stage(extended.select("doc_id", "tag", "at", "length", "gram").join(grams, ["length", "gram"]).distinct(), "hits")
    return printed.select("doc_id", "tag", "n_words"), hits, own.select("length", "gram", "item_id").distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    judged = contamination(docs, benchmark, window, share).filter("contaminated")
    gone = stage(judged.select(F.col("doc_id").alias("id"), "tag").distinct(), "contaminated")
    gone = sent(gone)
    rows = packed(docs).withColumn("own", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return unpacked(rows.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("tag")), "left_anti"), docs)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """doc_id, tag, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    Contaminated: some word is hit, and ``share`` times the hit words are no fewer than the words.
    """
    counted, hits, items = find_hits(docs, benchmark, window)
    # the union of a document's windows, in order: each adds what lies behind the end so far
    union = (
        "aggregate(sort_array(spans), named_struct('stop', 0, 'n', 0), (s, x) -> named_struct("
        "'stop', greatest(s.stop, x.at + x.length), 'n', s.n + greatest(0, x.at + x.length - greatest(s.stop, x.at))), s -> s.n)"
    )
    covered = hits.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("at", "length")).alias("spans"))
    covered = covered.select("doc_id", "tag", F.expr(union).cast("long").alias("n_hit"))
    named = hits.select("doc_id", "tag", "length", "gram").distinct().join(items, ["length", "gram"])
    named = named.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    found = covered.alias("a").join(named.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.tag") == F.col("b.tag")))
    found = found.select("a.doc_id", "a.tag", "a.n_hit", "b.ids").alias("f")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.tag") == F.col("f.tag"))
    rows = counted.alias("d").join(found, same, "left").select("d.*", F.coalesce("f.n_hit", F.lit(0)).cast("long").alias("n_hit"), "f.ids")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "tag", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
