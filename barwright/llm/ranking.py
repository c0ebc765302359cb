"""Ranked lexical search over FP-trees of documents.

Reading: every text is cut into terms once, and what is staged of it is its length and its term vector restricted to
the terms of the queries. Counts of documents and terms come from the staged vectors.

Searching: a task takes the vectors some thousands at a time, most frequent term first, and sorts them, so that those
beginning with the same terms share a path of a trie (an FP-tree). A node stands for the documents below its path and holds the largest tf of
every term below it and their smallest m. A score grows with tf and falls with m, so the scores of these maxima bound
all documents below. The trie is walked depth first with the queries that may still find something: a query leaves the
walk at a node whose bound is below its worst kept score. Small nodes are scored as a whole, in doubles while
these hold all integers that may occur, else in integers. A task keeps ``k`` documents of a query from one trie to the
next and starts from the scores that a small share of the documents reach; what tasks found, at most ``k`` rows
of a query and task, is ranked at the end.

Queries go to the tasks in groups of about ``GROUP_TERMS`` (query, term) pairs, one pass over the texts for each
group (a query of more terms is in a group of its own). Terms are told apart by 64 bits of hash and their length.

Null texts have no terms, and texts without terms are in no ranking. Each row of the query table is ranked by itself,
repeated ids included; queries that are null or without terms give no rows. Rows of equal score and doc_id are
interchangeable; a null doc_id (as which -2^63 counts too) ranks first among equals. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright.llm import kernel
from barwright.llm.sharding import running_sums
from barwright.sources.staging import stage

#: (query, term) pairs of a group of queries, and the least that one query counts.
GROUP_TERMS, QUERY_TERMS = 1 << 20, 64
#: (query, term) pairs and queries whose weights a task holds as one matrix.
BLOCK_TERMS, BLOCK_QUERIES = 1 << 14, 1 << 8
#: Documents and vector entries of one trie.
TRIE_DOCS, TRIE_ENTRIES = 1 << 13, 1 << 20
#: A node with no more documents is scored as a whole.
LEAF_DOCS = 64
#: A bound is taken again when a node has lost this share of the documents.
SHRUNK = 0.75
#: About so many documents give the first thresholds.
SAMPLE_DOCS = 1 << 13
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NULL = -(1 << 63)


def factor(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a weight is multiplied by: grows with tf, falls with m, and is below 1,000,000."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass(frozen=True)
class Block:
    """Some queries and their terms: query pair_query[i] has the term terms[pair_term[i]]."""

    queries: np.ndarray  # rows of the query table
    terms: np.ndarray  # ascending places of the group's terms that they have
    weight: np.ndarray
    pair_query: np.ndarray
    pair_term: np.ndarray

    def matrix(self) -> np.ndarray:
        """terms x queries; doubles if they hold every score, else integers."""
        most = np.zeros(len(self.queries), np.int64)
        np.add.at(most, self.pair_query, self.weight[self.pair_term])
        kind = np.float64 if not len(most) or most.max() < (1 << 53) // 1_000_000 else np.int64
        out = np.zeros((len(self.weight), len(self.queries)), kind)
        out[self.pair_term, self.pair_query] = self.weight[self.pair_term]
        return out


@dataclass(frozen=True)
class Group:
    """A group of queries over numbered terms, and what is known of all documents."""

    blocks: list[Block]
    rank: np.ndarray  # place of each term by falling df
    docs: int
    words: int


class Best:
    """The best documents of the queries of a block so far, and the scores that others must reach."""

    def __init__(self, k: int, least: np.ndarray) -> None:
        none = np.empty(0, np.int64)
        self.k, self.least = k, np.maximum(least, 1)
        self.score, self.doc = [none] * len(least), [none] * len(least)

    def offer(self, q: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score[q], score]), np.concatenate([self.doc[q], doc])
        first = np.lexsort([doc, -score])[: self.k]
        self.score[q], self.doc[q] = score[first], doc[first]
        if len(first) == self.k:
            self.least[q] = max(self.least[q], self.score[q][-1])


@dataclass(frozen=True)
class Vectors:
    """Documents with their restricted vectors: entries first[i]:first[i + 1] of document i, ascending terms."""

    doc: np.ndarray
    m: np.ndarray
    first: np.ndarray
    term: np.ndarray
    tf: np.ndarray

    def take(self, docs: np.ndarray) -> Vectors:
        lengths = np.diff(self.first)[docs]
        first = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(first[-1]) + np.repeat(self.first[docs] - first[:-1], lengths)
        return Vectors(self.doc[docs], self.m[docs], first, self.term[at], self.tf[at])

    def among(self, terms: np.ndarray) -> Vectors:
        """The entries of some ascending terms, by their places among these."""
        term = np.minimum(np.searchsorted(terms, self.term), len(terms) - 1)
        kept = terms[term] == self.term
        first = np.concatenate([[0], np.cumsum(kept)])[self.first]
        return Vectors(self.doc, self.m, first, term[kept], self.tf[kept])


def plant(v: Vectors) -> tuple[Vectors, np.ndarray]:
    """The trie: documents in the order of their term paths, and the number of terms each shares with the one before."""
    names = v.term.astype(">u4").tobytes()
    order = np.array(sorted(range(len(v.doc)), key=lambda i: names[4 * v.first[i] : 4 * v.first[i + 1]]), np.int64)
    v = v.take(order)
    lengths = np.diff(v.first)
    shared = np.zeros(len(v.doc), np.int64)
    least = np.minimum(lengths[1:], lengths[:-1])
    if least.sum():
        begins = np.cumsum(least) - least
        pair = np.repeat(np.arange(1, len(v.doc)), least)
        within = np.arange(least.sum()) - np.repeat(begins, least)
        differs = v.term[v.first[pair] + within] != v.term[v.first[pair - 1] + within]
        some = np.flatnonzero(least)
        first_difference = np.minimum.reduceat(np.where(differs, within, 1 << 40), begins[some])
        shared[1:][some] = np.minimum(first_difference, least[some])
    return v, shared


def branches(shared: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """The subtrees of a node, as ranges of its documents low:high, where these first part. Neighbouring subtrees that
    are small together are one range; documents of one path, which part nowhere, come in such ranges too."""
    inner = shared[low + 1 : high]
    start = low
    end = low
    for cut in [*(low + 1 + np.flatnonzero(inner == inner.min())).tolist(), high]:
        if end > start and cut - start > LEAF_DOCS:
            yield start, end
            start = end
        end = cut
    yield start, end


def search(v: Vectors, shared: np.ndarray, block: Block, best: Best) -> None:
    """Offer the documents of a trie that may belong to the best of a query, depth first."""
    v = v.among(block.terms)
    weights = block.matrix()
    stack = [(0, len(v.doc), 2 * len(v.doc), np.arange(len(block.queries)))]
    while stack:
        low, high, checked, active = stack.pop()
        inside = slice(v.first[low], v.first[high])
        if inside.start == inside.stop:
            continue
        if high - low <= LEAF_DOCS:
            terms, at = np.unique(v.term[inside], return_inverse=True)
            table = np.zeros((high - low, len(terms)), weights.dtype)
            doc = np.repeat(np.arange(high - low), np.diff(v.first[low : high + 1]))
            table[doc, at] = factor(v.tf[inside], v.m[low + doc])
            scores = (table @ weights[np.ix_(terms, active)]).astype(np.int64)
            good = scores >= best.least[active]
            for j in np.flatnonzero(good.any(axis=0)):
                best.offer(int(active[j]), scores[good[:, j], j], v.doc[low:high][good[:, j]])
            continue
        if high - low <= SHRUNK * checked:
            checked = high - low
            most = np.zeros(len(weights), np.int64)
            np.maximum.at(most, v.term[inside], v.tf[inside])
            terms = np.flatnonzero(most)
            bound = factor(most[terms], v.m[low:high].min()).astype(weights.dtype) @ weights[np.ix_(terms, active)]
            active = active[bound >= best.least[active]]
            if not len(active):
                continue
        stack.extend((a, b, checked, active) for a, b in branches(shared, low, high))


def search_all(vectors: DataFrame, group: Group, least: dict[int, int], k: int) -> DataFrame:
    """query (row), doc_id, score: up to ``k`` documents of each query from every task, all that may be among its best."""
    sent = vectors.sparkSession.sparkContext.broadcast((group, least))  # some arrays of GROUP_TERMS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, least = sent.value
        found = [Best(k, np.array([least.get(int(q), 1) for q in b.queries], np.int64)) for b in group.blocks]
        for v in _tries(batches, group):
            v, shared = plant(v)
            for block, best in zip(group.blocks, found, strict=True):
                search(v, shared, block, best)
        for block, best in zip(group.blocks, found, strict=True):
            lengths = [len(s) for s in best.score]
            doc = np.concatenate(best.doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(block.queries, lengths)), pa.array(doc, mask=doc == _NULL), pa.array(np.concatenate(best.score))], ["query", "doc_id", "score"]
            )

    return vectors.mapInArrow(run, "query long, doc_id long, score long")


def _tries(batches: Iterator[pa.RecordBatch], group: Group) -> Iterator[Vectors]:
    """The rows of read_vectors, some thousands at a time, terms renumbered by falling df."""
    held: list[pa.RecordBatch] = []
    docs = entries = 0
    for batch in batches:
        for at in range(0, len(batch), TRIE_DOCS):
            part = batch.slice(at, TRIE_DOCS)
            size = pc.sum(pc.list_value_length(part.column("term"))).as_py() or 0
            if held and (docs + len(part) > TRIE_DOCS or entries + size > TRIE_ENTRIES):
                yield _numbered(held, group)
                held, docs, entries = [], 0, 0
            held.append(part)
            docs, entries = docs + len(part), entries + size
    if held:
        yield _numbered(held, group)


def _numbered(held: list[pa.RecordBatch], group: Group) -> Vectors:
    rows = pa.Table.from_batches(held).combine_chunks()
    doc = pc.fill_null(rows.column("doc_id"), _NULL).to_numpy()
    n = rows.column("n").to_numpy()
    m = np.array([50 + (50 * int(x) * group.docs) // group.words for x in n], np.int64)
    term = pc.list_flatten(rows.column("term")).to_numpy().astype(np.int64)
    tf = pc.list_flatten(rows.column("tf")).to_numpy().astype(np.int64)
    lengths = pc.list_value_length(rows.column("term")).to_numpy().astype(np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(len(doc)), lengths)
    rank = group.rank[term]
    order = np.argsort((owner << 32) | rank)
    return Vectors(doc, m, first, rank[order], tf[order])


def read_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (all terms of the text), term (places in ``terms``), tf of every row."""
    words = kernel.split(pa.array(terms, pa.string()), kernel.SYMBOL)
    order = np.argsort(words.hash)
    sent = docs.sparkSession.sparkContext.broadcast((words.hash[order], (words.ends - words.starts)[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sizes, numbers = sent.value
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                words = kernel.split(part.column("text"), kernel.SYMBOL, fold=True)
                at = np.minimum(np.searchsorted(hashes, words.hash), len(hashes) - 1)
                hit = np.flatnonzero((hashes[at] == words.hash) & (sizes[at] == words.ends - words.starts))
                doc = np.searchsorted(words.first, hit, "right") - 1
                key, tf = np.unique((doc << 32) | numbers[at[hit]], return_counts=True)
                first = np.searchsorted(key >> 32, np.arange(len(part) + 1)).astype(np.int32)
                rows = [
                    part.column("doc_id"), pa.array(np.diff(words.first), pa.int64()),
                    pa.ListArray.from_arrays(first, pa.array(key & 0xFFFFFFFF, pa.int32())), pa.ListArray.from_arrays(first, pa.array(tf, pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(rows, ["doc_id", "n", "term", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<long>")


def _group(queries: DataFrame) -> tuple[list[str], list[np.ndarray], np.ndarray]:
    """The distinct terms of a group of queries, those of each query (as places), and the rows of the queries."""
    rows = queries.orderBy("query").collect()  # a group's terms are bounded
    number: dict[str, int] = {}
    own = [np.array([number.setdefault(t, len(number)) for t in r["terms"]], np.int64) for r in rows]
    return list(number), own, np.array([r["query"] for r in rows], np.int64)


def _blocks(own: list[np.ndarray], rows: np.ndarray, weight: np.ndarray) -> list[Block]:
    found, at = [], 0
    while at < len(own):
        stop, pairs = at, 0
        while stop < len(own) and (stop == at or (pairs + len(own[stop]) <= BLOCK_TERMS and stop - at < BLOCK_QUERIES)):
            pairs += len(own[stop])
            stop += 1
        pair_term = np.concatenate(own[at:stop])
        terms, pair_term = np.unique(pair_term, return_inverse=True)
        pair_query = np.repeat(np.arange(stop - at), [len(x) for x in own[at:stop]])
        found.append(Block(rows[at:stop], terms, weight[terms], pair_query, pair_term))
        at = stop
    return found


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _rank_group(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame | None:
    terms, own, rows = _group(queries)
    vectors = stage(read_vectors(docs, terms), "ranking-vectors")
    total = vectors.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    if not total["docs"]:
        return None
    df = np.zeros(len(terms), np.int64)
    for r in vectors.select(F.explode("term").alias("term")).groupBy("term").count().collect():  # one row per term of the group
        df[r["term"]] = r["count"]
    rank = np.empty(len(terms), np.int64)
    order = np.argsort(-df, kind="stable")
    rank[order] = np.arange(len(terms))
    weight = np.array([floor(1000 * log((2 * total["docs"] + 2) / (2 * int(x) + 1))) for x in df[order]], np.int64)
    group = Group(_blocks([rank[x] for x in own], rows, weight), rank, total["docs"], total["words"])
    share = int((1 << 30) * min(1.0, SAMPLE_DOCS / total["docs"]))
    sample = vectors.filter(F.pmod(F.xxhash64("doc_id", "n", "term"), F.lit(1 << 30)) < share)
    reached = _ranked(search_all(sample, group, {}, k), k).filter(F.col("rank") == k).select("query", "score")
    least = {r["query"]: r["score"] for r in reached.collect()}  # one row per query of the group
    return stage(search_all(vectors, group, least, k), "ranking-found")


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest scores above 0 of each row of ``queries``
    (item_id, text)."""
    folded = F.translate(F.col("text").cast("string"), _CAPITALS, _CAPITALS.lower())
    asked = queries.select("item_id", F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("terms"))
    asked = stage(asked.filter(F.size("terms") > 0).withColumn("query", F.monotonically_increasing_id()), "ranking-asked")
    size = F.greatest(F.size("terms"), F.lit(QUERY_TERMS)).cast("long")
    placed = running_sums(asked.select("query", size.alias("_size")), [F.col("query")], {"_before": F.col("_size")}, "ranking-sizes")
    placed = stage(placed.select("query", F.call_function("div", F.col("_before"), F.lit(GROUP_TERMS)).alias("group")), "ranking-groups")
    groups = sorted(r["group"] for r in placed.select("group").distinct().collect())  # one for about GROUP_TERMS pairs
    found = [_rank_group(docs, asked.join(placed.filter(F.col("group") == g), "query"), k) for g in groups]
    found = [f for f in found if f is not None]
    if not found:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).filter("false")
    ranked = _ranked(reduce(DataFrame.unionByName, found), k)
    return ranked.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
