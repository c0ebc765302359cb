"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors become integers (each component x is floor(scale * x)). The queries go to the tasks in blocks of bounded
size; a task cuts its part of the candidates into pieces, builds a cover tree of each and walks it together
with the cover tree of the query block. A pair of nodes (query group, candidate group) is dropped if the largest
inner product that their centres and covering radii allow is below the worst k-th score of the query group
so far. What is left at the leaves is multiplied out. A task returns its k best per query, so what is
shuffled for the final choice is k rows per query and task, whatever the candidates.

Vectors that are null or hold a null or a non-finite component take no part, and neither do rows without
id. Only vectors of one length are compared; a vector of length 0 has product 0 with others of length
0. Rows that share the query's id are the query itself; repeated query rows count once per different vector, and repeated
candidates are candidates each. Ties go to the smaller id. Scores beyond a long are cut off at its ends; a scaled
component beyond the largest double counts as that. Vectors with components beyond ``TREE_LARGEST``, whose distances
would leave the doubles, are multiplied out without a tree. Empty
tables and queries without candidates give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright.sources.staging import stage

#: Queries sent to the tasks at once, about.
QUERY_BLOCK = 4096
#: Candidates under one cover tree.
PIECE = 2048
#: Node radii shrink by this factor per level, and nodes of so few points are not divided.
SHRINK, LEAF = 1.3, 16
#: Centres that give a first bound.
SEEDS = 128
LARGEST = (1 << 63) - 1
TREE_LARGEST = 1e140


@dataclass
class CoverTree:
    """Nodes in arrays; children of a node are adjacent, its points are order[start:stop]."""

    points: np.ndarray
    order: np.ndarray
    center: list[int] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    stop: list[int] = field(default_factory=list)
    child: list[tuple[int, int]] = field(default_factory=list)


def cover_tree(points: np.ndarray) -> CoverTree:
    """Each node's points lie within its radius of its centre; the children of a node have centres farther apart
    than their common covering radius, and one of them keeps the node's centre."""
    tree = CoverTree(points, np.arange(len(points)))

    def add(start: int, stop: int, distances: np.ndarray) -> None:
        tree.center.append(int(tree.order[start]))
        tree.radius.append(float(distances.max()))
        tree.start.append(start)
        tree.stop.append(stop)
        tree.child.append((0, 0))

    def apart(center: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(np.square(points[members] - points[center]).sum(axis=1))

    if not len(points):
        return tree
    add(0, len(points), apart(0, tree.order))
    node = 0
    while node < len(tree.center):
        start, stop, radius = tree.start[node], tree.stop[node], tree.radius[node]
        if stop - start > LEAF and radius > 0:
            left, first, at = tree.order[start:stop].copy(), len(tree.center), start
            while len(left):
                distances = apart(left[0], left)
                near = distances <= radius / SHRINK
                n = int(near.sum())
                tree.order[at : at + n] = left[near]
                add(at, at + n, distances[near])
                left, at = left[~near], at + n
            tree.child[node] = (first, len(tree.center))
        node += 1
    return tree


@dataclass
class Best:
    """The k best of each query so far: score descending, id ascending; the first ``filled`` places count."""

    k: int
    scores: np.ndarray
    ids: np.ndarray
    filled: np.ndarray
    least: np.ndarray  # what the k-th score is known to reach, whether or not its candidates have been offered

    @classmethod
    def empty(cls, queries: int, k: int) -> Best:
        return cls(k, np.zeros((queries, k), np.int64), np.zeros((queries, k), np.int64), np.zeros(queries, np.int64), np.full(queries, -np.inf))

    def worst(self, queries: np.ndarray) -> float:
        return float(self.least[queries].min())

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        n = self.filled[query]
        if n == self.k:
            fits = scores >= self.scores[query, -1]
            scores, ids = scores[fits], ids[fits]
        scores, ids = np.append(self.scores[query, :n], scores), np.append(self.ids[query, :n], ids)
        top = np.lexsort((ids, ~scores))[: self.k]  # ~ turns the order round and has no overflow
        self.filled[query] = n = len(top)
        self.scores[query, :n], self.ids[query, :n] = scores[top], ids[top]
        if n == self.k:
            self.least[query] = max(self.least[query], self.scores[query, -1])


def search(queries: CoverTree, query_ids: np.ndarray, candidates: CoverTree, ids: np.ndarray, best: Best) -> None:
    """Improve ``best`` by all candidates that could be among the k best of a query."""
    if not len(queries.points) or not len(candidates.points):
        return
    radius = np.array(candidates.radius)
    centers = candidates.points[candidates.center]
    norms = np.sqrt(np.square(centers).sum(axis=1))
    starts, stops = np.array(candidates.start), np.array(candidates.stop)
    children = np.array(candidates.child)

    def kept(q: int, nodes: np.ndarray) -> np.ndarray:
        """The nodes that may hold one of the k best of a query under q, the most promising first."""
        center, reach = queries.points[queries.center[q]], queries.radius[q]
        members = queries.order[queries.start[q] : queries.stop[q]]
        most = centers[nodes] @ center + np.sqrt(center @ center) * radius[nodes] + reach * (norms[nodes] + radius[nodes])
        order = np.argsort(-most)
        most = most[order]
        return nodes[order][most + 1e-3 + 1e-9 * np.abs(most) >= best.worst(members)]

    def opened(nodes: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(a, b) for a, b in children[nodes]]) if len(nodes) else nodes

    # the k-th best among some centres is a first bound
    some = np.unique(candidates.center[:SEEDS])
    if len(some) > best.k:
        products = multiply(queries.points, candidates.points[some]).astype(np.float64)
        products[ids[some][None, :] == query_ids[:, None]] = -np.inf
        np.maximum(best.least, np.sort(products, axis=1)[:, -best.k], out=best.least)

    todo: list[tuple[int, np.ndarray]] = [(0, np.zeros(1, np.int64))]
    while todo:
        q, nodes = todo.pop()
        nodes = kept(q, nodes)
        if queries.child[q][1]:
            wide = (children[nodes, 1] > 0) & (radius[nodes] >= queries.radius[q])  # the wider side is opened first
            while wide.any():
                nodes = kept(q, np.concatenate([nodes[~wide], opened(nodes[wide])]))
                wide = (children[nodes, 1] > 0) & (radius[nodes] >= queries.radius[q])
            todo += [(c, nodes) for c in range(*queries.child[q])] if len(nodes) else []
            continue
        members = queries.order[queries.start[q] : queries.stop[q]]
        while len(nodes):
            head, nodes = np.split(nodes, [max(8, len(nodes) // 4)])
            inner = children[head, 1] > 0
            if not inner.all():
                at = np.concatenate([candidates.order[a:b] for a, b in zip(starts[head[~inner]], stops[head[~inner]], strict=True)])
                scores = multiply(queries.points[members], candidates.points[at])
                for row, member in enumerate(members):
                    other = ids[at] != query_ids[member]
                    best.offer(member, scores[row][other], ids[at][other])
            nodes = kept(q, np.concatenate([nodes, opened(head[inner])]))


def _in_reach(points: np.ndarray) -> bool:
    """Squares and products of the components can be summed in doubles."""
    return bool(np.abs(points).max(initial=0) < TREE_LARGEST)


def search_all(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """As ``search``, by all products."""
    for row, scores in enumerate(multiply(queries, candidates)):
        other = ids != query_ids[row]
        best.offer(row, scores[other], ids[other])


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of integer vectors: in doubles while those are exact, else in whole numbers cut off to longs."""
    with np.errstate(over="ignore"):
        most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    return np.vectorize(lambda x: min(max(x, -LARGEST - 1), LARGEST), otypes=[np.int64])(whole[0] @ whole[1].T)


def _matrix(batch: pa.RecordBatch, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (ids, integer vectors as doubles)."""
    ids, vectors = batch.column(0).to_numpy(), batch.column(1)
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    out = {}
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        at = (ends[rows] - n)[:, None] + np.arange(n)
        out[int(n)] = ids[rows], _whole(values[at], scale).reshape(len(rows), int(n))
    return out


def _whole(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(scale * values))


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def _candidates_of(sent, scale: float, k: int):
    """The search of one block of queries (a broadcast list), for mapInArrow over candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = {}
        for n in {len(v) for _, v in sent.value}:
            own = [(i, v) for i, v in sent.value if len(v) == n]
            vectors = _whole(np.array([v for _, v in own], np.float64), scale).reshape(len(own), n)
            queries[n] = np.array([i for i, _ in own]), cover_tree(vectors) if _in_reach(vectors) else CoverTree(vectors, np.arange(len(own))), Best.empty(len(own), k)
        for batch in batches:
            for n, (ids, vectors) in _matrix(batch, scale).items():
                if n in queries:
                    query_ids, tree, best = queries[n]
                    for at in range(0, len(ids), PIECE):
                        piece = vectors[at : at + PIECE]
                        if _in_reach(piece) and len(tree.center):
                            search(tree, query_ids, cover_tree(piece), ids[at : at + PIECE], best)
                        else:
                            search_all(tree.points, query_ids, piece, ids[at : at + PIECE], best)
        for n, (query_ids, tree, best) in queries.items():
            row, place = np.nonzero(np.arange(k) < best.filled[:, None])
            number = pa.array([f"{n}:{r}" for r in row], pa.string())
            yield pa.RecordBatch.from_pydict({"query": number, "query_id": query_ids[row], "vec_id": best.ids[row, place], "score": best.scores[row, place]})

    return run


def top_products(embeddings: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest products of every query with the other rows."""
    rows = usable(embeddings)
    queries = stage(rows.filter(is_query).distinct(), "queries")
    blocks = max(1, -(-queries.count() // query_block))
    # with the vector, as one id may have many of them
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    parts = []
    for number in range(blocks):  # one pass over the candidates per block, each of bounded size and let go before the next
        block = [(r["vec_id"], list(r["embedding"])) for r in dealt.filter(F.col("block") == number).orderBy("vec_id", "embedding").collect()]
        sent = rows.sparkSession.sparkContext.broadcast(block)
        found = rows.mapInArrow(_candidates_of(sent, scale, k), "query string, query_id long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        parts.append(stage(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "products"))
        sent.destroy()
    return reduce(DataFrame.unionByName, parts)
