"""Near-duplicates by MinHash and an LSH forest.

A document is the set of its distinct ``SHINGLE``-word shingles, words being ASCII-lower-cased. Documents
with equal sets are one node (128 bits of digest). Each node has a signature of TREES x DEPTH MinHash
values; tree t orders all nodes by its own DEPTH values.

1. Regions: nodes that share the first two values of a tree's order. A region larger than ``REGION`` is
   cut at the next value, and so on, so that depth follows density (found from the distinct labels and their counts);
   what is still too large at full depth is dealt out with one member added to every part.
2. A region is read in its tree's order. Candidates of a member are the neighbours with which it shares the longest
   prefix, then, level by level, those with which it shares less, down to the region's own depth; members already
   linked with each other are not compared. Signatures that agree in ``LEAST_EQUAL`` places or more are linked: a
   spanning forest, never all pairs. The components of the links over all trees are clusters.
   A cut parts members that are linked. The members of a cut region that are not in its largest component so far
   are compared with the whole region in pairs of blocks, if those are few. A region with more than
   ``MOST_BLOCK_PAIRS`` (many texts with a part in common that are no near-duplicates) gets further, deeper orders for its
   members instead, as many as keep the odds: ``DEEPER`` values each, and the same again inside their regions. A true
   link stays inside a cluster unless its ends share the first values of no tree or its signatures agree too
   rarely; either has odds of about one in a million at the threshold, whatever the density.
3. Links are confirmed on the full sets: every cluster gets the texts of its nodes once and finds the
   components of the exact graph (by intersections over an inverted index of shared shingles, each member
   against those not yet reached). A cluster beyond ``BLOCK`` nodes or ``BLOCK_SHINGLES`` is cut into blocks
   and every pair of blocks is a task of its own, so no task holds more, and no link is lost.
4. Components of the confirmed links.

Nothing is capped: regions and clusters beyond a bound are split. Null and empty texts, and texts without a word,
have an empty set and are linked with nothing; a text of fewer words than a shingle is one shingle. A null
doc_id counts as larger than others and repeated rows fall into one component. An empty table gives
no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm import kernel
from barwright.llm.carry import packed, sent, unpacked
from barwright.llm.components import components
from barwright.sources.staging import stage

SHINGLE = 5
TREES, DEPTH = 16, 8
FIRST_DEPTH = 2
REGION = 1024
#: Values of the orders that members of dense regions get besides, and the pairs of blocks from which a region is dense.
DEEPER = (4, 8)
MOST_BLOCK_PAIRS = 64
ODDS = 1e-6
#: 73 of 128 equal values: 4.7 standard deviations below a similarity of 0.75.
LEAST_EQUAL = 73
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000
LAST = (1 << 63) - 1

_PLACED = ("tree", "prefix", "label", "node")

_FACTORS = kernel.mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64), 5) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, first): document i has the distinct hashes [first[i]:first[i + 1]], ascending."""
    words = kernel.split(texts, fold=True)
    hashes, at = words.grams(SHINGLE)
    doc = np.searchsorted(words.first, at, "right") - 1
    counts = np.diff(words.first)
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(few):
        short = kernel.mix(kernel.range_hash(words.hash, words.first[few], words.first[few + 1], 0xE7037ED1A0B428DB), 7)
        hashes, doc = np.concatenate([hashes, kernel.mix(short + counts[few].astype(np.uint64), 8)]), np.concatenate([doc, few])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[fresh], doc[fresh]
    return hashes, np.searchsorted(doc, np.arange(len(texts) + 1))


def set_digests(hashes: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128 bits that depend on the set alone; None for an empty set."""
    some = np.flatnonzero(np.diff(first))
    out: list[bytes | None] = [None] * (len(first) - 1)
    if len(some):
        with np.errstate(over="ignore"):
            sums = [kernel.mix(np.add.reduceat(kernel.mix(hashes, salt), first[some]) + np.diff(first)[some].astype(np.uint64), salt) for salt in (21, 22)]
        for i, raw in zip(some, np.stack(sums, axis=1).astype(">u8"), strict=True):
            out[i] = raw.tobytes()
    return out


def signatures(hashes: np.ndarray, first: np.ndarray, factors: np.ndarray = _FACTORS) -> np.ndarray:
    """MinHash values (documents x factors) as big-endian 32-bit integers; rows of empty sets are 0."""
    some = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, len(factors)), ">u4")
    if len(some):
        heads = first[some]
        with np.errstate(over="ignore"):
            for k, factor in enumerate(factors):
                out[some, k] = np.minimum.reduceat(((hashes ^ (factor >> np.uint64(7))) * factor) >> np.uint64(32), heads)
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in kernel.slices(batch, "text"):
            hashes, first = shingle_sets(part.column("text"))
            nodes, signs = set_digests(hashes, first), signatures(hashes, first)
            sign = [s.tobytes() if node else None for s, node in zip(signs, nodes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("ord"), part.column("tag"), pa.array(np.diff(first), pa.int64()), pa.array(nodes, pa.binary()), pa.array(sign, pa.binary())],
                ["ord", "tag", "n_shingles", "node", "sign"],
            )


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        names = list(zip(*columns, strict=True))
        cuts = [0] + [i for i in range(1, len(names)) if names[i] != names[i - 1]] + [len(names)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            if held and names[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = names[start]
    if held:
        yield pa.Table.from_batches(held)


def neighbour_links(labels: np.ndarray, signs: np.ndarray, least_equal: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph in which rows agree in ``least_equal`` places or more. ``labels`` (rows x
    values) are in ascending order."""
    n = len(signs)
    if n == 2:
        return [(0, 1)] if np.count_nonzero(signs[0] == signs[1]) >= least_equal else []
    common = np.logical_and.accumulate(labels[1:] == labels[:-1], axis=1).sum(axis=1)  # values shared with the next row
    root = np.arange(n)
    links: list[tuple[int, int]] = []
    for depth in np.unique(common)[::-1]:
        stops = np.append(np.flatnonzero(common < depth) + 1, n)
        starts = np.append(0, stops[:-1])
        joins = np.add.reduceat(np.append(common == depth, False), starts) > 0  # runs made of several deeper ones
        for start, stop in zip(starts[joins], stops[joins], strict=True):
            own = root[start:stop]
            if (own == own[0]).all():
                continue
            child = np.append(0, np.cumsum(common[start : stop - 1] == depth))
            for i, j in _across(signs[start:stop], own, child, least_equal):
                links.append((int(start) + i, int(start) + j))
    return links


def _across(signs: np.ndarray, root: np.ndarray, child: np.ndarray, least_equal: int) -> list[tuple[int, int]]:
    """Links between rows of different ``child`` and ``root``; roots that are linked become one, in place."""
    consensus = np.sort(signs, axis=0)[len(signs) // 2]
    near = np.argsort(-np.count_nonzero(signs == consensus, axis=1), kind="stable")
    centre, links = near[0], []
    for member in near:
        if member != centre and root[member] == root[centre]:
            continue  # a row outside the centre's component is compared with this one in its own turn
        others = np.flatnonzero((root != root[member]) & (child != child[member]))
        hit = others[np.count_nonzero(signs[others] == signs[member], axis=1) >= least_equal]
        if len(hit):
            found, at = np.unique(root[hit], return_index=True)
            links += [(int(member), int(x)) for x in hit[at]]
            root[np.isin(root, found)] = root[member]
    return links


def _region_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a: list[bytes] = []
    b: list[bytes] = []
    for group in _groups(batches, 2):
        nodes = group.column("node").to_pylist()
        labels, signs = (np.frombuffer(b"".join(group.column(c).to_pylist()), ">u4").reshape(len(nodes), -1) for c in ("label", "sign"))
        for i, j in neighbour_links(labels, signs, LEAST_EQUAL):
            a.append(nodes[i])
            b.append(nodes[j])
        if len(a) >= 50_000:
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def regions(nodes: DataFrame, region: int = REGION) -> DataFrame:
    """(tree, prefix, label, node) of all regions with two members or more, none much larger than ``region``."""
    return _cut(nodes, region)[0]


def _cut(nodes: DataFrame, region: int) -> tuple[DataFrame, DataFrame]:
    """``regions``, and (tree, prefix, label, node) of the regions of FIRST_DEPTH that were cut to get them."""
    trees = nodes.select("node", "sign", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = trees.select("node", "tree", F.expr(f"substring(sign, tree * {DEPTH * 4} + 1, {DEPTH * 4})").alias("label"))
    rows = rows.withColumn("prefix", F.substring("label", 1, 4 * FIRST_DEPTH))
    counts = rows.groupBy("tree", "prefix").agg(F.count("*").alias("n")).filter("n > 1")
    counts = stage(counts, "region-sizes")  # written, so that a hot region is split by the join
    members = stage(rows.join(counts, ["tree", "prefix"]), "regions")
    settled, whole = members.filter(F.col("n") <= region).select(*_PLACED), members.filter(F.col("n") > region).select(*_PLACED)
    if whole.isEmpty():
        return settled, whole
    members = stage(whole.drop("prefix").join(_own_regions(whole, region), ["tree", "label"]), "regions")
    settled = settled.unionByName(members.filter(F.col("n") <= region).select(*_PLACED))
    dense = members.filter(F.col("n") > region)
    if dense.isEmpty():
        return settled, whole
    # equal in every value of the tree: dealt out, the hub being in every part
    parts = F.ceil(F.col("n") / region).cast("long")
    dealt = dense.withColumn("part", F.pmod(F.xxhash64("node"), parts)).filter("node <> hub").select("tree", "prefix", "part", "label", "node")
    hubs = dense.select("tree", "prefix", "label", "hub", parts.alias("parts")).distinct()
    hubs = hubs.select("tree", "prefix", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "label", F.col("hub").alias("node"))
    named = F.concat(F.col("prefix"), F.col("part").cast("string").cast("binary"))
    return settled.unionByName(dealt.unionByName(hubs).select("tree", named.alias("prefix"), "label", "node")), whole


def _own_regions(whole: DataFrame, region: int) -> DataFrame:
    """(tree, label, prefix, n, hub) for every label in ``whole``: its first prefix beyond FIRST_DEPTH with ``region`` members
    at most, or all of it; their number, if two or more, and the smallest of them.

    Labels are followed, not members, and only as deep as they are dense: members that stay together for many values have
    few labels, and those that differ part early.
    """
    labels = stage(whole.groupBy("tree", "label").agg(F.count("*").alias("n"), F.min("node").alias("hub")), "labels")
    going, placed = labels, []
    for depth in range(FIRST_DEPTH + 1, DEPTH + 1):
        prefix = F.substring("label", 1, 4 * depth)
        rows = going.withColumn("prefix", prefix)
        if depth == DEPTH:
            placed.append(rows)
            break
        sizes = rows.groupBy("tree", "prefix").agg(F.sum("n").alias("n"))
        large = stage(sizes.filter(F.col("n") > region).select("tree", "prefix"), "large-regions")
        if large.isEmpty():
            placed.append(rows)
            break
        placed.append(rows.join(large, ["tree", "prefix"], "left_anti").select(rows.columns))
        # a region that is large at this depth was so at those before
        going = labels.withColumn("prefix", prefix).join(large, ["tree", "prefix"], "left_semi").select(labels.columns)
    own = stage(functools.reduce(DataFrame.unionByName, placed), "own-regions")
    sizes = own.groupBy("tree", "prefix").agg(F.sum("n").alias("n"), F.min("hub").alias("hub")).filter("n > 1")
    return stage(own.select("tree", "label", "prefix").join(sizes, ["tree", "prefix"]), "own-regions")


def _block_counts(whole: DataFrame, clusters: DataFrame, region: int) -> DataFrame:
    """tree, prefix, main (the region's largest cluster), main_blocks, rest_blocks (of its other members, if any)."""
    rows = whole.join(clusters, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rows.groupBy("tree", "prefix", "root").count().groupBy("tree", "prefix")
    sizes = sizes.agg(F.max(F.struct("count", "root")).alias("most"), F.sum("count").alias("n"))
    half = max(1, region // 2)
    return sizes.select(
        "tree", "prefix", F.col("most.root").alias("main"),
        F.ceil((F.col("n") - F.col("most.count")) / half).cast("long").alias("rest_blocks"),
        F.ceil(F.col("most.count") / half).cast("long").alias("main_blocks"),
    ).filter("rest_blocks > 0")


def pairs_of_blocks(whole: DataFrame, clusters: DataFrame, sizes: DataFrame) -> DataFrame:
    """(tree, prefix, label, node): parts of the regions ``whole`` in which every two members meet that are not both of
    the region's largest cluster. ``sizes`` are their ``_block_counts``."""
    rows = whole.join(clusters, "node", "left").withColumn("root", F.coalesce("root", "node")).join(sizes, ["tree", "prefix"])
    rest = "pmod(xxhash64(node), rest_blocks)"
    rows = rows.withColumn("block", F.expr(f"CASE WHEN root = main THEN rest_blocks + pmod(xxhash64(node), main_blocks) ELSE {rest} END"))
    others = "CASE WHEN root = main THEN sequence(0L, rest_blocks - 1) ELSE array_except(sequence(0L, rest_blocks + main_blocks - 1), array(block)) END"
    rows = rows.withColumn("other", F.explode(F.expr(others)))
    named = F.concat_ws("-", F.least("block", "other"), F.greatest("block", "other")).cast("binary")
    return rows.select("tree", F.concat("prefix", named).alias("prefix"), "label", "node")


def trees_of(depth: int) -> int:
    """Orders in one of which a pair at 0.75 shares its first ``depth`` values but for odds of ODDS."""
    return math.ceil(math.log(ODDS) / math.log1p(-(0.75**depth)))


def _orders(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    n = trees_of(depth) * depth
    factors = kernel.mix(np.arange(1, n + 1, dtype=np.uint64), 100 + depth) | np.uint64(1)
    for batch in batches:
        for part in kernel.slices(batch, "text"):
            for at in range(0, len(part), 2048):
                few = part.slice(at, 2048)
                orders = [x.tobytes() for x in signatures(*shingle_sets(few.column("text")), factors)]
                yield pa.RecordBatch.from_arrays([few.column("node"), pa.array(orders, pa.binary())], ["node", "orders"])


def _deeper(texts: DataFrame, nodes: DataFrame, depth: int, region: int) -> tuple[DataFrame, DataFrame]:
    """(tree, prefix, label, node) of the regions of ``nodes`` (node, head) in further orders of ``depth`` values: those up
    to ``region``, and the larger ones. ``texts`` has one row per ord and tag."""
    wanted = stage(nodes.select("head.ord", "head.tag", "node"), "dense-nodes")
    found = texts.join(sent(wanted), ["ord", "tag"]).select("node", "text")
    orders = stage(found.mapInArrow(lambda it: _orders(it, depth), "node binary, orders binary"), "orders")
    rows = orders.select("node", "orders", F.explode(F.sequence(F.lit(0), F.lit(trees_of(depth) - 1))).alias("tree"))
    rows = rows.select("node", "tree", F.expr(f"substring(orders, tree * {depth * 4} + 1, {depth * 4})").alias("label"))
    rows = rows.withColumn("prefix", F.col("label"))
    counts = stage(rows.groupBy("tree", "prefix").agg(F.count("*").alias("n")).filter("n > 1"), "region-sizes")
    members = stage(rows.join(counts, ["tree", "prefix"]), "regions")
    return members.filter(F.col("n") <= region).select(*_PLACED), members.filter(F.col("n") > region).select(*_PLACED)


def _clusters(texts: DataFrame, nodes: DataFrame, region: int) -> DataFrame:
    """(node, root): the components of all links between signatures."""
    parts, whole = _cut(nodes, region)
    clusters = components(_links(parts, nodes))
    few: DataFrame | None = None  # regions left to pairs of blocks
    sizes: DataFrame | None = None
    for depth in DEEPER:
        if whole.isEmpty():
            break
        sizes = stage(_block_counts(whole, clusters, region), "cut-regions")
        dense = sizes.filter(F.expr("rest_blocks * (rest_blocks + main_blocks)") > MOST_BLOCK_PAIRS).select("tree", "prefix")
        if dense.isEmpty():
            break
        left = whole.join(sent(dense), ["tree", "prefix"], "left_anti")
        few = left if few is None else few.unionByName(left)
        members = whole.join(sent(dense), ["tree", "prefix"], "left_semi").select("node").distinct()
        parts, whole = _deeper(texts, nodes.join(members, "node", "left_semi"), depth, region)
        clusters = _merged(clusters, _links(parts, nodes))
        sizes = None
    whole = whole if few is None else few.unionByName(whole)
    if whole.isEmpty():
        return clusters
    if sizes is None or few is not None:
        sizes = stage(_block_counts(whole, clusters, region), "cut-regions")
    return _merged(clusters, _links(pairs_of_blocks(whole, clusters, sizes), nodes))


def _merged(clusters: DataFrame, links: DataFrame) -> DataFrame:
    return components(clusters.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))


def exact_components(hashes: np.ndarray, first: np.ndarray, percent: int) -> np.ndarray:
    """For each set its component, named by a member: sets are linked if 100 * intersection >= percent * union."""
    n, sizes = len(first) - 1, np.diff(first)
    owner = np.repeat(np.arange(n), sizes)
    _, ids, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    weight = np.add.reduceat(counts[ids], first[:-1]) / np.maximum(sizes, 1)  # the consensus has the most common shingles
    shared = counts[ids] > 1
    owner, ids = owner[shared], ids[shared]
    starts = np.searchsorted(owner, np.arange(n + 1))
    by_id = np.argsort(ids, kind="stable")
    label, left, alive = np.full(n, -1), np.argsort(-weight, kind="stable"), np.ones(n, bool)

    def postings(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return owner[order], np.searchsorted(ids[order], np.arange(len(counts) + 1))

    held, bounds = postings(by_id)
    indexed = n
    for seed in left:
        if label[seed] >= 0:
            continue
        label[seed], alive[seed] = seed, False
        edge = [seed]
        while edge:
            member = edge.pop()
            own = ids[starts[member] : starts[member + 1]]
            low, high = bounds[own], bounds[own + 1]
            width = high - low
            if not width.sum():
                continue
            at = np.repeat(low - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
            common = np.bincount(held[at], minlength=n)
            hit = np.flatnonzero(alive & (100 * common >= percent * (sizes[member] + sizes - common)))
            label[hit], alive[hit] = seed, False
            edge += hit.tolist()
            if len(hit) and alive.sum() * 2 < indexed:  # the index keeps only those not yet reached
                by_id = by_id[alive[owner[by_id]]]
                held, bounds = postings(by_id)
                indexed = max(1, int(alive.sum()))
    return label


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches, 3):
        wanted = group.column("node").to_pylist()
        hashes, first = shingle_sets(group.column("text"))
        found = set_digests(hashes, first)
        keep = list({node: i for i, node in enumerate(wanted) if found[i] == node}.values())  # a doc_id may have other texts
        parts = [hashes[first[i] : first[i + 1]] for i in keep]
        label = exact_components(np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts]), percent) if parts else []
        links = [(wanted[keep[i]], wanted[keep[j]]) for i, j in enumerate(label) if i != j]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()), pa.array([x[1] for x in links], pa.binary())], ["a", "b"])


def confirmed_links(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes, confirmed on full sets, that span every component of the exact graph. ``docs`` has one
    row per ord and tag."""
    sized = stage(clusters.join(nodes.select("node", "head", "n_shingles"), "node"), "sized")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("long")
    wanted = sized.join(stage(sized.groupBy("root").agg(blocks.alias("blocks")), "cluster-blocks"), "root")
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    others = F.expr("CASE WHEN blocks = 1 THEN array(0L) ELSE array_except(sequence(0L, blocks - 1), array(block)) END")
    wanted = wanted.withColumn("other", F.explode(others))
    wanted = wanted.select(
        "root", "node", F.col("head.ord").alias("ord"), F.col("head.tag").alias("tag"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    texts = docs.join(sent(stage(wanted, "wanted")), ["ord", "tag"]).select("root", "low", "high", "node", "text")
    dealt = texts.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    return dealt.mapInArrow(lambda it: _confirm(it, percent), "a binary, b binary")


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ord (doc_id, the largest number for null) and tag (which text, if an id has several)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"ord": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "tag": F.xxhash64(text)})


def _links(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) inside parts (tree, prefix, label, node) of the nodes."""
    placed = parts.join(nodes.select("node", "sign"), "node").select(*_PLACED, "sign")
    dealt = placed.repartition("tree", "prefix").sortWithinPartitions(*_PLACED)
    return stage(dealt.mapInArrow(_region_links, "a binary, b binary"), "forest")


def _judged(docs: DataFrame, percent: int, region: int) -> DataFrame:
    """ord, tag, n_shingles, lowest (ord of the first document of the component) for every row."""
    named = _named(docs.select("doc_id", "text")).select("ord", "tag", F.col("text").cast("string").alias("text"))
    described = stage(named.mapInArrow(_describe, "ord long, tag long, n_shingles long, node binary, sign binary"), "described")
    nodes = described.filter("node is not null").groupBy("node")
    nodes = stage(nodes.agg(F.min(F.struct("ord", "tag")).alias("head"), F.first("n_shingles").alias("n_shingles"), F.first("sign").alias("sign")), "nodes")
    repeated = stage(described.filter("node is not null").groupBy("ord", "tag").count().filter("count > 1").select("ord", "tag"), "repeated")
    texts = _once(named, repeated)
    clusters = _clusters(texts, nodes, region)
    links = stage(confirmed_links(texts, nodes, clusters, percent), "confirmed")
    roots = components(links)
    heads = stage(nodes.select("node", "head").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "heads")
    lowest = stage(heads.groupBy("root").agg(F.min("head.ord").alias("lowest")), "lowest")
    heads = heads.join(lowest, "root").select("node", "lowest")
    found = described.select("ord", "tag", "n_shingles", "node").join(heads, "node", "left")
    return found.select("ord", "tag", "n_shingles", F.coalesce("lowest", "ord").alias("lowest"))


def near_duplicates(docs: DataFrame, percent: int = 75, region: int = REGION) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    found = _judged(docs, percent, region)
    public = lambda c: F.when(F.col(c) < LAST, F.col(c))
    return found.select(
        public("ord").alias("doc_id"), "n_shingles", public("lowest").alias("component_id"), (F.col("ord") == F.col("lowest")).alias("kept")
    )


def keep_one(docs: DataFrame, percent: int = 75, region: int = REGION) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: the smallest doc_id of each component stays, repeated rows once."""
    found = stage(_judged(docs, percent, region).select("ord", "tag", "lowest"), "judged")
    gone = found.filter("ord > lowest").select("ord", "tag").distinct()
    left = _named(packed(docs)).join(sent(gone), ["ord", "tag"], "left_anti")
    repeated = found.filter("ord = lowest").groupBy("ord", "tag").count().filter("count > 1").select("ord", "tag")
    return unpacked(_once(left, repeated), docs)


def _once(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with one row for each (ord, tag) in ``repeated``."""
    if repeated.isEmpty():
        return rows
    once = rows.join(sent(repeated), ["ord", "tag"], "left_semi").dropDuplicates(["ord", "tag"])
    return rows.join(sent(repeated), ["ord", "tag"], "left_anti").unionByName(once)
