from __future__ import annotations

import random
import re

import numpy as np
import pytest

from barwright.llm import components, neardup

FOLD = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or (frozenset([tuple(words)]) if words else frozenset())


def brute(rows, percent=75):
    """Every pair compared; the smallest doc_id of each component (null: the largest)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    key = lambda i: neardup.LAST if rows[i][0] is None else rows[i][0]
    lowest = {r: min(key(i) for i in range(len(rows)) if find(i) == r) for r in {find(i) for i in range(len(rows))}}
    out = []
    for i, (doc_id, _) in enumerate(rows):
        low = lowest[find(i)]
        out.append((doc_id, len(sets[i]), None if low == neardup.LAST else low, key(i) == low))
    return out


def corpus(groups=14, seed=1, spread=25, common=""):
    """Groups around a text: copies, small and large edits, some near the threshold."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(groups):
        base = random.choices(vocabulary, k=random.randint(30, 150))
        rows.append(" ".join(base))
        for _ in range(random.choice([0, 1, 3, spread])):
            words = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 22))):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            rows.append(" ".join(words).upper() if random.random() < 0.2 else common + " ".join(words))
    ids = random.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


EDGES = [(3, None), (4, ""), (5, " \t\n"), (6, "one two"), (7, "ONE  two"), (8, "one two three"), (9, "a b c d e"), (9, "a b c d e"), (None, "a b c d e"),
         (None, "alone in here with nobody else"), (11, "É b c d e"), (12, "é b c d e"), (13, "x " * 3000), (14, "X " * 50)]


def same(found, expected):
    order = lambda rows: sorted(rows, key=str)
    assert order([tuple(r) for r in found]) == order(expected)


@pytest.mark.parametrize("seed, common", [(1, ""), (2, "the same few words stand at the head of many texts here ")])
def test_equals_all_pairs(make_docs, seed, common):
    rows = corpus(seed=seed, common=common) + EDGES
    docs = make_docs([(*r, 1, "x", "y", "z") for r in rows], ord=int, tag=str, node=str, root=str).repartition(5)
    same(neardup.near_duplicates(docs).collect(), brute(rows))


def test_large_regions_and_clusters_are_split_without_losing_links(make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 9)
    rows = corpus(groups=4, seed=4, spread=40)
    same(neardup.near_duplicates(make_docs(rows), region=6).collect(), brute(rows))


@pytest.mark.parametrize("region, members", [(3, 80), (24, 80)])
def test_members_of_a_dense_group_stay_linked_though_its_regions_are_cut(make_docs, region, members):
    """Each is one text and some words of its own, at 0.76 to it and 0.61 to others: cut at depth 4 or 8, many are left alone."""
    base = " ".join(f"b{i}" for i in range(150))
    rows = [(0, base)] + [(n, base + "".join(f" own{n}x{i}" for i in range(46))) for n in range(1, members)]
    same(neardup.near_duplicates(make_docs(rows), region=region).collect(), brute(rows))


def test_dense_regions_of_texts_that_are_no_duplicates_get_deeper_orders(make_docs, monkeypatch):
    """90 texts at 0.5 to each other, so that many share two values or four, with a pair near the threshold in every sixth."""
    monkeypatch.setattr(neardup, "MOST_BLOCK_PAIRS", 4)
    monkeypatch.setattr(neardup, "DEEPER", (3, 4))
    deeper, depths = neardup._deeper, []
    monkeypatch.setattr(neardup, "_deeper", lambda texts, nodes, depth, region: depths.append(depth) or deeper(texts, nodes, depth, region))
    base = " ".join(f"b{i}" for i in range(100))
    rows = [(n, base + "".join(f" own{n}x{i}" for i in range(50))) for n in range(90)]
    rows += [(100 + n, rows[n][1] + "".join(f" more{n}x{i}" for i in range(46))) for n in range(0, 90, 6)] + [(None, base), (300, "")]
    same(neardup.near_duplicates(make_docs(rows), region=8).collect(), brute(rows))
    assert depths == [3, 4]


def test_neighbour_links_span_the_components_of_all_pairs():
    rng = np.random.default_rng(3)
    for n in (2, 3, 9, 60):
        for _ in range(20):
            label = rng.integers(0, 3, (n, 6)).astype(">u4")
            label = label[np.lexsort(label.T[::-1])]
            signs = np.where(rng.random((n, 40)) < rng.choice([0.2, 0.4, 0.9]), rng.integers(0, 9, (n, 40)), rng.integers(0, 9, (3, 40))[rng.integers(0, 3, n)])
            link = (signs[:, None] == signs[None]).sum(axis=2) >= 24
            reach = np.linalg.matrix_power(link.astype(float), n) > 0
            found = np.eye(n)
            links = neardup.neighbour_links(label, signs, 24)
            for i, j in links:
                assert link[i, j]
                found[i, j] = found[j, i] = 1
            assert ((np.linalg.matrix_power(found, n) > 0) == reach).all() and len(links) < n


def test_regions_deeper_than_the_labels_are_dealt_out_with_a_hub(spark):
    sign = bytes(range(256)) * 2
    nodes = spark.createDataFrame([(bytes([i] * 16), sign) for i in range(25)], "node binary, sign binary")
    found = {}
    for r in neardup.regions(nodes, region=5).collect():
        found.setdefault((r["tree"], bytes(r["prefix"])), set()).add(bytes(r["node"]))
    parts = [m for (tree, _), m in found.items() if tree == 0]
    assert set.union(*parts) == {bytes([i] * 16) for i in range(25)} and set.intersection(*parts) == {bytes(16)} and max(map(len, parts)) < 15


def test_members_of_dense_regions_are_not_copied_for_every_depth(spark, monkeypatch):
    """Labels of few values, most of them common: regions of every depth. One row per member and tree is all that is made."""
    rng, written = np.random.default_rng(5), []
    signs = np.where(rng.random((120, neardup.TREES * neardup.DEPTH)) < 0.8, 0, rng.integers(1, 3, (120, neardup.TREES * neardup.DEPTH))).astype(">u4")
    nodes = spark.createDataFrame([(i.to_bytes(16), s.tobytes()) for i, s in enumerate(signs)], "node binary, sign binary")
    keep = neardup.stage
    monkeypatch.setattr(neardup, "stage", lambda df, label: written.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, label))
    found, whole = neardup._cut(nodes, 20)
    made = [line for plan in written for line in plan.splitlines() if "Generate" in line]
    assert made and all("[tree#" in line for line in made)
    expected, depths = {}, set()
    for tree in range(neardup.TREES):
        labels = [s.reshape(neardup.TREES, -1)[tree].tobytes() for s in signs]
        for i, label in enumerate(labels):
            sharing = {d: sum(x[: 4 * d] == label[: 4 * d] for x in labels) for d in range(neardup.FIRST_DEPTH, neardup.DEPTH + 1)}
            depth = next((d for d, n in sharing.items() if n <= 20), neardup.DEPTH)
            if sharing[depth] > 1:
                expected[tree, i.to_bytes(16)] = (label[: 4 * depth], sharing[depth])
                depths.add(depth)
    rows = [(r["tree"], bytes(r["prefix"]), bytes(r["label"]), bytes(r["node"])) for r in found.collect()]
    assert {(t, m): p[: len(expected[t, m][0])] for t, p, _, m in rows} == {k: p for k, (p, _) in expected.items()} and depths == set(range(2, 9))
    assert all(label[:8] == prefix[:8] for _, prefix, label, _ in rows) and {(r["tree"], bytes(r["node"])) for r in whole.collect()} >= {k for k, (p, _) in expected.items() if len(p) > 8}


def test_keep_one_of_a_dense_group_copies_no_member_for_every_depth(make_docs, monkeypatch):
    """What the pipeline's stage calls: 40 near-copies of a text and 9 others, regions cut at 6."""
    base, written, keep = [f"b{i}" for i in range(120)], [], neardup.stage
    rows = [(n, " ".join([*base[:-2], f"own{n}", f"end{n}"])) for n in range(40)] + [(100 + n, " ".join(f"x{n}y{i}" for i in range(30))) for n in range(9)]
    docs = make_docs(rows)
    monkeypatch.setattr(neardup, "stage", lambda df, label: written.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, label))
    assert sorted(r["doc_id"] for r in neardup.keep_one(docs, region=6).collect()) == [i for i, _, _, kept in brute(rows) if kept]
    assert not [line for plan in written for line in plan.splitlines() if "Generate" in line and "[depth#" in line]


def test_every_text_is_fetched_once_though_ids_are_null_or_repeated(make_docs, monkeypatch):
    """24 groups of two under a null id and under one id, each row three times: 96 nodes, 96 texts."""
    rows = [(i, f"{i} {n} starts " + " ".join(f"g{i}x{n}x{k}" for k in range(40)) + end) for i in (None, 7) for n in range(24) for end in ("", " more")]
    docs, fetched = make_docs(rows * 3), []
    dealt = type(docs).sortWithinPartitions

    def counted(frame, *by):
        if "low" in by:
            fetched.append(frame.count())
        return dealt(frame, *by)

    monkeypatch.setattr(type(docs), "sortWithinPartitions", counted)
    same(neardup.near_duplicates(docs).collect(), brute(rows * 3))
    assert fetched == [96]


def test_keep_one_of_each_group(make_docs):
    rows = [(1, "a b c d e f g", 7), (2, "a b c d e f g", 8), (2, "a b c d e f g", 9), (3, "q r s t u v", 1), (3, "q r s t u v", 1), (3, "other text of this id", 1), (4, None, 2), (5, "", 3)]
    kept = neardup.keep_one(make_docs(rows, ord=int))
    assert kept.columns == ["doc_id", "text", "ord"]
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([rows[0], rows[3], rows[5], rows[6], rows[7]], key=str)
    assert neardup.keep_one(make_docs(rows[:0], ord=int)).count() == 0 == neardup.near_duplicates(make_docs([])).count()


def test_exact_components_equal_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 60, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(60) < rng.choice([0.02, 0.1, 0.2, 0.9]), rng.integers(0, 1 << 60, 60, dtype=np.uint64), base)) for _ in range(80)]
    label = neardup.exact_components(np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets]), 75)
    link = np.array([[100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)) for b in sets] for a in sets])
    reach = np.linalg.matrix_power(link.astype(float), 80) > 0
    assert ((label[:, None] == label[None]) == reach).all()


@pytest.mark.parametrize("links", [[], [(1, 1)], [(1, 2), (2, 1), (2, 3), (5, 4)], [(i, i + 1) for i in range(40)], [(99, i) for i in range(20)], [((i * 37) % 101, (i * 53 + 7) % 101) for i in range(60)], [(None, 3), (3, 4), (4, None)]])
def test_components(spark, links):
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert found == {x: find(x) for x in list(parent)}
