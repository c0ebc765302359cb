"""Quality classifier: a generalised additive model with pairwise interactions, fitted by cyclic boosting.

Each feature of a text has a lookup table over its bins, and each chosen pair of features one over pairs of
coarse bins. Boosting goes round the features again and again, adding to each table a small step of a
shallow tree grown on the current gradients; the pairs whose four-way cut explains most of what is left are
then boosted alike. A text's score is the sigmoid of a sum of table entries: one vectorised look-up per
table.

The model is fitted on a bounded sample of labelled rows (about ``TRAIN_ROWS``, by hash of doc_id), of which
only the features reach the driver. Every text is scored whole, from its text alone. Null and empty texts have the
features of no words. A null label teaches nothing; without labels of both kinds every score is the share
of the labels there are (0 without any). Repeated rows count repeatedly in training and are scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm import kernel
from barwright.llm.langid import bounded_sample

TRAIN_ROWS = 16_000
BINS, PAIR_BINS = 48, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE, LEAST_LEAF = 0.15, 12

FEATURES = (
    "log_words", "word_length", "longest_word", "symbol_share", "upper_share", "digit_share", "beyond_ascii_share",
    "bare_symbol_words", "symbol_tail_words", "capital_words", "short_words", "distinct_words", "commonest_word",
    "repeats_previous", "log_lines", "words_per_line", "distinct_lines", "sentence_ends",
)


def _table(texts: pa.Array) -> np.ndarray:
    """texts x FEATURES."""
    words = kernel.split(texts)
    data, (_, bounds) = words.data, kernel.buffers(texts)
    docs, n_words = len(texts), np.diff(words.first)
    doc = np.repeat(np.arange(docs), n_words)
    size = np.maximum(np.diff(bounds), 1)

    def share_of_bytes(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[bounds[1:]] - total[bounds[:-1]]) / size

    def share_of_words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc, flags, docs) / np.maximum(n_words, 1)

    symbol = kernel.SYMBOL[data] & ~kernel.SPACE[data]
    upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    length = words.ends - words.starts
    marks = np.concatenate([[0], np.cumsum(symbol)])
    capitals = np.concatenate([[0], np.cumsum(upper)])
    inside = marks[words.ends] - marks[words.starts]
    tail = np.zeros(len(length))
    long_enough = length >= 3
    last = words.ends[long_enough]
    tail[long_enough] = symbol[last - 1] & symbol[last - 2]
    order = np.lexsort((words.hash, doc))
    sorted_doc, sorted_hash = doc[order], words.hash[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (sorted_doc[1:] != sorted_doc[:-1]) | (sorted_hash[1:] != sorted_hash[:-1])
    runs = np.diff(np.append(np.flatnonzero(fresh), len(order)))
    commonest = np.zeros(docs)
    np.maximum.at(commonest, sorted_doc[fresh], runs)
    again = np.zeros(len(doc))
    again[1:] = (doc[1:] == doc[:-1]) & (words.hash[1:] == words.hash[:-1])
    longest = np.zeros(docs)
    np.maximum.at(longest, doc, length)
    newline = np.concatenate([[0], np.cumsum(data == 10)])
    lines = 1 + newline[bounds[1:]] - newline[bounds[:-1]]
    line_of = newline[words.starts] if len(doc) else np.empty(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], (line_of[1:] != line_of[:-1]) | (doc[1:] != doc[:-1])])) if len(doc) else np.empty(0, np.int64)
    line_hash = kernel.range_hash(words.hash, heads, np.append(heads[1:], len(doc)), 0xE7037ED1A0B428DB) if len(heads) else np.empty(0, np.uint64)
    line_doc = doc[heads]
    full_lines = np.bincount(line_doc, minlength=docs)
    _, once = np.unique(kernel.mix(line_hash, 3) + kernel.mix(line_doc.astype(np.uint64), 4), return_index=True)
    ends = np.isin(data[words.ends - 1], np.frombuffer(b".!?", np.uint8)) if len(doc) else np.empty(0)
    return np.stack([
        np.log1p(n_words), np.bincount(doc, length, docs) / np.maximum(n_words, 1), longest,
        share_of_bytes(symbol), share_of_bytes(upper), share_of_bytes(digit), share_of_bytes(data >= 0x80),
        share_of_words(inside == length), share_of_words(tail), share_of_words((capitals[words.ends] - capitals[words.starts]) * 2 > length),
        share_of_words(length <= 3), np.bincount(sorted_doc[fresh], minlength=docs) / np.maximum(n_words, 1), commonest / np.maximum(n_words, 1),
        share_of_words(again), np.log1p(lines), n_words / lines, np.bincount(line_doc[once], minlength=docs) / np.maximum(full_lines, 1),
        share_of_words(ends),
    ], axis=1)


@dataclass(frozen=True)
class Model:
    """Cut points per feature, a table per feature, and tables of chosen pairs over coarse bins."""

    intercept: float
    cuts: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pair_cuts: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int], ...]
    pair_tables: tuple[np.ndarray, ...]


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """The step of each bin from a tree on one feature, grown on sums per bin."""
    step = np.full(len(g), -g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return step
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
    gain[(left_n < LEAST_LEAF) | (n.sum() - left_n < LEAST_LEAF)] = -1
    cut = int(np.argmax(gain)) + 1
    if gain[cut - 1] <= _gain(g.sum(), h.sum()) + 1e-9:
        return step
    return np.concatenate([_shallow_tree(g[:cut], h[:cut], n[:cut], depth - 1), _shallow_tree(g[cut:], h[cut:], n[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, step): the best cut of one feature, then the best of the other on either side."""
    best, step = -1.0, np.zeros_like(g)
    for turn in (False, True):
        gg, hh, nn = (x.T for x in (g, h, n)) if turn else (g, h, n)
        for cut in range(1, len(gg)):
            total, out = 0.0, np.zeros_like(gg)
            for rows in (slice(0, cut), slice(cut, None)):
                own = _shallow_tree(gg[rows].sum(0), hh[rows].sum(0), nn[rows].sum(0), 1)
                out[rows] = own
                for value in np.unique(own):
                    at = own == value
                    total += float(_gain(gg[rows][:, at].sum(), hh[rows][:, at].sum()))
            if total > best:
                best, step = total, out.T if turn else out
    return best, step


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost on rows of features and labels 0 or 1."""
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Model(30.0 if share else -30.0, (), (), (), (), ())
    cuts = tuple(_cuts(c, BINS) for c in x.T)
    bins = [np.searchsorted(c, v, "right") for c, v in zip(cuts, x.T, strict=True)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    intercept = math.log(share / (1 - share))
    total = np.full(len(y), intercept)
    for _ in range(ROUNDS):
        for table, at in zip(tables, bins, strict=True):
            p = _sigmoid(total)
            g, h = (np.bincount(at, v, len(table)) for v in (p - y, p * (1 - p)))
            step = RATE * _shallow_tree(g, h, np.bincount(at, minlength=len(table)))
            table += step
            total += step[at]
    pair_cuts = tuple(_cuts(c, PAIR_BINS) for c in x.T)
    coarse = [np.searchsorted(c, v, "right") for c, v in zip(pair_cuts, x.T, strict=True)]

    def sums(i: int, j: int) -> tuple[np.ndarray, ...]:
        shape, at = (len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1), coarse[i] * (len(pair_cuts[j]) + 1) + coarse[j]
        p = _sigmoid(total)
        return tuple(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (p - y, p * (1 - p), np.ones(len(y))))

    gains = sorted(((-_pair_tree(*sums(i, j))[0], i, j) for i, j in combinations(range(x.shape[1]), 2)))
    pairs = tuple((i, j) for _, i, j in gains[:PAIRS])
    pair_tables = [np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for table, (i, j) in zip(pair_tables, pairs, strict=True):
            step = RATE * _pair_tree(*sums(i, j))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return Model(intercept, cuts, tuple(tables), pair_cuts, pairs, tuple(pair_tables))


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    x = _table(texts)
    total = np.full(len(x), model.intercept)
    for column, cuts, table in zip(x.T, model.cuts, model.tables, strict=False):
        total += table[np.searchsorted(cuts, column, "right")]
    for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
        total += table[np.searchsorted(model.pair_cuts[i], x[:, i], "right"), np.searchsorted(model.pair_cuts[j], x[:, j], "right")]
    return _sigmoid(total)


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on about ``train_rows`` rows (doc_id, text, quality)."""
    rows = labelled.filter("quality is not null").select("doc_id", "text", F.col("quality").cast("long").alias("quality"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                x = _table(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("quality"), *(pa.array(c) for c in x.T)], ["y", *FEATURES])

    schema = "y long, " + ", ".join(f"{f} double" for f in FEATURES)
    table = bounded_sample(rows, train_rows).select("text", "quality").mapInArrow(describe, schema).orderBy("y", *FEATURES).toPandas()
    return fit(table[list(FEATURES)].to_numpy(float), table["y"].to_numpy(float))


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # tables of a fixed number of bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score_texts(part.column("text"), sent.value), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
