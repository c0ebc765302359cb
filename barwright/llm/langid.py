"""Language ID: multinomial naive Bayes over hashed character n-grams.

Characters that are no letters become one space, letters are lower-cased, and the 1- to 3-grams of what is
left are hashed into ``BUCKETS`` counters per language. The table of log-probabilities (languages x
buckets) goes to every task; a batch of texts is scored as a sparse product: the n-grams of all its texts are found
at once, and for each language their log-probabilities are gathered and summed per text.

Training counts n-grams over a bounded sample of labelled rows (about ``train_rows``, by hash of
doc_id and text); every text is scored whole. A null text, or one without a letter, is ``und`` with score 0. Rows
whose language is null teach nothing; without any labelled row all is ``und``. Repeated rows count
repeatedly. Ties go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm import kernel

BUCKETS = 1 << 15
TRAIN_ROWS = 12_000
#: Characters worked on at once; a longer text is cut, its sums carried on.
STRIDE = 1 << 20


@cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages


def gram_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(first, buckets): the hashed 1- to 3-grams of text i, spaces around words included, are
    buckets[first[i]:first[i + 1]]; none if it has no letter. Texts beyond ``STRIDE`` characters are cut there."""
    pieces = [(i, t[at : at + STRIDE].lower()) for i, t in enumerate(texts) if t for at in range(0, len(t), STRIDE)]
    if not pieces:
        return np.zeros(len(texts) + 1, np.int64), np.empty(0, np.int64)
    points = np.frombuffer("".join(f" {p} " for _, p in pieces).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([len(p) + 2 for _, p in pieces])
    starts = ends - np.diff(ends, prepend=0)
    known = letter_table()[points]
    keep = known.copy()
    keep[1:] |= known[:-1]  # one space after each word
    edge = np.zeros(len(points), bool)
    edge[starts] = edge[ends - 1] = True
    piece = np.repeat(np.arange(len(pieces)), np.diff(ends, prepend=0))
    lettered = np.logical_or.reduceat(known, starts)
    keep = (keep | edge) & lettered[piece]
    c = np.where(known, points, 32)[keep].astype(np.uint64)
    piece, edge = piece[keep], edge[keep]
    with np.errstate(over="ignore"):
        a = c * np.uint64(0x9E3779B97F4A7C15)
        two = a[:-1] * np.uint64(31) + c[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        three = two[:-1] * np.uint64(31) + c[2:] * np.uint64(0x165667B19E3779F9)
    inside = [~edge, piece[:-1] == piece[1:], piece[:-2] == piece[2:]]
    owner = np.array([i for i, _ in pieces])[piece]
    grams = [kernel.mix(x[k], salt) >> np.uint64(64 - BUCKETS.bit_length() + 1) for x, k, salt in zip((a, two, three), inside, (1, 2, 3), strict=True)]
    text = np.concatenate([owner[: len(k)][k] for k in inside])
    if len(texts) < 1 << 16:
        text = text.astype(np.uint16)  # sorted by digits
    order = np.argsort(text, kind="stable")
    return np.searchsorted(text[order], np.arange(len(texts) + 1)), np.concatenate(grams)[order].astype(np.int64)


def bounded_sample(rows: DataFrame, about: int) -> DataFrame:
    """The rows (doc_id, text, ...) whose hash of both falls into a share that holds about so many; all, if there are no
    more. Nothing is sorted or moved for it."""
    n = rows.count()
    if n <= about:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(int((1 << 30) * about / n)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents and n-gram counts of each language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in kernel.slices(batch, "text"):
            langs = np.array(part.column("lang").to_pylist(), object)
            first, buckets = gram_buckets(part.column("text").to_pylist())
            for lang in set(langs):
                own = np.repeat(langs == lang, np.diff(first))
                row = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                row[:BUCKETS] += np.bincount(buckets[own], minlength=BUCKETS)
                row[BUCKETS] += np.count_nonzero(langs == lang)
    for lang, row in counts.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": at, "n": row[at]})


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS, smoothing: float = 0.5) -> Model:
    """Fit on about ``train_rows`` rows (doc_id, text, lang) with a language. What reaches the driver is one
    count per language and bucket."""
    known = labelled.filter("lang is not null").select("doc_id", "lang", "text")
    sample = bounded_sample(known, train_rows)
    counts = (
        sample.select("lang", "text").mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = tuple(sorted(counts["lang"].unique()))
    table = np.zeros((BUCKETS + 1, max(1, len(languages))))
    for i, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        table[own["bucket"], i] = own["n"]
    grams = table[:BUCKETS] + smoothing
    log_prob = np.log(grams / grams.sum(axis=0))
    docs = table[BUCKETS] + 1.0
    return Model(languages, np.log(docs / docs.sum()), log_prob.astype(np.float32))


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and posterior of each text; per n-gram evidence is discounted as neighbours overlap."""
    first, buckets = gram_buckets(texts)
    some = np.flatnonzero(np.diff(first))
    found, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not len(some) or not model.languages:
        return found, scores
    columns = [np.add.reduceat(column[buckets], first[some], dtype=np.float64) for column in np.ascontiguousarray(model.log_prob.T)]
    joint = model.log_prior + np.stack(columns, axis=1) / 3.0
    odds = np.exp(joint - joint.max(axis=1, keepdims=True))
    best = np.argmax(odds, axis=1)
    share = odds[np.arange(len(some)), best] / odds.sum(axis=1)
    for i, b, s in zip(some, best, share, strict=True):
        found[i], scores[i] = model.languages[b], float(s)
    return found, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                found, scores = score_texts(part.column("text").to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of doc_id as text leaves the remainder; a null doc_id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
