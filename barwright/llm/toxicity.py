"""Toxicity: misspelled lexicon terms found by Levenshtein automata, weighed by their context.

Learning. The lexicon is learned from labelled rows. Candidates are all words and all beginnings of words; one
becomes a term if the documents that have it are toxic so consistently that even the lower bound of their
rate is high, and the longest of equally frequent beginnings stands for the others. A beginning that goes on
in several ways is a stem and matches with any ending. Copies of one text count once, so that no accident of a
text that was copied becomes a term.

Finding. The trie of the terms is intersected with the Levenshtein automaton of each (words: no edit below 4
bytes, one up to 7, two from 8 on; stems: one from 6 on) by subset construction; the result is one table,
state x byte class -> state, with the best (term, edits) at accepting states. The words of a batch walk
through it together, one byte position at a time, and drop out as soon as no term is in reach.

Weighing. A hit counts the toxic rate of the sample's documents with such hits, by term and number of edits; a
misspelling never seen counts most of its term. The ``CONTEXT`` words on both sides tell quotation from
abuse: whether quotation marks stand around the hit (an apostrophe inside a word is none), a verb of saying before
it, and a word that addresses somebody near it. The strongest hit, the sum and the density of hits, and the
sums of quoted, reported and addressed hits become a probability by logistic regression on the sample; its
penalty draws the weights of the context towards ``PRIOR`` where the sample says little.

The lexicon holds every word and stem that passes; the bounded sample bounds it. Every text is scored whole, from its text alone. Null and empty texts have no hits and get the score of a text
without hits. A null label teaches nothing; without labels of both kinds every score is the share of the labels
there are (0 without any). Repeated rows are scored alike; ties between terms go to the one that sorts first.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.llm import kernel, neardup
from barwright.llm.carry import packed, unpacked
from barwright.llm.langid import bounded_sample
from barwright.sources.staging import stage

#: Labelled rows to learn from (a bounded sample by hash of doc_id).
TRAIN_ROWS = 16_000
#: A term needs so many toxic documents, and a lower bound of the toxic rate (95 %) of at least this.
LEAST_DOCS, LEAST_RATE = 5, 0.6
SHORTEST, LONGEST = 3, 12
#: A misspelling counts this share of its term for every edit until the sample says otherwise, as if seen so often.
EDIT_SHARE, EDIT_PRIOR = 0.75, 4
CONTEXT = 8

# Words that report speech, and words that address somebody.
REPORTING = ("said", "says", "say", "called", "calls", "quote", "quoted", "quotes", "wrote", "writes", "word", "term", "according", "claimed", "told")
ADDRESSING = ("you", "your", "yours", "youre", "u", "ur", "they", "he", "she", "dich", "du", "dein", "tu", "toi", "vous", "usted", "ustedes")
#: Weights that the fit starts from: strongest hit, sum, density; quoted, reported, addressed hits.
PRIOR = (0.0, 0.0, 0.0, -1.0, -0.5, 0.25)
#: Quotation marks become plain ones before words are cut.
_QUOTES = (("[“”„«»‹›`]", '"'), ("[‘’]", "'"))
_MARK = re.compile(r"\"|(?<![^\W_])'|'(?![^\W_])")  # an apostrophe with letters on both sides is part of a word


@dataclass(frozen=True, order=True)
class Term:
    text: str
    stem: bool = False  # any ending may follow

    @property
    def edits(self) -> int:
        n = len(self.text.encode())
        return int(n >= 6) if self.stem else 0 if n < 4 else 1 if n < 8 else 2


@dataclass(frozen=True)
class Automaton:
    """The lexicon's Levenshtein automata as one table; state 0 is dead, state 1 the start."""

    terms: tuple[Term, ...]
    classes: np.ndarray  # byte -> class
    step: np.ndarray  # state x class -> state
    term: np.ndarray  # (2, state) -> term of a word that ends here, of a stem that is passed here; -1 if none
    edits: np.ndarray


def build_automaton(terms: list[Term]) -> Automaton:
    """Subset construction over (trie node, edits used) pairs."""
    words = [t.text.encode() for t in terms]
    children: list[dict[int, int]] = [{}]
    ends: dict[int, list[int]] = {}
    budget: list[int] = [0]  # the most edits that a term below the node may use
    for i, word in enumerate(words):
        node = 0
        budget[0] = max(budget[0], terms[i].edits)
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                budget.append(0)
            node = children[node][byte]
            budget[node] = max(budget[node], terms[i].edits)
        ends.setdefault(node, []).append(i)
    alphabet = sorted({b for w in words for b in w})
    classes = np.full(256, len(alphabet), np.int32)
    classes[alphabet] = np.arange(len(alphabet))

    def closed(pairs: dict[int, int]) -> frozenset[tuple[int, int]]:
        """Fewest edits per node, term bytes being skipped at one edit each."""
        todo = list(pairs.items())
        while todo:
            node, used = todo.pop()
            if pairs.get(node, 9) < used:
                continue
            for child in children[node].values():
                if used + 1 <= budget[child] and used + 1 < pairs.get(child, 9):
                    pairs[child] = used + 1
                    todo.append((child, used + 1))
        return frozenset(pairs.items())

    start = closed({0: 0})
    known, table, order = {frozenset(): 0, start: 1}, [[0] * (len(alphabet) + 1)], [start]
    for state in order:
        row = []
        for symbol in [*alphabet, None]:
            pairs: dict[int, int] = {}
            for node, used in state:
                moves = [(node, used + 1)] if used + 1 <= budget[node] else []  # a byte too many
                moves += [(child, used + (byte != symbol)) for byte, child in children[node].items()]
                for to, cost in moves:
                    if cost <= budget[to] and cost < pairs.get(to, 9):
                        pairs[to] = cost
            following = closed(pairs)
            if following not in known:
                known[following] = len(known)
                order.append(following)
            row.append(known[following])
        table.append(row)
    term, edits = np.full((2, len(known)), -1, np.int32), np.full((2, len(known)), 9, np.int32)
    for state, number in known.items():
        for stem in (False, True):
            reached = [(used, terms[i], i) for node, used in state for i in ends.get(node, ()) if used <= terms[i].edits and (terms[i].stem or not stem)]
            if reached:
                best = min(reached)
                edits[int(stem), number], term[int(stem), number] = best[0], best[2]
    return Automaton(tuple(terms), classes, np.array(table, np.int32), term, edits)


def _plain(texts: pa.Array) -> pa.Array:
    plain = texts.cast(pa.large_string())
    for marks, mark in _QUOTES:
        plain = pc.replace_substring_regex(plain, marks, mark)
    return pc.utf8_lower(plain)


def split_words(texts: pa.Array) -> kernel.Words:
    """Lower-cased runs of letters, digits and other characters beyond ASCII; quotation marks are none of them."""
    return kernel.split(_plain(texts), kernel.SYMBOL)


def find(words: kernel.Words, automaton: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, term, edits) of every word that is a term or a misspelling of one."""
    data, n = words.data, len(words.starts)
    alive, state = np.arange(n), np.ones(n, np.int32)
    best, term = np.full(n, 9, np.int32), np.full(n, -1, np.int32)
    offset = 0
    while len(alive):
        done = words.ends[alive] - words.starts[alive] == offset
        for which, own, at in ((0, alive[done], state[done]), (1, alive[~done], state[~done])):
            better = automaton.edits[which, at] < best[own]
            best[own[better]], term[own[better]] = automaton.edits[which, at[better]], automaton.term[which, at[better]]
        alive, state = alive[~done], state[~done]
        state = automaton.step[state, automaton.classes[data[words.starts[alive] + offset]]]
        alive, state = alive[state > 0], state[state > 0]
        offset += 1
    at = np.flatnonzero(term >= 0)
    return at, term[at], best[at]


def context(words: kernel.Words, at: int, low: int, high: int, begin: int, end: int) -> tuple[bool, bool, bool]:
    """Whether the hit at word ``at`` of a document, words low:high and bytes begin:end, is quoted, reported, addressed
    to somebody."""
    first, last = max(low, at - CONTEXT), min(high, at + CONTEXT + 1)
    # some signs on both ends, so that marks beside the first and the last word count
    before = words.data[max(begin, words.starts[first] - 4) : words.starts[at]].tobytes().decode("utf-8", "ignore")
    after = words.data[words.ends[at] : min(end, words.ends[last - 1] + 4)].tobytes().decode("utf-8", "ignore")
    quoted = len(_MARK.findall(before + "x")) % 2 == 1 and _MARK.search("x" + after) is not None
    ahead = set(re.findall(r"\w+", before))
    near = ahead | set(re.findall(r"\w+", after))
    return quoted, bool(ahead & set(REPORTING)), bool(near & set(ADDRESSING))


def features(texts: pa.Array, automaton: Automaton, weights: np.ndarray) -> np.ndarray:
    """Per text: strongest hit, sum of hits (log), hits per 100 words (log), and the sums (log) of quoted, reported and
    addressed hits. ``weights``: term x edits."""
    plain = _plain(texts)
    words, bounds = kernel.split(plain, kernel.SYMBOL), kernel.buffers(plain)[1]
    at, term, edits = find(words, automaton)
    out = np.zeros((len(texts), len(PRIOR)))
    value = weights[term, edits]
    at, value = at[value > 0.02], value[value > 0.02]
    if len(at):
        doc = np.searchsorted(words.first, at, "right") - 1
        around = np.array([context(words, i, words.first[d], words.first[d + 1], bounds[d], bounds[d + 1]) for i, d in zip(at, doc, strict=True)])
        np.maximum.at(out[:, 0], doc, value)
        total = np.bincount(doc, value, len(texts))
        out[:, 1] = np.log1p(total)
        out[:, 2] = np.log1p(100 * total / np.maximum(1, np.diff(words.first)))
        for k in range(3):
            out[:, 3 + k] = np.log1p(np.bincount(doc, value * around[:, k], len(texts)))
    return out


@dataclass(frozen=True)
class Model:
    automaton: Automaton
    weights: np.ndarray
    coefficients: np.ndarray  # intercept first


def _offsets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    at, toxic = 0, batch.column("toxic").to_numpy().astype(bool)
    for part in kernel.slices(batch, "text"):
        yield toxic[at : at + len(part)], part
        at += len(part)


def _beginnings(words: kernel.Words, toxic: np.ndarray) -> Iterator[dict]:
    """Documents and toxic documents of every word and every beginning of a word, one length after the other."""
    data = words.data
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    _, own = np.unique(kernel.mix(words.hash, 31) + kernel.mix(doc.astype(np.uint64), 32), return_index=True)  # each word once a document
    own = np.sort(own)
    starts, ends, doc = words.starts[own], words.ends[own], doc[own]
    padded = np.append(data, 0)
    for length in range(SHORTEST, LONGEST + 2):
        whole = length > LONGEST
        fits = ends - starts >= SHORTEST if whole else ends - starts >= length
        stop = ends[fits] if whole else starts[fits] + length
        first, of = starts[fits], doc[fits]
        if not whole:  # not inside a character
            clean = (stop == ends[fits]) | (padded[stop] & 0xC0 != 0x80)
            first, stop, of = first[clean], stop[clean], of[clean]
        if not len(first):
            continue
        key = kernel.word_hashes(data, first, stop)
        _, once = np.unique(kernel.mix(key, 33) + kernel.mix(of.astype(np.uint64), 34), return_index=True)
        _, at, which = np.unique(key[once], return_index=True, return_inverse=True)
        spelled = [data[first[i] : stop[i]].tobytes().decode("utf-8", "replace") for i in once[at]]
        bad = np.bincount(which, toxic[of[once]], len(at)).astype(np.int64)
        yield {"part": spelled, "whole": [whole] * len(at), "n": np.bincount(which, minlength=len(at)), "bad": bad}


def learn_terms(sample: DataFrame) -> list[Term]:
    """The lexicon of a sample (text, toxic)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, part in _offsets(batch):
                for rows in _beginnings(split_words(part.column("text")), toxic):
                    yield pa.RecordBatch.from_pydict(rows)

    counts = sample.mapInArrow(count, "part string, whole boolean, n long, bad long").groupBy("part", "whole")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rate, n, z2 = F.col("bad") / F.col("n"), F.col("n"), 1.96**2  # lower end of the Wilson interval
    lower = (rate + z2 / (2 * n) - 1.96 * F.sqrt(rate * (1 - rate) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    good = counts.filter(F.col("bad") >= LEAST_DOCS).withColumn("rate", lower).filter(F.col("rate") >= LEAST_RATE)
    rows = good.collect()  # parts of the bounded sample's words
    wholes = {r["part"]: r["bad"] for r in rows if r["whole"]}
    parts = {r["part"]: (r["bad"], r["rate"]) for r in rows if not r["whole"]}
    longer: dict[str, int] = {}  # the most documents of a longer beginning
    for part, (bad, _) in parts.items():
        for k in range(SHORTEST, len(part)):
            longer[part[:k]] = max(longer.get(part[:k], 0), bad)
    terms = []
    for part, (bad, rate) in parts.items():
        if longer.get(part, 0) >= 0.95 * bad:  # a longer one says the same
            continue
        shorter = [parts[part[:k]] for k in range(SHORTEST, len(part)) if part[:k] in parts]
        if any(b * 0.95 > bad and r >= rate - 0.01 for b, r in shorter):  # a shorter one says more, as surely
            continue
        terms.append((bad, Term(part, wholes.get(part, 0) < 0.8 * bad)))
    covered = {t.text for _, t in terms}
    for word, bad in wholes.items():  # words whose beginnings are too common, or that are too long
        if not any(word[:k] in covered for k in range(SHORTEST, len(word) + 1)):
            terms.append((bad, Term(word)))
    return sorted(t for _, t in terms)


def learn_weights(sample: DataFrame, automaton: Automaton) -> np.ndarray:
    """term x edits: the toxic rate of documents with such hits, drawn to a share of the term's own where few are seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, part in _offsets(batch):
                words = split_words(part.column("text"))
                at, term, edits = find(words, automaton)
                doc = np.searchsorted(words.first, at, "right") - 1
                seen = np.unique(np.stack([doc, term, edits], axis=1), axis=0)
                yield pa.RecordBatch.from_pydict({"term": seen[:, 1].astype(np.int64), "edits": seen[:, 2].astype(np.int64), "bad": toxic[seen[:, 0]].astype(np.int64)})

    counts = sample.mapInArrow(count, "term long, edits long, bad long").groupBy("term", "edits").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    n, bad = np.zeros((2, len(automaton.terms), 10))
    for r in counts.collect():  # at most three rows per term
        n[r["term"], r["edits"]], bad[r["term"], r["edits"]] = r["n"], r["bad"]
    weights = np.zeros_like(n)
    weights[:, 0] = (bad[:, 0] + 0.5) / (n[:, 0] + 1)
    for e in range(1, n.shape[1]):
        weights[:, e] = (bad[:, e] + EDIT_PRIOR * EDIT_SHARE**e * weights[:, 0]) / (n[:, e] + EDIT_PRIOR)
        weights[n[:, e] > 20, e] *= np.clip((bad[:, e] / np.maximum(n[:, e], 1))[n[:, e] > 20] * 2 - 0.6, 0, 1)  # as common among clean texts
    return weights


def one_of_copies(sample: DataFrame) -> DataFrame:
    """(text, toxic) without most of the near-copies: texts whose smallest shingle is the same, by either of two hashes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                hashes, first = neardup.shingle_sets(part.column("text"))
                some = np.flatnonzero(np.diff(first))
                signs = np.zeros((2, len(part)), np.uint64)
                for k in (0, 1):
                    signs[k, some] = np.minimum.reduceat(kernel.mix(hashes, 41 + k), first[some]) if len(some) else 0
                yield pa.RecordBatch.from_arrays([part.column("text"), part.column("toxic"), *(pa.array(x.view(np.int64)) for x in signs)], ["text", "toxic", "a", "b"])

    signed = sample.mapInArrow(sign, "text string, toxic int, a long, b long")
    # the smallest of each group, so that every run learns from the same texts
    one = signed.groupBy("a").agg(F.min(F.struct("b", "text", "toxic")).alias("row")).select("row.*")
    return one.groupBy("b").agg(F.min(F.struct("text", "toxic")).alias("row")).select("row.*")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50, prior: Sequence[float] | None = None) -> np.ndarray:
    """Newton's method on standard log loss; intercept first. The penalty draws the weights to ``prior`` (else to 0)."""
    origin = np.concatenate([[0.0], np.zeros(x.shape[1]) if prior is None else prior])
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    beta = origin.copy()
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - y) / len(y) + penalty @ (beta - origin)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty
        move = np.linalg.solve(curve, slope)
        beta -= np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on about ``train_rows`` rows (doc_id, text, toxic)."""
    rows = labelled.filter("toxic is not null").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    sample = stage(one_of_copies(bounded_sample(rows, train_rows).select("text", "toxic")), "toxicity-sample")
    automaton = build_automaton(learn_terms(sample))
    weights = learn_weights(sample, automaton)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _offsets(batch):
                x = features(part.column("text"), automaton, weights)
                yield pa.RecordBatch.from_arrays([part.column("toxic").cast(pa.int64()), *(pa.array(c) for c in x.T)], ["y", *names])

    names = [f"x{i}" for i in range(len(PRIOR))]
    table = sample.mapInArrow(describe, "y long, " + ", ".join(f"{n} double" for n in names)).toPandas()  # a few numbers for each row of the sample
    table = table.sort_values(["y", *names])  # sums are taken in one order
    y = table["y"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        share = float(y.mean()) if len(y) else 0.0
        odds = math.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
        return Model(automaton, weights, np.array([odds] + [0.0] * len(PRIOR)))
    return Model(automaton, weights, fit_logistic(table[names].to_numpy(), y, prior=PRIOR))


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    x = features(texts, model.automaton, model.weights)
    return 1 / (1 + np.exp(-np.clip(model.coefficients[0] + x @ model.coefficients[1:], -30, 30)))


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """The columns of ``rows`` but ``text``, which is read whole, and its ``score``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # the sample bounds its terms
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                score = pa.array(score_texts(part.column("text"), sent.value), pa.float64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), score], [*names, "score"])

    kept = [f for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    return _scored(docs.select("doc_id", "text"), model)


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    scored = _scored(packed(docs).select("row", "text"), model)
    return unpacked(scored.filter(F.col("score") < limit), docs)
