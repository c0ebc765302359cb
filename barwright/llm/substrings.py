"""Substring dedup: passages of ``window`` words that an earlier document already has are cut out.

1. Exact copies of a text are found by digest; only the copy with the smallest doc_id goes on, the others
   lose every word that a window covers.
2. Prefilter. Every window has an anchor, the smallest hash of the ``GRAM``-word runs inside it: equal
   windows have equal anchors, and neighbouring windows mostly share theirs. Each task adds the anchors of its
   documents to a count-min sketch; the sketches are merged slice by slice. An anchor's estimate is never
   below the number of documents that have it, so neither below that of any window it stands for. The sketch grows
   with the text, so that it always has 4 to 16 counters per anchor. Up to ``MOST_CELLS`` it is sent to the
   tasks as bits; a larger one stays a table of its repeated counters, with which the anchors (one row for each
   document and anchor, about one for 22 words) are semi-joined, row by row of the sketch.
3. Second pass. Only windows estimated to occur in two documents or more are grouped, exactly, by 128 bits
   of two independent hashes; the smallest doc_id of a window is aggregated before the shuffle and
   joined back, where Spark splits skewed keys. Nothing repeated is lost; a window estimated too high is a
   group of one.
4. The windows that an earlier document has become spans of words, which are taken out of the texts.

A null text has no words; it, empty texts and texts below ``window`` words lose nothing. A null doc_id
counts as larger than all others. Rows that repeat doc_id and text are treated alike and do not remove each
other; rows with one doc_id and different texts are judged apart, and neither removes the other's. An
empty table gives no rows. Only doc_id and text are read; other columns are carried along by ``cut_repeats``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm import kernel
from barwright.llm.carry import packed, sent, unpacked
from barwright.sources.staging import stage

WINDOW = 50
GRAM = 8
#: A sketch has 8 to 16 counters per anchor expected, in two rows. It is sent to the tasks if 4 per anchor are no more
#: than this (a bit each), then with no more than this.
MOST_CELLS = 1 << 28
BYTES_PER_ANCHOR = 130
SLICE = 1 << 20
LAST = (1 << 63) - 1


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def windows(words: kernel.Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(first word, anchor) of every window."""
    gram, at = words.grams(min(GRAM, window))
    counts = np.diff(words.first)
    ends = np.repeat(words.first[1:], counts)
    starts = np.arange(len(ends))
    starts = starts[starts + window <= ends]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lowest = _sliding_min(gram, window - min(GRAM, window) + 1)
    where = np.zeros(len(ends), np.int64)
    where[at] = np.arange(len(at))
    return starts, lowest[where[starts]]


def cells(anchors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A counter of each row of the sketch; the second row lies behind the first."""
    shift = np.uint64(64 - bits)
    return (kernel.mix(anchors, 11) >> shift).astype(np.int64), (kernel.mix(anchors, 12) >> shift).astype(np.int64) + (1 << bits)


def _doc_of(words: kernel.Words, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.first, at, "right") - 1


def _sketch_bits(text_bytes: int, most_cells: int) -> tuple[int, bool]:
    """Bits of a row for the anchors to expect in so much text, and whether the sketch is sent to the tasks."""
    anchors = text_bytes // BYTES_PER_ANCHOR
    wanted, is_sent = max(anchors * 16, 1 << 14), 4 * anchors <= most_cells
    if is_sent:
        wanted = min(wanted, most_cells)
    return max(13, (wanted // 2).bit_length() - 1), is_sent


def _pack(at: np.ndarray) -> bytes:
    return zlib.compress(np.diff(at, prepend=0).astype(np.uint32).tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.int64))


def _anchors_of(words: kernel.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, anchor), each pair once."""
    starts, anchors = windows(words, window)
    both = np.stack([_doc_of(words, starts).astype(np.uint64), anchors], axis=1)
    changes = np.ones(len(both), bool)
    changes[1:] = (both[1:] != both[:-1]).any(axis=1)  # most neighbours share their anchor
    both = np.unique(both[changes], axis=0)
    return both[:, 0].astype(np.int64), both[:, 1]


def _count_cells(batches: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The sketch of a task: for each slice of counters those that its cells (each once a document) hit once, or more."""
    once, twice = np.empty(0, np.int64), np.empty(0, np.int64)
    held: list[np.ndarray] = []

    def fold() -> tuple[np.ndarray, np.ndarray]:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        more = np.union1d(twice, np.concatenate([np.intersect1d(once, found, assume_unique=True), found[n > 1]]))
        return np.union1d(once, found), more

    for found in batches:
        held.append(found)
        if sum(map(len, held)) > max(1 << 18, len(once)):  # so that what is there is sorted a few times only
            once, twice = fold()
            held = []
    if held:
        once, twice = fold()
    once = np.setdiff1d(once, twice, assume_unique=True)
    for s in np.unique(np.concatenate([once, twice]) // SLICE):
        own = [x[np.searchsorted(x, s * SLICE) : np.searchsorted(x, (s + 1) * SLICE)] - s * SLICE for x in (once, twice)]
        yield pa.RecordBatch.from_pydict({"slice": [s], "once": [_pack(own[0])], "twice": [_pack(own[1])]})


_PARTS = "slice long, once binary, twice binary"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(slice, counters up to 2) from sketches sorted by slice: one slice is held at a time."""
    last, own = None, np.zeros(SLICE, np.uint8)
    for batch in batches:
        for s, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if s != last and last is not None:
                yield last, own
                own = np.zeros(SLICE, np.uint8)
            last = s
            for raw, n in ((once, 1), (twice, 2)):
                at = _unpack(raw)
                own[at] = np.minimum(own[at] + n, 2)
    if last is not None:
        yield last, own


def sketch(docs: DataFrame, window: int, bits: int) -> np.ndarray:
    """One bit per counter of two rows with 2^bits each: two documents or more. They are what the driver gets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches for part in kernel.slices(batch, "text"))
        return _count_cells(np.concatenate(cells(_anchors_of(kernel.split(p.column("text")), window)[1], bits)) for p in parts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, own in _merged(batches):
            yield pa.RecordBatch.from_pydict({"slice": [s], "bits": [np.packbits(own > 1).tobytes()]})

    parts = docs.select("text").mapInArrow(count, _PARTS)
    n_slices = max(1, (2 << bits) // SLICE)
    merged = parts.repartition(min(n_slices, 64), "slice").sortWithinPartitions("slice").mapInArrow(merge, "slice long, bits binary")
    whole = np.zeros(max(SLICE, 2 << bits) // 8, np.uint8)
    for s, raw in merged.toLocalIterator():
        whole[s * SLICE // 8 : (s + 1) * SLICE // 8] = np.frombuffer(raw, np.uint8)
    return whole


def with_estimated_anchors(docs: DataFrame, window: int, bits: int) -> DataFrame:
    """The rows of ``docs`` (text, ord, tag) that have anchors estimated to be in two documents or more, with those
    anchors, by a sketch that stays in the shared folder."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                doc, anchors = _anchors_of(kernel.split(part.column("text")), window)
                ord, tag = (part.column(name).to_numpy()[doc] for name in ("ord", "tag"))
                yield pa.RecordBatch.from_pydict({"anchor": anchors.view(np.int64), "ord": ord, "tag": tag})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count_cells(np.concatenate([b.column(i).to_numpy() for i in range(2)]) for b in batches)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, own in _merged(batches):
            yield pa.RecordBatch.from_pydict({"cell": np.flatnonzero(own > 1) + s * SLICE})

    def cell(row: int) -> Column:  # an expression, so that no row carries it
        return F.shiftrightunsigned(F.xxhash64("anchor", F.lit(row)), 64 - bits) + (row << bits)

    rows = stage(docs.select("text", "ord", "tag").mapInArrow(emit, "anchor long, ord long, tag long"), "anchors")
    parts = rows.select(cell(0).alias("one"), cell(1).alias("two")).mapInArrow(count, _PARTS)
    repeated = stage(parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(merge, "cell long"), "repeated-cells")
    for row in (0, 1):  # the first semi-join leaves little to the second
        rows = rows.join(sent(repeated), cell(row) == F.col("cell"), "left_semi")
    own = rows.groupBy("ord", "tag").agg(F.collect_set("anchor").alias("repeated"))
    return docs.join(sent(stage(own, "own-anchors"), "repeated"), ["ord", "tag"])


def _candidates(docs: DataFrame, window: int, bits: int | None = None, flags: np.ndarray | None = None) -> DataFrame:
    """h1, h2, ord, tag, at, run for each run of windows whose anchor is estimated to be in two documents or more;
    by the sketch, or by the column ``repeated`` where it was not sent."""
    shared = None if flags is None else docs.sparkSession.sparkContext.broadcast(flags)

    def flagged(at: np.ndarray) -> np.ndarray:
        return (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0

    def kept(part: pa.RecordBatch, words: kernel.Words, starts: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        if shared is not None:
            one, two = cells(anchors, bits)
            keep = flagged(one)
            keep[keep] = flagged(two[keep])
            return keep
        keep, bounds = np.zeros(len(starts), bool), np.searchsorted(starts, words.first)
        for i, own in enumerate(part.column("repeated")):
            here = slice(bounds[i], bounds[i + 1])
            keep[here] = np.isin(anchors[here].view(np.int64), np.asarray(own.values))
        return keep

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text"):
                words = kernel.split(part.column("text"))
                starts, anchors = windows(words, window)
                keep = kept(part, words, starts, anchors)
                if not keep.any():
                    continue
                at = starts[keep]
                doc = _doc_of(words, at)
                first, where = words.grams(window, 0)
                first, second = first[np.searchsorted(where, at)], words.grams(window, 1)[0][np.searchsorted(where, at)]
                # a word said over and over gives one window many times in a row: one row with their number
                fresh = np.ones(len(at), bool)
                fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (doc[1:] != doc[:-1]) | (np.diff(at) != 1)
                run = np.diff(np.append(np.flatnonzero(fresh), len(at)))
                at, doc, first, second = at[fresh], doc[fresh], first[fresh], second[fresh]
                ord, tag = (part.column(name).to_numpy()[doc] for name in ("ord", "tag"))
                yield pa.RecordBatch.from_pydict(
                    {"h1": first.view(np.int64), "h2": second.view(np.int64), "ord": ord, "tag": tag, "at": at - words.first[doc], "run": run}
                )

    return docs.mapInArrow(emit, "h1 long, h2 long, ord long, tag long, at long, run long")


def _spans(removed: DataFrame, window: int) -> DataFrame:
    """ord, tag, spans: first and behind-last word of each passage to remove."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for packed in batch.column(2):
                packed = np.sort(np.asarray(packed.values))
                starts, stops = packed >> 31, (packed >> 31) + (packed & 0x7FFFFFFF) + window - 1
                fresh = np.flatnonzero(starts > np.append(-1, np.maximum.accumulate(stops)[:-1]))
                spans.append(np.stack([starts[fresh], np.maximum.reduceat(stops, fresh)], axis=1).ravel().tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int64()))], ["ord", "tag", "spans"])

    rows = removed.select("ord", "tag", F.shiftleft("at", 31).bitwiseOR(F.col("run")).alias("at"))
    return rows.groupBy("ord", "tag").agg(F.collect_list("at").alias("at")).mapInArrow(merge, "ord long, tag long, spans array<bigint>")


def repeats(docs: DataFrame, window: int = WINDOW, most_cells: int = MOST_CELLS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and columns named unlike ours) with ``copied``, whether another
    document with this text comes first, and ``spans``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.withColumns(
        {"ord": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "tag": F.xxhash64(text)}
    )
    ids = named.select("ord", "tag", F.md5(text.cast("binary")).alias("digest"))
    firsts = ids.groupBy("digest").agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    firsts = stage(firsts.filter("last > first").select("digest", "first"), "copied")
    copies = stage(ids.join(sent(firsts), "digest").filter("ord > first").select("ord", "tag").distinct().withColumn("copied", F.lit(True)), "copies")
    named = named.join(sent(copies), ["ord", "tag"], "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
    originals = named.filter("not copied and text is not null").select("text", "ord", "tag")
    bits, is_sent = _sketch_bits(originals.agg(F.sum(F.octet_length("text"))).first()[0] or 0, most_cells)
    if is_sent:
        found = _candidates(originals, window, bits, sketch(originals, window, bits))
    else:
        found = _candidates(with_estimated_anchors(originals, window, bits), window)
    found = stage(found, "windows")
    firsts = found.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).filter("last > first")
    firsts = stage(firsts.select("h1", "h2", "first"), "firsts")  # written, so that the join below deals both sides and can split them
    removed = found.join(firsts, ["h1", "h2"]).filter("ord > first")
    spans = stage(_spans(removed, window), "spans")
    return named.join(sent(spans, "spans"), ["ord", "tag"], "left")


def _keep(text: str | None, copied: bool, spans: Sequence[int] | None, window: int) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space)."""
    words = (text or "").encode().split()
    n = len(words)
    if copied and n >= window:
        return n, n, b""
    if spans is None:
        return n, 0, b" ".join(words)
    kept, at = [], 0
    for start, stop in zip(spans[::2], spans[1::2], strict=True):
        kept += words[at:start]
        at = stop
    kept += words[at:]
    return n, n - len(kept), b" ".join(kept)


def removal_digest(docs: DataFrame, window: int = WINDOW, most_cells: int = MOST_CELLS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_keep(*row, window) for row in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    found = repeats(docs.select("doc_id", "text"), window, most_cells)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return found.select(F.col("doc_id").cast("long"), "text", "copied", "spans").mapInArrow(digest, schema)


def cut_repeats(docs: DataFrame, window: int = WINDOW, most_cells: int = MOST_CELLS) -> DataFrame:
    """All rows and columns of ``docs``; texts that lose words become their kept words, joined by one space."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, copied: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, copy, own in zip(texts, copied, spans, strict=True):
            _, removed, kept = _keep(text, copy, own, window)
            out.append(kept.decode() if removed else text)
        return pd.Series(out, dtype=object)

    found = repeats(packed(docs), window, most_cells)
    kept = F.when(F.col("copied") | F.col("spans").isNotNull(), cut("text", "copied", "spans")).otherwise(F.col("text"))
    return unpacked(found, docs, text=kept)
