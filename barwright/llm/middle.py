"""Fill-in-the-middle by displacement scatter.

A text is cut into prefix, middle and suffix between its tokens (runs of letters, or one other character).
The order of the parts and the sentinels between them move every byte by the same distance as the other bytes
of its part. A scan finds the cuts of all texts of a batch; the change of distance at each cut goes into a
difference array, whose running sum is the shift of every byte; one numpy scatter writes the outputs. Restoring
reads the sentinels, builds the opposite shifts and gathers the bytes back.

Null texts count as empty and stay plain, as do texts that contain a sentinel. Cuts and forms are drawn from
sha256 of the seed and doc_id, so reruns agree; a null doc_id counts as an empty string, and rows with the same
doc_id and length are cut alike. Empty parts are allowed. An empty table gives no rows. Columns beside
doc_id and text are not read. What a task holds beside the bytes of its texts is bounded by ``TILE``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.llm import kernel

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_KINDS = np.frombuffer(b"PSM", np.uint8)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Bytes worked on at once.
TILE = 1 << 20


def token_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each byte begins a token of its text."""
    starts = characters(data)
    letter = _LETTER[data]
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    return starts


def characters(data: np.ndarray) -> np.ndarray:
    """Whether each byte begins a character."""
    return (data & 0xC0) != 0x80


def count_before(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set before each of the ascending positions."""
    out, total = np.zeros(len(at), np.int64), 0
    for low in range(0, len(flags) + 1, TILE):
        sums = np.concatenate([[0], np.cumsum(flags[low : low + TILE], dtype=np.int64)])
        a, b = np.searchsorted(at, [low, low + TILE])
        out[a:b] = total + sums[at[a:b] - low]
        total += sums[-1]
    return out


def place_of(flags: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Positions of the set flags with these ascending ranks, from 0."""
    out, total = np.zeros(len(ranks), np.int64), 0
    for low in range(0, len(flags), TILE):
        at = np.flatnonzero(flags[low : low + TILE])
        a, b = np.searchsorted(ranks, [total, total + len(at)])
        out[a:b] = at[ranks[a:b] - total] + low
        total += len(at)
    return out


def shifts(starts: np.ndarray, distance: np.ndarray, size: int) -> Iterator[tuple[slice, np.ndarray]]:
    """For pieces of 0:size, how far each byte moves. Parts begin at the ascending ``starts`` (of several at one
    place the last counts) and move by ``distance``."""
    change = np.diff(distance, prepend=0)
    carried = 0
    for low in range(0, size, TILE):
        high = min(size, low + TILE)
        a, b = np.searchsorted(starts, [low, high])
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[a:b] - low, change[a:b])
        difference[0] += carried
        moved = np.cumsum(difference)
        carried = moved[-1]
        yield slice(low, high), moved


def find_sentinels(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, text) of every sentinel."""
    open_, close = data[:-2] == ord("<"), data[2:] == ord(">")
    at = np.flatnonzero(open_ & close & np.isin(data[1:-1], _KINDS)) if len(data) > 2 else np.empty(0, np.int64)
    text = np.searchsorted(bounds, at, "right") - 1
    whole = at + 3 <= bounds[text + 1]  # not over the end of a text
    return at[whole], text[whole]


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    if bounds[-1] >= 1 << 31:
        raise ValueError("a batch of texts with their sentinels exceeds 2 GB")
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def _bounds(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def rearrange(texts: pa.Array, first: np.ndarray, second: np.ndarray, turn: np.ndarray, form: np.ndarray, plain: int, spm: int) -> dict[str, pa.Array]:
    """The transformed texts of a batch: n, form, prefix_chars, middle_chars, output.

    ``first`` and ``second`` choose the cuts, ``turn`` (of 100) whether a text stays plain, ``form`` (of 100) its form.
    """
    data, bounds = kernel.buffers(texts)
    starts, ends, count = bounds[:-1], bounds[1:], len(texts)
    flags = token_starts(data, bounds)
    before = count_before(flags, bounds)
    n = np.diff(before)
    a, b = first % (n + 1), second % (n + 1)
    cuts = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        cut, inside = ends.copy(), k < n
        cut[inside] = place_of(flags, (before[:-1] + k)[inside])
        cuts.append(cut)
    one, two = cuts
    kept = (ends == starts) | (turn >= 100 - plain)
    kept[find_sentinels(data, bounds)[1]] = True
    suffix_first = ~kept & (form < spm)

    prefix, middle, suffix = one - starts, two - one, ends - two
    out_bounds = _bounds(ends - starts + np.where(kept, 0, 9))
    base = out_bounds[:-1]
    to_prefix = base + np.where(suffix_first, suffix + 6, 3)
    to_suffix = base + np.where(suffix_first, 3, prefix + 6)
    to_middle = base + prefix + suffix + 9
    out = np.empty(out_bounds[-1], np.uint8)
    part_starts = np.stack([starts, one, two], axis=1).ravel()
    distance = np.stack([np.where(kept, base, to_prefix) - starts, np.where(kept, base - starts, to_middle - one), np.where(kept, base - starts, to_suffix - two)], axis=1).ravel()
    for piece, moved in shifts(part_starts, distance, len(data)):
        out[np.arange(piece.start, piece.stop) + moved] = data[piece]
    for sentinel, place in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for i, byte in enumerate(sentinel):
            out[place[~kept] - 3 + i] = byte

    chars = count_before(characters(data), np.stack([starts, one, two], axis=1).ravel()).reshape(count, 3)
    return {
        "n": pa.array(n, pa.int64()),
        "form": pa.array(np.where(kept, "plain", np.where(suffix_first, "spm", "psm")).tolist(), pa.string()),
        "prefix_chars": pa.array(chars[:, 1] - chars[:, 0], pa.int64(), mask=kept),
        "middle_chars": pa.array(chars[:, 2] - chars[:, 1], pa.int64(), mask=kept),
        "output": _strings(out, out_bounds),
    }


def gather_back(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts that outputs of the given forms were made of; a moved text without its three sentinels is an error."""
    data, bounds = kernel.buffers(outputs)
    form = np.array(forms.to_pylist(), object)
    moved = form != "plain"
    at, text = find_sentinels(data, bounds)
    at, text = at[moved[text]], text[moved[text]]
    many = np.bincount(text, minlength=len(form))
    if np.any(many[moved] != 3):
        raise ValueError("an output without exactly three sentinels")
    at = at.reshape(-1, 3)
    starts, ends = bounds[:-1], bounds[1:]
    suffix_first = form[moved] == "spm"
    kinds = data[at + 1].reshape(-1, 3)
    wanted = np.where(suffix_first[:, None], np.frombuffer(b"SPM", np.uint8), np.frombuffer(b"PSM", np.uint8))
    if np.any(kinds != wanted) or np.any(at[:, 0] != starts[moved]):
        raise ValueError("an output whose sentinels are not in the order of its form")
    first = np.stack([at[:, 0] + 3, at[:, 1]])  # the bytes of the part after each sentinel
    second = np.stack([at[:, 1] + 3, at[:, 2]])
    prefix, suffix = np.where(suffix_first, second, first), np.where(suffix_first, first, second)
    middle = np.stack([at[:, 2] + 3, ends[moved]])

    back = _bounds(ends - starts - np.where(moved, 9, 0))
    base = back[:-1][moved]
    to_middle = base + prefix[1] - prefix[0]
    to_suffix = to_middle + middle[1] - middle[0]
    part_starts, distance = np.tile(back[:-1], (3, 1)), np.tile(starts - back[:-1], (3, 1))
    part_starts[1:, moved] = to_middle, to_suffix
    distance[:, moved] = prefix[0] - base, middle[0] - to_middle, suffix[0] - to_suffix
    out = np.empty(back[-1], np.uint8)
    for piece, shift in shifts(part_starts.T.ravel(), distance.T.ravel(), len(out)):
        out[piece] = data[np.arange(piece.start, piece.stop) + shift]
    return _strings(out, back)


def _draws(seed: int) -> list[Column]:
    """Four numbers below 2^32 for a row, from the hex sha256 of seed and doc_id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(key, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars, output of every row.

    ``plain`` percent of the texts stay as they are; of the others ``spm`` percent begin with the suffix.
    """
    rows = docs.select("doc_id", "text", *_draws(seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "text", TILE):
                h = [part.column(f"h{i}").to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4)]
                made = rearrange(part.column("text"), h[0], h[1], h[2] % 100, h[3] % 100, plain, spm)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **made})

    made = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType())]
    made += [T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *made]))


def restore(made: DataFrame) -> DataFrame:
    """The rows of ``made`` with ``restored``, the text that was in ``output`` (null: empty) before its ``form`` moved it."""
    names = [c for c in made.columns if c != "restored"]
    rows = made.select([F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.slices(batch, "output", TILE):
                text = gather_back(part.column("output"), part.column("form"))
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*names, "restored"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("restored", T.StringType())]))
