from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from barwright.llm import kernel

FOLD = {i: i + 32 for i in range(65, 91)}


def texts():
    random.seed(1)
    some = ["".join(random.choice("aB \t\n\x0b\xa0é!7") for _ in range(random.choice([0, 1, 3, 50, 400]))) for _ in range(400)]
    return [*some, None, "", "x" * 600_000, " " * 300, "ends here", "Ünï cödé"]


@pytest.mark.parametrize("separators, pattern", [(kernel.SPACE, r"[^\x20\x09-\x0D]+"), (kernel.SYMBOL, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")])
def test_words_equal_the_pattern(separators, pattern):
    words = kernel.split(pa.array(texts()), separators, fold=True)
    expected = [re.findall(pattern, (t or "").translate(FOLD)) for t in texts()]
    assert np.diff(words.first).tolist() == [len(e) for e in expected]
    assert [words.text(i).decode() for i in range(len(words.starts))] == [w for e in expected for w in e]


def test_equal_words_and_grams_have_equal_hashes_only():
    words = kernel.split(pa.array(texts()))
    flat = [words.text(i) for i in range(len(words.starts))]
    assert len(set(zip(flat, words.hash.tolist(), strict=True))) == len(set(flat)) == len(set(words.hash.tolist()))
    for salt in (0, 1):
        grams, at = words.grams(3, salt)
        spelled = [tuple(flat[a : a + 3]) for a in at]
        assert len(set(zip(spelled, grams.tolist(), strict=True))) == len(set(spelled)) == len(set(grams.tolist()))
        doc = np.searchsorted(words.first, at, "right")
        assert (doc == np.searchsorted(words.first, at + 2, "right")).all()


def test_slices_cover_the_batch_in_order():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts(), pa.string())})
    assert [x for part in kernel.slices(batch, "text", 1000) for x in part.column("text").to_pylist()] == texts()
    assert list(kernel.slices(batch.slice(0, 0), "text")) == []
    offset = batch.slice(7, 50)  # a column that starts inside its buffers
    words = kernel.split(offset.column("text"))
    assert np.diff(words.first).tolist() == [len((t or "").encode().split()) for t in texts()[7:57]]
