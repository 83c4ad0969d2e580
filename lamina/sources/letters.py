"""Texts as the titles of a catalogue, letter by letter in Arabic script."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lamina.llm import _common as C

LATIN, ARABIC = "abcdefghijklmnopqrstuvwxyz", "ابتثجحخدذرزسشصضطظعغفقكلمنه"
_TWO = np.array([list(c.encode()) for c in ARABIC], np.uint8)  # each letter has two bytes


def lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """words, runs of a to z, joined by spaces, and title, the same letter by letter in Arabic script, for a lower-cased text, the last column."""
    for batch in C.slices(batches):
        *own, text = batch.columns
        data, ends = C.flat(text)
        at = np.flatnonzero((data >= ord("a")) & (data <= ord("z")))
        begins = np.searchsorted(at, ends)  # letters before each text
        gap = np.append(False, at[1:] - at[:-1] > 1)[: len(at)]
        gap[begins[:-1][begins[:-1] < begins[1:]]] = False  # a text's first word
        spaces = np.append(0, np.cumsum(gap))
        letter, place = data[at], np.arange(len(at)) + spaces[1:]
        words = np.full(len(at) + spaces[-1], ord(" "), np.uint8)
        words[place] = letter
        title, place = np.full(len(at) * 2 + spaces[-1], ord(" "), np.uint8), place + np.arange(len(at))
        for k in (0, 1):
            title[place + k] = _TWO[letter - ord("a"), k]
        valid = pa.array(text.is_valid().to_numpy(zero_copy_only=False)).buffers()[1]
        made = (pa.Array.from_buffers(pa.string(), len(text), [valid, pa.py_buffer((k * begins + spaces[begins]).astype(np.int32)), pa.py_buffer(x)]) for k, x in ((1, words), (2, title)))
        yield pa.RecordBatch.from_arrays([*own, *made], names=[*batch.schema.names[:-1], "words", "title"])
