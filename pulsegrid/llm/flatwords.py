"""Batches of texts as flat arrays: words, lines and their bounds, without a Python loop per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def ragged(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... counts[0] - 1, 0, 1, ... for every count."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The bytes of large strings, one after another, without a copy."""
    if not len(texts):
        return np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[edges[0] : edges[-1]]


@dataclass
class Words:
    """The words of some texts: codes are equal exactly where words are; text k has bounds[k:k+2]."""

    values: pa.Array
    codes: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def joined(self, keep: np.ndarray) -> pa.Array:
        """The kept words of each text with one blank between them."""
        before = np.concatenate([[0], np.cumsum(keep)])[self.bounds]
        values = self.values.filter(pa.array(keep))
        lists = pa.LargeListArray.from_arrays(pa.array(before, pa.int64()), values)
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def words_of(texts: pa.Array) -> Words:
    """Words are what stands between blanks and \\t to \\r; a null text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    values = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    # Space at an end of a text leaves an empty piece there.
    real = pc.greater(pc.binary_length(values), 0)
    values = values.filter(real)
    bounds = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[bounds]
    coded = values.dictionary_encode()
    return Words(values, coded.indices.to_numpy().astype(np.int64), bounds)
