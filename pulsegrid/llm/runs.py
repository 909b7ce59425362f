"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q (words q apart are equal) that is at
least ``copies`` periods and ``shortest`` words long and that no neighbour extends. Periods
go by dyadic scales: those from B to 2B - 1 are found with blocks of B words.

1. A text is cut into blocks of B words. A run with such a period covers whole blocks, and
   each of them occurs again q words later, in the 2B words that follow it.
2. The sums of squared differences of a block and all places of its window come from an
   integer number-theoretic transform, many blocks at once. Places with sum zero give
   distances d. Blocks with a word that does not return within 2B words cannot occur again
   and are left out, and so are blocks well inside a run of a smaller period.
3. Neighbouring blocks with the same distance form a chain. A chain long enough for a run is
   compared word by word, which rules out sums that are zero only modulo the prime, and
   extends over less than one block on each side. What lies in a run of a smaller period has
   that period and is dropped, so every run comes with its smallest period.

The work is a map over texts: no shuffle. Time is O(n log n) per scale and there are
log(n) scales; memory is that of a few megabytes of text, or of one text if it is longer.

Defined cases: a null or empty text has no words, no runs and the empty text as its
collapsed form; a null id stays null; repeated rows each give a row; other columns of the
table are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.llm.common import named, slices
from pulsegrid.llm.flatwords import Words, ragged, words_of
from pulsegrid.llm.ntt import squared_differences

SHORTEST, COPIES = 6, 4
SLICE_BYTES = 4_000_000
SLAB = 1 << 19  # values in the windows transformed at once

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def returns(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How far each word is from its next occurrence in its text; very far if there is none."""
    order = np.argsort(codes, kind="stable")
    after = np.full(len(codes), np.iinfo(np.int64).max)
    same = codes[order[1:]] == codes[order[:-1]]
    after[order[:-1][same]] = order[1:][same]
    return np.where(after < ends, after - np.arange(len(codes)), np.iinfo(np.int64).max)


def block_hits(codes: np.ndarray, ends: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and distances, from ``size`` on, at which they seem to occur again."""
    found, far = [], []
    inside, ahead = np.arange(size), np.arange(size, 3 * size)
    step = max(1, SLAB // (2 * size))
    for at in range(0, len(blocks), step):
        own = blocks[at : at + step]
        places = own[:, None] + ahead
        within = places < ends[own][:, None]
        # Codes from 1 on; what lies beyond the text is 0 and equals no word.
        windows = np.where(within, codes[np.minimum(places, len(codes) - 1)] + 1, 0)
        row, t = np.nonzero(squared_differences(codes[own[:, None] + inside] + 1, windows) == 0)
        found.append(own[row])
        far.append(t + size)
    blocks = np.concatenate(found) if found else np.zeros(0, np.int64)
    distance = np.concatenate(far) if far else np.zeros(0, np.int64)
    fits = blocks + distance + size <= ends[blocks]
    return blocks[fits], distance[fits]


def chains(blocks: np.ndarray, distance: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First block, number of blocks and distance of neighbouring blocks with the same distance."""
    order = np.lexsort((blocks, distance))
    blocks, distance = blocks[order], distance[order]
    new = np.ones(len(blocks), bool)
    new[1:] = (distance[1:] != distance[:-1]) | (blocks[1:] != blocks[:-1] + size)
    first = np.flatnonzero(new)
    return blocks[first], np.diff(np.append(first, len(blocks))), distance[first]


def stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true values begin and end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def find_runs(
    codes: np.ndarray, bounds: np.ndarray, shortest: int = SHORTEST, copies: int = COPIES
) -> np.ndarray:
    """Rows of start, length, period over the flat array, by start, then period."""
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)
    begins = np.repeat(bounds[:-1], sizes)
    gaps = returns(codes, ends)
    reach = np.zeros(len(codes), np.int64)  # the farthest end of a run that begins here or before
    found: list[tuple[int, int, int]] = []
    size = 1
    while len(sizes) and copies * size <= sizes.max():
        counts = np.where(sizes >= max(copies * size, shortest), sizes // size - 1, 0)
        blocks = np.repeat(bounds[:-1], counts) + size * ragged(counts)
        lonely = np.concatenate([[0], np.cumsum(gaps >= 2 * size)])
        blocks = blocks[lonely[blocks + size] == lonely[blocks]]
        blocks = blocks[reach[blocks] < np.minimum(blocks + 3 * size, ends[blocks])] if found else blocks
        new = set()
        firsts, lengths, distances = chains(*block_hits(codes, ends, blocks, size), size)
        least = np.maximum((copies - 1) * distances, shortest - distances)
        likely = lengths * size + 2 * (size - 1) >= least
        likely &= reach[firsts] < firsts + lengths * size + distances
        for k in np.flatnonzero(likely):
            first, d = int(firsts[k]), int(distances[k])
            low = max(int(begins[first]), first - size + 1)
            high = min(int(ends[first]) - d, first + int(lengths[k]) * size + size - 1)
            for a, b in zip(*stretches(codes[low:high] == codes[low + d : high + d])):
                if b - a >= least[k] and reach[low + a] < low + b + d:
                    new.add((low + int(a), int(b - a) + d, d))
        if new:
            rows = np.array(sorted(new))
            np.maximum.at(reach, rows[:, 0], rows[:, 0] + rows[:, 1])
            reach = np.maximum.accumulate(reach)
            found += new
        size *= 2
    rows = np.array(found, np.int64).reshape(-1, 3)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """All words but those behind the first period of a run."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def runs_of(words: Words, shortest: int, copies: int) -> tuple[pa.Array, pa.Array]:
    """Per text its runs and the text without what they repeat."""
    runs = find_runs(words.codes, words.bounds, shortest, copies)
    text = np.searchsorted(words.bounds, runs[:, 0], side="right") - 1
    per = np.bincount(text, minlength=len(words.sizes))
    start = runs[:, 0] - words.bounds[text]
    fields = [pa.array(x, pa.int64()) for x in (start, runs[:, 1], runs[:, 2])]
    offsets = pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(RUN)))
    return lists, words.joined(kept_words(len(words.codes), runs))


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, copies: int = COPIES
) -> DataFrame:
    """``id, n_words, runs, collapsed`` per row; runs go by start, then period, counted in words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", SLICE_BYTES):
                words = words_of(part.column("t"))
                runs, collapsed = runs_of(words, shortest, copies)
                columns = [part.column("id"), pa.array(words.sizes), runs, collapsed.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    texts = df.select(named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("t"))
    return texts.mapInArrow(find, RUNS)
