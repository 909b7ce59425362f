"""Packing of token sequences with a bounded number of open windows.

A task goes through its documents in order. A document's ids fill whole windows first; what
remains is placed where it fits best among at most ``OPEN`` open windows. If it fits in
none, the fullest window is emitted: is its gap at least ``LEAST_CUT`` ids, the remainder is
cut to fill it, else the gap is padding. What a task leaves open goes, with its ids, to a
merge: leftovers of ``MERGED`` tasks each are packed again the same way, level by level,
until one group is left. That last group is cut into powers of two, which need no padding.

Sequences of ``length`` ids are full. One whose ids number a power of two has no padding
either. Every id lies in exactly one piece; offsets in a sequence have no gaps.

Defined cases: a null or empty text is a document of the end id alone; rows that repeat an
id are packed each, a null id stays null; long documents span many sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, slices, stored
from pulsegrid.llm.tokens import encoder, tokenizer_path

LENGTH = 4096
OPEN = 32
LEAST_CUT = 64
MERGED = 64
#: Text encoded at once. What a worker process needs beside its cache grows with it.
SLICE_BYTES = 1_000_000
END_ID = 2
LEVEL_SHIFT = 1 << 56
TASK_SHIFT = 1 << 32

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
SHAPE = PIECE + ", sequence_id long, offset long, ids binary, grp long"
NAMES = [f.split()[0] for f in SHAPE.split(", ")]


class Packer:
    """Open windows of one task. A piece is (doc, start, ids, doc_tokens)."""

    def __init__(self, length: int, open_windows: int, first: int, group: int | None = None):
        self.length, self.most, self.number, self.group = length, open_windows, first, group
        self.windows: list[tuple[int, list]] = []
        self.out: list[tuple] = []

    def add(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.length:
            self._emit([(doc, start, ids[: self.length], total)])
            start, ids = start + self.length, ids[self.length :]
        while len(ids):
            fits = [k for k, (used, _) in enumerate(self.windows) if used + len(ids) <= self.length]
            if fits:
                k = max(fits, key=lambda k: self.windows[k][0])
                self._put(k, (doc, start, ids, total))
                return
            if len(self.windows) < self.most:
                self.windows.append((len(ids), [(doc, start, ids, total)]))
                return
            k = max(range(len(self.windows)), key=lambda k: self.windows[k][0])
            gap = self.length - self.windows[k][0]
            if gap >= LEAST_CUT:
                self._put(k, (doc, start, ids[:gap], total))
                start, ids = start + gap, ids[gap:]
            else:
                self._emit(self.windows.pop(k)[1])

    def _put(self, k: int, piece: tuple) -> None:
        used, pieces = self.windows[k]
        pieces.append(piece)
        used += len(piece[2])
        self.windows[k] = (used, pieces)
        if used == self.length:
            self._emit(self.windows.pop(k)[1])

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.number, offset, None, self.group))
            offset += len(ids)
        self.number += 1

    def leave(self) -> None:
        """Hand on what is open, with its ids, for the merge."""
        for _, pieces in self.windows:
            for doc, start, ids, total in pieces:
                self.out.append((doc, start, len(ids), 0, total, None, 0, ids.tobytes(), self.group))
        self.windows = []

    def finish(self) -> None:
        """Emit what is open in sequences whose sizes are powers of two."""
        rest = [p for _, pieces in self.windows for p in pieces]
        self.windows = []
        left = sum(len(p[2]) for p in rest)
        while left:
            size = min(self.length, 1 << (left.bit_length() - 1))
            taken, need = [], size
            while need:
                doc, start, ids, total = rest.pop(0)
                taken.append((doc, start, ids[:need], total))
                if len(ids) > need:
                    rest.insert(0, (doc, start + need, ids[need:], total))
                need -= len(taken[-1][2])
            self._emit(taken)
            left -= size

    def rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [()] * len(NAMES)
        types = [pa.binary() if n == "ids" else pa.int64() for n in NAMES]
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], NAMES)


def _pack(tokenizer: str, length: int, open_windows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer = Packer(length, open_windows, task * TASK_SHIFT, task)
        for batch in batches:
            for part in slices(batch, "t", SLICE_BYTES):
                rows, ends = encoder(tokenizer).encode(part.column("t").to_pylist())
                for k, doc in enumerate(part.column("id").to_pylist()):
                    ids = np.append(rows[ends[k] : ends[k + 1], 0], END_ID).astype("<u4")
                    packer.add(doc, 0, ids, len(ids))
                yield packer.rows()
        packer.leave()
        yield packer.rows()

    return pack


def _merge(length: int, open_windows: int, level: int, last: bool):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, group = Packer(length, open_windows, 0), None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens", "grp")]
            for doc, start, raw, total, number in zip(*columns):
                if number != group:
                    packer.finish() if last else packer.leave()
                    group, packer.number = number, level * LEVEL_SHIFT + number * TASK_SHIFT
                    packer.group = group
                packer.add(doc, start, np.frombuffer(raw, "<u4"), total)
            yield packer.rows()
        packer.finish() if last else packer.leave()
        made = packer.rows()
        yield made

    return merge


def pack(
    df: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    open_windows: int = OPEN,
    merged: int = MERGED,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    tokenizer = tokenizer or tokenizer_path("word_bpe_49k.json")
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    rows = df.select(named(id_col).cast("long").alias("id"), text.alias("t"))
    mapped = rows.mapInArrow(_pack(tokenizer, length, open_windows), SHAPE)
    now = stored(mapped, "packed")
    done = [now.filter("sequence_id is not null")]
    level = 0
    while True:
        level += 1
        left = now.filter("sequence_id is null").withColumn("grp", F.floor(F.col("grp") / merged))
        groups = left.select("grp").distinct().count()
        if not groups:
            break
        last = groups == 1
        dealt = left.repartition(groups, "grp").sortWithinPartitions("grp", F.col("length").desc(), "doc_id", "start")
        # Groups keep their numbers, whatever number of partitions they are dealt to.
        now = stored(dealt.select(*NAMES).mapInArrow(_merge(length, open_windows, level, last), SHAPE), "merged")
        done.append(now.filter("sequence_id is not null"))
        if last:
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*[c for c in NAMES if c not in ("ids", "grp")])
