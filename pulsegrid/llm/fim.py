"""Fill-in-the-middle examples, cut with an indexable skip list.

A text is cut into prefix, middle and suffix at two ranks of its units (code points, words or
lines). The units stand in a skip list: the bottom lane's nodes hold a few hundred bytes of
text each, and a node rises to the lane above with chance 1/4. Every link carries two widths,
the units and the code points it leads over. A search starts in the top lane, follows links
while the accumulated units do not pass the wanted rank, and goes down a lane where the next
link would; in the last node it counts units one by one. The accumulated code points are then
where to cut, exactly.

One hash of the id draws the cuts and the form: ``psm`` writes prefix, suffix, middle, ``spm``
suffix, prefix, middle, each behind its mark; ``plain`` leaves the text. A mark is never read
wrongly back: no end of a mark is the beginning of one, so text next to a mark cannot form
another, and texts that hold a mark stay plain.

The work is a map over whole texts: no shuffle, and memory for one batch of texts. Defined
cases: a null text counts as empty; empty texts are plain; a null id draws from the seed
alone; repeated rows give equal rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, slices

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
TRANSFORMED, SWAPPED = 90, 20  # of 100 texts, and of 100 transformed ones
NODE_BYTES = 256
SLICE_BYTES = 16_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)

EXAMPLES = "id long, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_starts(raw: np.ndarray, unit: str) -> np.ndarray:
    """Which bytes of UTF-8 begin a unit; the first byte always does."""
    if unit == "point":
        begins = (raw & 0xC0) != 0x80
    elif unit == "word":
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        begins = ~space
        begins[1:] &= space[:-1]
        first = np.flatnonzero(begins)[:1]
        begins[first] = False  # blanks before the first word belong to it
    elif unit == "line":
        begins = np.zeros(len(raw), bool)
        begins[1:] = raw[:-1] == 10
    else:
        raise ValueError(f"unit must be point, word or line, not {unit!r}")
    begins[:1] = True
    return begins


def rises(count: int) -> np.ndarray:
    """How many lanes each node rises: a lane more with chance 1/4, always the same for a place."""
    mixed = np.arange(1, count + 1, dtype=np.uint64) * ODD
    mixed ^= mixed >> np.uint64(32)
    height = np.zeros(count, np.int64)
    for lane in range(1, 32):
        tall = (mixed & np.uint64(4**lane - 1)) == 0
        if not tall.any():
            break
        height[tall] = lane
    height[:1] = height.max(initial=0)  # all lanes begin with the first node
    return height


class SkipList:
    """The units of a text, found by rank in logarithmic time."""

    def __init__(self, text: str, unit: str = "point", node_bytes: int = NODE_BYTES):
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        self.begins = unit_starts(raw, unit)
        self.points = (raw & 0xC0) != 0x80
        self.bytes = len(raw)
        nodes = np.arange(0, len(raw), node_bytes)
        if len(nodes):
            units = np.add.reduceat(self.begins, nodes, dtype=np.int64)
            points = np.add.reduceat(self.points, nodes, dtype=np.int64)
        else:
            units = points = np.zeros(0, np.int64)
        self.node_bytes = node_bytes
        self.units, self.code_points = int(units.sum()), int(points.sum())
        #: From the bottom: units and code points that each link leads over, and the node below.
        self.lanes = [(units, points, nodes)]
        height = rises(len(nodes))
        for lane in range(1, int(height.max(initial=0)) + 1):
            down = np.flatnonzero(height >= lane)
            units, points = np.add.reduceat(units, down), np.add.reduceat(points, down)
            self.lanes.append((units, points, down))
            height = height[down]

    def point(self, rank: int) -> int:
        """The number of code points before the unit of this rank; all of them at the end."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        if rank == self.units:
            return self.code_points
        units = points = at = 0
        for widths, lengths, down in reversed(self.lanes):
            while units + widths[at] <= rank:
                units += int(widths[at])
                points += int(lengths[at])
                at += 1
            at = int(down[at])
        node = slice(at, at + self.node_bytes)
        place = int(np.flatnonzero(self.begins[node])[rank - units])
        return points + int(np.count_nonzero(self.points[node][:place]))


def draws(key: int | None, seed: object = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def example(
    text: str | None, key: int | None, unit: str = "point", seed: object = SEED,
    transformed: int = TRANSFORMED, swapped: int = SWAPPED,
) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the text in that form."""
    text = text or ""
    units = SkipList(text, unit)
    one, two, three, four = draws(key, seed)
    if not text or three % 100 >= transformed or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return units.units, "plain", None, None, text
    low, high = sorted((one % (units.units + 1), two % (units.units + 1)))
    a, b = units.point(low), units.point(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if four % 100 < swapped:
        return units.units, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return units.units, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "point", seed: object = SEED,
    transformed: int = TRANSFORMED, swapped: int = SWAPPED,
) -> DataFrame:
    """``id, n`` (units), ``form, prefix_chars, middle_chars, output`` per row."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["id", *EXAMPLES.replace("id long, ", "").split(", ")]
        names = [n.split()[0] for n in names]
        for batch in batches:
            for part in slices(batch, "t", SLICE_BYTES):
                ids, texts = part.column("id").to_pylist(), part.column("t")
                rows = [example(t.as_py(), k, unit, seed, transformed, swapped) for k, t in zip(ids, texts)]
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names)

    texts = df.select(named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("t"))
    return texts.mapInArrow(rewrite, EXAMPLES)


def restored(output: Column, form: Column) -> Column:
    """The text from which an example was made."""
    parts = F.split(output, "<[PSM]>", 4)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
