"""Quality rules by sequence labelling: which lines of a page are content.

A linear-chain conditional random field labels the lines of a text as content or boilerplate
by what they are made of (shares of character classes, word lengths, repetition) and by their
neighbours; Viterbi decoding gives the most likely labels of the whole text. The share of its
characters that stand in content lines decides whether a text is kept. Counts that fixed rules
use (words, symbols, repeated lines and word windows) come with it.

The field is fitted on documents with a quality label outside the held-out fold, at most about
``PER_CLASS`` of each class and ``CHUNKS`` chunks of ``CHUNK`` lines of each, all picked by
hashes; executors make the features and only those come to the driver. To begin with, lines
have the label of their document; as that is the same on all of them it says nothing about
turns, so the first round looks at each line alone. Later rounds learn turns as well, from the
labels that the last field decodes, unless these would turn most of a document against its label.

Scoring is a map over whole texts without a shuffle. Defined cases: null and empty texts have
no words and counts of 0, and share 1; without labels of both classes every line is content;
a null id stays null, and rows that repeat an id are each scored; lines without words are
labelled but weigh nothing; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import BUCKETS, named, slices
from pulsegrid.llm.crf import ChainField, fit_chain
from pulsegrid.llm.flatwords import Words, text_bytes, words_of
from pulsegrid.llm.runs import stretches
from pulsegrid.llm.shingles import ODD, mixed
from pulsegrid.llm.toxicity import held_out

PER_CLASS = 2_000
CHUNK, CHUNKS = 32, 4
ROUNDS = 3
LEAST_CONTENT = 0.5
WINDOW = 5
SLICE_BYTES = 4_000_000
BLOCK_LINES, BLOCK_BYTES = 1 << 16, 1 << 21

# The symbols that the rules count.
SYMBOLS = b"#*$%&|<>"

# Classes of bytes; the last two are a character's first and its later bytes beyond ASCII.
LOWER, UPPER, DIGIT, SPACE, STOP, CALL, SYMBOL, OTHER, FIRST, LATER = range(10)
KIND = np.full(256, OTHER, np.uint8)
KIND[97:123], KIND[65:91], KIND[48:58] = LOWER, UPPER, DIGIT
KIND[[32, 9, 10, 11, 12, 13]] = SPACE
KIND[list(b".,;:?")], KIND[33], KIND[list(SYMBOLS)] = STOP, CALL, SYMBOL
KIND[128:192], KIND[192:] = LATER, FIRST


@dataclass
class Lines:
    """The lines of some texts; text k has lines bounds[k] to bounds[k + 1]."""

    raw: np.ndarray
    edges: np.ndarray
    bounds: np.ndarray
    n_words: np.ndarray
    characters: np.ndarray
    again: np.ndarray
    repeated: np.ndarray
    counts: dict[str, np.ndarray]

    def features(self, first: int, stop: int) -> np.ndarray:
        """What lines first to stop - 1 are made of."""
        made, kinds = bytes_by_kind(self.raw, self.edges[first : stop + 1])
        size = np.diff(self.edges[first : stop + 1])
        last = np.full(stop - first, OTHER)
        last[size > 0] = kinds[np.cumsum(size)[size > 0] - 1]
        total = made.sum(axis=1) + 1.0
        n_words = self.n_words[first:stop]
        n = n_words + 1.0
        return np.column_stack([
            made[:, :SYMBOL + 1] / total[:, None], made[:, OTHER] / total, made[:, FIRST] / total,
            made[:, UPPER] / (made[:, UPPER] + made[:, LOWER] + 1), made[:, SYMBOL] / n, made[:, CALL] / n,
            made[:, STOP] / n, np.log1p(n_words), self.characters[first:stop] / n, self.again[first:stop],
            self.repeated[first:stop] / n, (last == STOP) | (last == CALL), last == SYMBOL, n_words == 0,
            (n_words > 0) & (n_words < 4),
        ])

    def blocks(self) -> Iterator[tuple[int, int]]:
        """All lines in stretches of bounded rows and bytes, one line at least."""
        first, count = 0, len(self.n_words)
        while first < count:
            fits = int(np.searchsorted(self.edges, self.edges[first] + BLOCK_BYTES, side="right")) - 1
            stop = min(max(fits, first + 1), first + BLOCK_LINES, count)
            yield first, stop
            first = stop

    def lean(self, field: ChainField) -> np.ndarray:
        return np.concatenate([field.lean(self.features(a, b)) for a, b in self.blocks()] or [np.zeros(0)])


def bytes_by_kind(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes of each kind each line holds, and the kinds of all bytes."""
    count = len(edges) - 1
    kinds = KIND[raw[edges[0] : edges[-1]]]
    line = np.repeat(np.arange(count) * 10, np.diff(edges))
    return np.bincount(line + kinds, minlength=10 * count).reshape(count, 10), kinds


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Which words stand in a window of words that its text holds twice or more."""
    codes, sizes, n = words.codes, words.sizes, len(words.codes)
    covered = np.zeros(n + 1, np.int64)
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    left = np.repeat(words.bounds[1:], sizes) - np.arange(n)
    at = np.flatnonzero(left >= window)
    if not len(at):
        return np.zeros(n, bool)
    value = mixed(text[at].astype(np.uint64) + ODD)
    for k in range(window):
        value = mixed(value * ODD + codes[at + k].astype(np.uint64))
    order = np.argsort(value, kind="stable")
    one, other = order[1:], order[:-1]
    alike = value[one] == value[other]
    one, other = one[alike], other[alike]
    same = text[at[one]] == text[at[other]]
    for k in range(window):
        same &= codes[at[one] + k] == codes[at[other] + k]
    twice = np.zeros(len(at), bool)
    if same.all():
        twice[one] = True
        twice[other] = True
    else:  # different windows with one hash: compare them in full
        places = defaultdict(list)
        for k, begin in enumerate(at.tolist()):
            places[text[begin], *codes[begin : begin + window].tolist()].append(k)
        twice[[k for found in places.values() if len(found) > 1 for k in found]] = True
    begin = at[twice]
    np.add.at(covered, begin, 1)
    np.add.at(covered, begin + window, -1)
    return np.cumsum(covered[:-1]) > 0


def lines_of(texts: pa.Array) -> Lines:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.split_pattern(texts, "\n")
    values = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    per = np.diff(bounds)
    count = len(values)
    text_of = np.repeat(np.arange(len(per)), per)
    edges = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy())])
    none = np.zeros(count, np.int64)
    lines = Lines(text_bytes(values), edges, bounds, none, none.copy(), none > 0, none, {})

    symbols = np.zeros(len(per), np.int64)
    n_words = np.zeros(count, np.int64)
    for first, stop in lines.blocks():
        made, kinds = bytes_by_kind(lines.raw, edges[first : stop + 1])
        line = np.repeat(np.arange(stop - first), np.diff(edges[first : stop + 1]))
        # A word begins at a character that is no space behind a space or the line's beginning.
        begins = kinds != SPACE
        begins[1:] &= (kinds[:-1] == SPACE) | (line[1:] != line[:-1])
        n_words[first:stop] = np.bincount(line[begins], minlength=stop - first)
        lines.characters[first:stop] = made.sum(axis=1) - made[:, SPACE] - made[:, LATER]
        np.add.at(symbols, text_of[first:stop], made[:, SYMBOL])

    codes = values.dictionary_encode().indices.to_numpy().astype(np.int64)
    place = np.unique(text_of * (codes.max(initial=0) + 1) + codes, return_index=True)[1]
    again = n_words > 0
    again[place] = False

    words = words_of(texts)
    # Both count words line by line in the same order, as a line break is a space between words.
    repeats = np.concatenate([[0], np.cumsum(repeated_words(words))])
    begins = np.concatenate([[0], np.cumsum(n_words)])
    lines.n_words, lines.again, lines.repeated = n_words, again, np.diff(repeats[begins])
    lines.counts = {
        "n_words": words.sizes,
        "word_chars": np.bincount(text_of, lines.characters, len(per)).astype(np.int64),
        "n_symbols": symbols,
        "n_dup_lines": np.bincount(text_of[again], minlength=len(per)),
        "n_repeat_words": np.bincount(text_of, lines.repeated, len(per)).astype(np.int64),
    }
    return lines


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of up to CHUNKS chunks of a document's lines, spread over it by a hash."""
    import xxhash

    for batch in batches:
        for part in slices(batch, "t", SLICE_BYTES):
            lines = lines_of(part.column("t"))
            ids, labels, places, rows = [], [], [], []
            for k, (key, y) in enumerate(zip(part.column("key").to_pylist(), part.column("y").to_pylist())):
                first, stop = lines.bounds[k], lines.bounds[k + 1]
                begins = list(range(first, stop, CHUNK))
                begins.sort(key=lambda at: xxhash.xxh3_64_intdigest(f"{key}:{at - first}"))
                for at in sorted(begins[:CHUNKS]):
                    own = lines.features(at, min(at + CHUNK, stop))
                    ids.append(key)
                    labels.append(y)
                    places.append(at - first)
                    rows.append(np.hstack([own, lines.characters[at : at + len(own), None]]).tobytes())
            columns = [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()),
                       pa.array(places, pa.int64()), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "y", "line", "rows"])


def fit_field(rows: list[np.ndarray], y: np.ndarray, weights: list[np.ndarray], rounds: int = ROUNDS) -> ChainField:
    """Rows of line features and their weights per sequence, and the label of its document."""
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.vstack(rows)
    labels = np.repeat(y, np.diff(bounds)).astype(int)
    field = fit_chain(flat, labels, np.arange(len(flat) + 1))
    for _ in range(rounds - 1):
        lean = field.lean(flat)
        for k, label in enumerate(y):
            own = slice(bounds[k], bounds[k + 1])
            found = field.decode(lean[own])
            agrees = weights[k][found == label].sum() >= 0.5 * weights[k].sum()
            labels[own] = found if agrees else label
        field = fit_chain(flat, labels, bounds, start=field)
    return field


def fit_lines(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", per_class: int = PER_CLASS,
) -> ChainField | None:
    """The field, or None without labels of both classes."""
    known = labels.select(named(id_col).cast("long").alias("key"), named(label_col).cast("int").alias("y"))
    known = known.filter(~held_out(F.col("key")) & F.col("y").isin(0, 1))
    known = known.groupBy("key").agg(F.max("y").alias("y"))
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, per_class / sizes.get(1, 1)))
    share = share.otherwise(min(1.0, per_class / sizes.get(0, 1)))
    draw = F.pmod(F.xxhash64("key", F.lit("lines")), F.lit(BUCKETS)) / BUCKETS
    chosen = known.filter(draw < share)
    texts = df.select(named(id_col).cast("long").alias("key"), named(text_col).cast("string").alias("t"))
    # The chosen labels are bounded by per_class, whatever the tables hold.
    sample = texts.join(F.broadcast(chosen), "key")
    found = sample.mapInArrow(_chunks, "key long, y int, line long, rows binary").toArrow()
    found = found.sort_by([("key", "ascending"), ("line", "ascending"), ("rows", "ascending")])
    y = found.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    width = lines_of(pa.array([""])).features(0, 1).shape[1] + 1
    rows = [np.frombuffer(r.as_py()).reshape(-1, width) for r in found.column("rows")]
    return fit_field([r[:, :-1] for r in rows], y, [r[:, -1] for r in rows])


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MARKED = (
    "id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_lines long, content_share double, "
    "boilerplate array<struct<first: long, stop: long>>"
)


def mark_lines(
    df: DataFrame, field: ChainField | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts per row, the share of content, and the runs of boilerplate lines, numbered from 0."""
    span = pa.struct([("first", pa.int64()), ("stop", pa.int64())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", SLICE_BYTES):
                lines = lines_of(part.column("t"))
                lean = None if field is None else lines.lean(field)
                shares, per, spans = [], [0], []
                for first, stop in zip(lines.bounds[:-1].tolist(), lines.bounds[1:].tolist()):
                    weight = lines.characters[first:stop]
                    whole = weight.sum()
                    content = np.ones(stop - first) if lean is None else field.decode(lean[first:stop])
                    shares.append(float((weight * content).sum() / whole) if whole else 1.0)
                    begins, ends = stretches(content == 0)
                    spans += zip(begins.tolist(), ends.tolist())
                    per.append(len(spans))
                fields = [pa.array([s[k] for s in spans], pa.int64()) for k in (0, 1)]
                boilerplate = pa.ListArray.from_arrays(
                    pa.array(per, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(span))
                )
                columns = [part.column("id"), *[pa.array(lines.counts[c], pa.int64()) for c in COUNTS],
                           pa.array(np.diff(lines.bounds)), pa.array(shares), boilerplate]
                names = ["id", *COUNTS, "n_lines", "content_share", "boilerplate"]
                yield pa.RecordBatch.from_arrays(columns, names)

    texts = df.select(named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("t"))
    return texts.mapInArrow(mark, MARKED)
