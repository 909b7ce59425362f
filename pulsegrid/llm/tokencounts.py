"""Token counts of sections from one encoding of the whole document.

Counting sections apart miscounts, as a tokenizer joins characters across their borders.
Here a document is encoded once; each token's character span is joined with the sections'
character intervals. A token that crosses a border belongs to the section that holds its
first character, and counts as crossing there. So the sections' counts add up to the
document's. Sections are lines with their line break; an operator's caller may give others.

Defined cases: a null or empty text has one section without tokens; a null document id is
kept; rows that repeat an id are counted each; a token of several bytes of one character
spans that character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, slices
from pulsegrid.llm.tokens import SLICE_BYTES, encoder

SHAPE = "doc_id long, section int, char_start long, char_end long, n_tokens long, n_crossing long"


def lines(text: str) -> list[int]:
    """Where each line begins: at 0 and behind each line break that has text after it."""
    starts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts


def attribute(begins: np.ndarray, ends: np.ndarray, starts: np.ndarray, size: int) -> tuple:
    """Tokens and crossing tokens per section: the section holds a token's first character."""
    section = np.searchsorted(starts, begins, side="right") - 1
    limits = np.append(starts[1:], max(size, 1))
    crossing = ends > limits[section]
    return (
        np.bincount(section, minlength=len(starts)),
        np.bincount(section[crossing], minlength=len(starts)),
    )


def section_tokens(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections: Callable[[str], list[int]] = lines,
) -> DataFrame:
    """One row per section; ``sections`` gives the ascending starts of a text, the first 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", SLICE_BYTES):
                yield _counted(part, encoder(tokenizer, spans=True), sections)

    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    return df.select(named(id_col).cast("long").alias("id"), text.alias("t")).mapInArrow(count, SHAPE)


def _counted(part: pa.RecordBatch, known, sections) -> pa.RecordBatch:
    keys, texts = part.column("id").to_pylist(), part.column("t").to_pylist()
    rows, at = known.encode(texts)
    spans = rows[:, 1:].astype(np.int64)
    out = {name.split()[0]: [] for name in SHAPE.split(", ")}
    for k, text in enumerate(texts):
        starts = np.array(sections(text), np.int64)
        own = spans[at[k] : at[k + 1]]
        tokens, crossing = attribute(own[:, 0], own[:, 1], starts, len(text))
        out["doc_id"] += [keys[k]] * len(starts)
        out["section"].append(np.arange(len(starts), dtype=np.int32))
        out["char_start"].append(starts)
        out["char_end"].append(np.append(starts[1:], len(text)))
        out["n_tokens"].append(tokens)
        out["n_crossing"].append(crossing)
    columns = [pa.array(out.pop("doc_id"), pa.int64())]
    columns += [pa.array(np.concatenate(x)) for x in out.values()]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *out])
