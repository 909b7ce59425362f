"""Toxicity by compression distance to two zstandard dictionaries.

One dictionary is trained on windows of toxic text, one on ordinary text. A window is a
word with the blank before it, lower-cased, written ``ECHO`` times, as zstandard leaves
blocks of a few bytes as they are; the repeats cost the same with either dictionary. Windows that toxic and ordinary texts share
tell nothing, so the toxic samples are the windows that toxic training texts hold clearly
more often. A window's gain is its compressed length with the ordinary dictionary less that
with the toxic one: text that the toxic dictionary knows gets shorter with it. The largest
gains of the whole text and their rate are calibrated to a probability on training texts
that no dictionary has seen.

The fit uses at most about ``PER_CLASS`` labelled texts of each class, picked by a hash, in
one task; labels come from that bounded sample only. Scoring is a map over whole texts with a model
of bounded size and needs no shuffle. Gains are computed once per distinct window of a
batch. Null and empty texts have no windows and get the score of no gain; the score is
never null. Without labels of both classes every score is the share of toxic labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import BUCKETS, named
from pulsegrid.llm.logistic import Logistic, fit_logistic

PER_CLASS = 4_000
DICTIONARY_BYTES = 4_096
LEVEL = 9
SEGMENT, OVERLAP = 16, 6  # of the dictionary trainer
RATIO, LEAST_SHARE, LEAST_TEXTS = 8.0, 0.02, 3
SHARED_SHARE = 0.005  # windows in this share of ordinary texts tell nothing
TOP = 8
SLICE = 2_000
LONGEST_WINDOW = 64
ECHO = 4


def held_out(key: Column) -> Column:
    """Rows whose label no fit may see."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def windows(text: str | None) -> list[str]:
    """Words as windows; a word beyond the longest window counts as several."""
    out = []
    for word in (text or "").lower().split():
        if len(word) <= LONGEST_WINDOW:
            out.append(word)
        else:
            out += [word[i : i + LONGEST_WINDOW] for i in range(0, len(word), LONGEST_WINDOW)]
    return out


def beginnings(window: str) -> set[str]:
    return {b for b in (window[:4], window[:6], window) if len(b) >= 4}


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves if they are too few to train on."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=SEGMENT, d=OVERLAP, level=LEVEL)
        return trained.as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=known, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
    )


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    calibration: Logistic | None
    prior: float
    shared: frozenset = frozenset()

    def gains(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        rare = [k for k, w in enumerate(words) if w not in self.shared]
        out[rare] = self._gains([words[k] for k in rare])
        return out

    def _gains(self, words: list[str]) -> np.ndarray:
        ordinary, toxic = compressor(self.ordinary).compress, compressor(self.toxic).compress
        raw = [(" " + w).encode("utf-8", "replace") * ECHO for w in words]
        return np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in raw), float, len(raw))

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), TOP + 3))
        for at in range(0, len(texts), SLICE):
            lists = [windows(t) for t in texts[at : at + SLICE]]
            flat = pa.array([w for x in lists for w in x], pa.large_string()).dictionary_encode()
            gains = self.gains(flat.dictionary.to_pylist())
            each = gains[flat.indices.to_numpy()] if len(flat) else np.zeros(0)
            end = 0
            for k, x in enumerate(lists):
                own, end = each[end : end + len(x)], end + len(x)
                top = np.sort(np.partition(own, -TOP)[-TOP:] if len(own) > TOP else own)[::-1]
                row = out[at + k]
                row[: len(top)] = np.maximum(top, 0)
                strong = (own >= 3).sum()
                row[TOP:] = strong / (len(own) + 20), np.log1p(strong), np.log1p(len(own))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(texts), self.prior)
        return self.calibration.probability(self.features(texts))


def labelled_sample(
    df: DataFrame, labels: DataFrame, label: str, id_col: str, text_cols: list[str], per_class: int
) -> DataFrame:
    """About ``per_class`` labelled rows of each class outside the held-out fold, by a hash."""
    known = labels.select(named(id_col).cast("long").alias("key"), named(label).cast("int").alias("y"))
    known = known.filter(~held_out(F.col("key")) & F.col("y").isin(0, 1))
    known = known.groupBy("key").agg(F.max("y").alias("y"))
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(BUCKETS)) / BUCKETS
    share = F.when(F.col("y") == 1, min(1.0, per_class / sizes.get(1, 1)))
    share = share.otherwise(min(1.0, per_class / sizes.get(0, 1)))
    chosen = known.withColumn("draw", draw).filter(F.col("draw") < share)
    texts = df.select(named(id_col).cast("long").alias("key"), *[named(c) for c in text_cols])
    # The chosen labels are bounded by per_class, whatever the tables hold.
    return texts.join(F.broadcast(chosen.select("key", "y")), "key")


def train(texts: list[str | None], y: np.ndarray) -> ToxicityModel:
    prior = float(y.mean()) if len(y) else 0.0
    if len(set(y.tolist())) < 2:
        return ToxicityModel(b"", b"", None, prior)
    part = np.arange(len(y)) % 2 == 0
    for value in (0, 1):  # both halves need both classes
        at = np.flatnonzero(y == value)
        part[at] = np.arange(len(at)) % 2 == 0
    begun, whole = {0: Counter(), 1: Counter()}, Counter()
    for k in dict.fromkeys({texts[k]: k for k in np.flatnonzero(part)}.values()):
        own = windows(texts[k])
        begun[y[k]].update({b for w in set(own) for b in beginnings(w)})
        if not y[k]:
            whole.update(set(own))
    share = {v: max(1, int((part & (y == v)).sum())) for v in (0, 1)}
    least = max(LEAST_TEXTS, LEAST_SHARE * share[1])
    marks = {
        b
        for b, n in begun[1].items()
        if n >= least and n / share[1] > RATIO * (begun[0][b] + 0.5) / share[0]
    }
    # A text's sample is what it holds of the class: each dictionary gets one per text.
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for k in np.flatnonzero(part):
        own = windows(texts[k])
        if y[k]:
            own = [w for w in own if beginnings(w) & marks] if marks else own
        samples[y[k]].append("".join(" " + w for w in own).encode("utf-8", "replace"))
    toxic, plain = samples[1], samples[0]
    often = max(LEAST_TEXTS, SHARED_SHARE * share[0])
    shared = frozenset(w for w, n in whole.items() if n >= often)
    model = ToxicityModel(dictionary(toxic), dictionary(plain), None, prior, shared)
    rest = np.flatnonzero(~part)
    rows = model.features([texts[k] for k in rest])
    model.calibration = fit_logistic(rows, y[rest].astype(float))
    return model


FIELDS = (
    "toxic binary, ordinary binary, prior double, shared array<string>, "
    "center array<double>, scale array<double>, weights array<double>"
)
FITTED = [field.split()[0] for field in FIELDS.split(", ")]


def fit_toxicity(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = PER_CLASS,
) -> ToxicityModel:
    """The model, trained by one task that sees the sample; texts do not come to the driver."""
    sample = labelled_sample(df, labels, label_col, id_col, [text_col], per_class)
    sample = sample.select("key", named(text_col).alias("t"), "y")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "t"])
        texts = rows["t"].astype(object).where(rows["t"].notna(), None).tolist()
        model = train(texts, rows["y"].to_numpy())
        known = model.calibration
        parts = [None] * 3 if known is None else [x.tolist() for x in (known.center, known.scale, known.weights)]
        return pd.DataFrame([[model.toxic, model.ordinary, model.prior, sorted(model.shared), *parts]], columns=FITTED)

    # The group is the sample itself, whose size per_class bounds.
    row = sample.groupBy(F.lit(1).alias("all")).applyInPandas(fit, FIELDS).first()
    if row is None:
        return ToxicityModel(b"", b"", None, 0.0)
    known = None if row.center is None else Logistic(*map(np.array, (row.center, row.scale, row.weights)))
    return ToxicityModel(bytes(row.toxic), bytes(row.ordinary), known, row.prior, frozenset(row.shared))


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """The probability that a text is toxic."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.astype(object).where(batch.notna(), None).tolist()
            yield pd.Series(model.score(texts), dtype=float)

    return score(text.cast("string"))
