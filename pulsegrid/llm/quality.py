"""Quality classification by co-training on two views of a page.

The text view sees what the words are made of: shares of character classes, word lengths,
repetition. The metadata view sees the page around them: language and source as hashed
indicators, recorded length, number and lengths of lines. One classifier per view starts
from the labelled texts. In each round both score all other pages, and a classifier hands its
most confident predictions, a few per class, to the other one, which learns from them at a
lower weight. At the end each view is calibrated on labelled rows that took no part, and a third
classifier combines the calibrated views.

The fit uses at most about ``PER_CLASS`` labelled rows of each class, picked by a hash. All
other rows are unlabelled to it: executors make their features once, score them each round
and send at most ``PER_ROUND`` rows of each class and view. No text comes to the driver. Scoring is a map over whole texts. Defined cases: null and empty texts have features of
length zero; null metadata is a value of its own; missing metadata columns count as null;
without labels of both classes every score is the share of good labels, or 1 without any.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.llm.common import named, stored
from pulsegrid.llm.logistic import Logistic, fit_logistic
from pulsegrid.llm.toxicity import PER_CLASS, labelled_sample

ROUNDS = 5
PER_ROUND = 200
CONFIDENT = 0.95
PSEUDO_WEIGHT = 0.3
HASHED = 16
PART = 1_000_000
VIEWS = ("text", "meta")

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LOWER = np.zeros(256, bool)
LOWER[97:123] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
STOP = np.zeros(256, bool)
STOP[[33, 44, 46, 58, 59, 63]] = True
HIGH = np.arange(256) >= 128
SIGN = ~(UPPER | LOWER | DIGIT | SPACE | STOP | HIGH)
CLASSES = np.stack([UPPER, LOWER, DIGIT, SPACE, STOP, HIGH, SIGN]).astype(float)


def text_view(text: str | None) -> list[float]:
    """Shares of character classes, word shape, and how much repeats."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    total = len(raw) + 1.0
    shares = (CLASSES @ counts / total).tolist()
    signs = counts * SIGN
    words = raw.split()
    n = len(words) + 1.0
    distinct = len(set(words))
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    ends = counts[[33, 46, 63]].sum()
    return shares + [
        float(signs.max()) / total, counts[33] / total, counts[124] / total, ends / n,
        float(lengths.mean()), float(lengths.std()), float((lengths <= 3).mean()),
        float((lengths >= 12).mean()), distinct / n, np.log1p(distinct), np.log1p(n),
    ]


def hashed(value: object) -> list[float]:
    row = [0.0] * HASHED
    row[zlib.crc32(repr(value).encode("utf-8", "replace")) % HASHED] = 1.0
    return row


def longest_line(text: str) -> int:
    """Characters of the longest line, with the lines of one part of the text in memory at a time."""
    longest = run = 0
    for at in range(0, len(text), PART):
        first, *others = map(len, text[at : at + PART].split("\n"))
        run += first
        if others:
            longest, run = max(longest, run, *others[:-1]), others[-1]
    return max(longest, run)


def metadata_view(text: str | None, meta: Sequence[object], size: float) -> list[float]:
    """Hashed indicators of the metadata, the recorded length, and the layout."""
    text = text or ""
    breaks = text.count("\n")
    size = 0.0 if size is None or not np.isfinite(size) else max(float(size), 0.0)
    layout = [np.log1p(size), np.log1p(breaks), np.log1p(longest_line(text)), size / (breaks + 1.0) / 1000.0]
    return [x for value in meta for x in hashed(value)] + layout


@dataclass
class QualityModel:
    text: Logistic | None
    meta: Logistic | None
    text_scale: Logistic | None
    meta_scale: Logistic | None
    combined: Logistic | None
    prior: float

    def score(self, texts: np.ndarray, metas: np.ndarray) -> np.ndarray:
        """Columns: combined score, calibrated text view, calibrated metadata view."""
        if self.combined is None:
            return np.full((len(texts), 3), self.prior)
        views = self.views(texts, metas)
        return np.column_stack([self.combined.probability(logit(views)), views])

    def views(self, texts: np.ndarray, metas: np.ndarray) -> np.ndarray:
        own = self.text_scale.probability(self.text.margin(texts)[:, None])
        other = self.meta_scale.probability(self.meta.margin(metas)[:, None])
        return np.column_stack([own, other])


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


#: From both classifiers and the keys that each was taught, the rows to be taught next:
#: the pupil, the label, the key, and the row as the pupil sees it.
Offers = Callable[[dict[str, Logistic], dict[str, set]], list[tuple[str, int, int, np.ndarray]]]


def co_train(
    texts: np.ndarray, metas: np.ndarray, y: np.ndarray, offers: Offers, rounds: int = ROUNDS
) -> QualityModel:
    """Fit both views, let them teach each other, calibrate and combine."""
    prior = float(y.mean()) if len(y) else 1.0
    if len(set(y.tolist())) < 2:
        return QualityModel(None, None, None, None, None, prior)
    held = np.zeros(len(y), bool)
    for value in (0, 1):
        at = np.flatnonzero(y == value)
        held[at[::3]] = len(at) >= 3
    own = {"text": texts[~held], "meta": metas[~held]}
    taught: dict[str, list[tuple]] = {"text": [], "meta": []}  # label, key and row of what each learnt
    base = y[~held].astype(float)
    models: dict[str, Logistic] = {}
    for turn in range(rounds + 1):
        for view in VIEWS:
            rows = np.vstack([own[view], *(row for _, _, row in taught[view])])
            labels = np.append(base, [float(label) for label, _, _ in taught[view]])
            weight = np.append(np.ones(len(base)), np.full(len(taught[view]), PSEUDO_WEIGHT))
            models[view] = fit_logistic(rows, labels, weight=weight)
        if turn == rounds:
            break
        found = offers(models, {view: {key for _, key, _ in taught[view]} for view in VIEWS})
        if not found:
            break
        for pupil, label, key, row in found:
            taught[pupil].append((label, key, row))
    rest = held if held.any() and len(set(y[held].tolist())) == 2 else np.ones(len(y), bool)
    target = y[rest].astype(float)
    scales = [
        fit_logistic(models[v].margin(rows[rest])[:, None], target, ridge=0.1)
        for v, rows in (("text", texts), ("meta", metas))
    ]
    model = QualityModel(models["text"], models["meta"], *scales, None, prior)
    model.combined = fit_logistic(logit(model.views(texts[rest], metas[rest])), target, ridge=0.1)
    return model


def _present(df: DataFrame, names: Sequence[str], size: str) -> tuple[list[Column], Column]:
    known = set(df.columns)
    columns = [named(c).cast("string") if c in known else F.lit(None).cast("string") for c in names]
    return columns, (named(size) if size in known else F.lit(None)).cast("double")


def _rows(rows: pd.DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    width = (len(text_view("")), len(metadata_view("", [None] * len(names), 0.0)))
    texts, metas = np.zeros((len(rows), width[0])), np.zeros((len(rows), width[1]))
    values = rows.astype(object).where(rows.notna(), None)
    for k, (text, size, *meta) in enumerate(values[["t", "size", *names]].itertuples(index=False)):
        texts[k] = text_view(text)
        metas[k] = metadata_view(text, meta, len(text or "") if size is None else size)
    return texts, metas


def fit_quality(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", meta_cols: Sequence[str] = ("lang", "source"),
    size_col: str = "n_chars", per_class: int = PER_CLASS,
) -> QualityModel:
    meta, size = _present(df, meta_cols, size_col)
    names = [f"m{k}" for k in range(len(meta))]
    flat = df.select(
        named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("t"),
        size.alias("size"), *[m.alias(n) for m, n in zip(meta, names)],
    )
    wide = labelled_sample(flat, labels.select(named(id_col).alias("id"), named(label_col).alias(label_col)), label_col, "id",
                           ["t", "size", *names], per_class)
    keys, texts, metas, y = _collected(wide, names)
    # The sample is bounded by ``per_class``; every other row is unlabelled, also those without an id.
    sample = df.sparkSession.createDataFrame([(int(k),) for k in sorted(set(keys))], "key long")
    free = flat.withColumnRenamed("id", "key").join(F.broadcast(sample), "key", "left_anti")
    pool: list[DataFrame] = []

    def offers(models: dict[str, Logistic], taught: dict[str, set]) -> list[tuple]:
        if not pool:
            made = _features(free.withColumn("y", F.lit(-1)), names)
            pool.append(stored(made.select(F.xxhash64("key", "text", "meta").alias("key"), *VIEWS), "views"))
        return _most_confident(pool[0], models, taught)

    return co_train(texts, metas, y, offers)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), float).reshape(len(column), -1)


def _most_confident(pool: DataFrame, models: dict[str, Logistic], taught: dict[str, set]) -> list[tuple]:
    """The PER_ROUND surest rows of each class that each classifier has for the other one.

    A task keeps as many of its own; ties go by the key, a hash of the row.
    """
    known = {view: np.array(sorted(keys), np.int64) for view, keys in taught.items()}

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"pupil": [], "label": [], "sure": [], "key": [], "row": []})
        for batch in batches:
            if not len(batch):
                continue
            keys, parts = batch["key"].to_numpy(), []
            for view, pupil in (VIEWS, VIEWS[::-1]):
                p = models[view].probability(_matrix(batch[view]))
                for label, sure in ((1, p), (0, 1 - p)):
                    at = np.flatnonzero((sure >= CONFIDENT) & ~np.isin(keys, known[pupil]))
                    parts.append(pd.DataFrame({"pupil": pupil, "label": label, "sure": sure[at], "key": keys[at],
                                               "row": batch[pupil].to_numpy()[at]}))
            whole = pd.concat([*([best] if len(best) else []), *parts])
            whole = whole.drop_duplicates(["pupil", "label", "key"]).sort_values(["sure", "key"], ascending=[False, True])
            best = whole.groupby(["pupil", "label"]).head(PER_ROUND)
        if len(best):
            yield best

    found = pool.mapInPandas(pick, "pupil string, label int, sure double, key long, row binary")
    # Equal rows have one key, in whatever tasks they are.
    found = found.dropDuplicates(["pupil", "label", "key"])
    order = Window.partitionBy("pupil", "label").orderBy(F.col("sure").desc(), "key")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PER_ROUND)
    chosen = found.collect()  # at most PER_ROUND rows of two classes and two views
    chosen.sort(key=lambda r: (r.pupil, -r.label, r["rank"]))
    return [(r.pupil, r.label, r.key, np.frombuffer(r.row, float)) for r in chosen]


def _features(rows: DataFrame, names: list[str]) -> DataFrame:
    """``key, y, text, meta``: both views of every row, made by executors."""

    def views(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, metas = _rows(batch, names)
            yield pd.DataFrame({"key": batch["key"], "y": batch["y"],
                                "text": [t.tobytes() for t in texts], "meta": [m.tobytes() for m in metas]})

    found = rows.select("key", "y", "t", "size", *names)
    return found.mapInPandas(views, "key long, y int, text binary, meta binary")


def _collected(rows: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, features of both views and labels of a bounded sample, by key."""
    found = _features(rows, names).toArrow()
    found = found.sort_by([(c, "ascending") for c in ("key", "text", "meta")])
    width = (len(text_view("")), len(metadata_view("", [None] * len(names), 0.0)))
    texts, metas = (
        np.frombuffer(b"".join(found.column(c).to_pylist()), float).reshape(-1, w)
        for c, w in zip(VIEWS, width)
    )
    return found.column("key").to_numpy(), texts, metas, found.column("y").to_numpy()


SCORES = T.StructType([T.StructField(n, T.DoubleType()) for n in ("score", "text_score", "meta_score")])


def quality(
    model: QualityModel, df: DataFrame, text_col: str = "text",
    meta_cols: Sequence[str] = ("lang", "source"), size_col: str = "n_chars",
) -> Column:
    """A struct of the combined score and the calibrated score of each view."""
    meta, size = _present(df, meta_cols, size_col)
    names = [f"m{k}" for k in range(len(meta))]

    @F.pandas_udf(SCORES)
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame(dict(zip(["t", "size", *names], batch)))
            yield pd.DataFrame(model.score(*_rows(rows, names)), columns=SCORES.names)

    return score(named(text_col).cast("string"), size, *meta)
