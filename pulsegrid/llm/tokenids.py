"""Token ids in binary files: one zstandard frame per document, one dictionary for all.

A file holds the frames one after another, then an index (document id, end of its frame,
number of ids, as 64-bit little-endian integers), then a footer with the number of
documents and the hash of the dictionary. A reader needs the footer, the index and one
frame to get at a short document. The dictionary is trained on serialized ids of a bounded
sample of ``SAMPLE`` documents and stored once beside the files under its hash; a reader
refuses a file of another dictionary.

Documents are dealt into ranges of their id, so each task writes one file of ascending ids,
under a name of its own; the list of files is a table that Spark commits. The ids before a
document follow from the files' totals and the index.

Defined cases: a null text is empty and has the end id alone; a null document id sorts
first; rows that repeat an id stay, ordered by their text.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import hash_share, named, shared_file, slices, stored
from pulsegrid.llm.tokens import SLICE_BYTES, encoder, tokenizer_path
from pulsegrid.session import scratch_dir

END_ID = 2
SAMPLE = 1_000
DICTIONARY_BYTES = 65_536
LEVEL = 3
MAGIC = b"IDS1"
FOOTER = "<q32s4s"
NO_ID = -(2**63)


def trained(samples: list[bytes]) -> bytes:
    """A dictionary trained on the samples, or none if they are too few."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known)


def unpacker(dictionary: bytes) -> zstandard.ZstdDecompressor:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=known)


def serialized(ids: np.ndarray) -> bytes:
    return np.append(ids, END_ID).astype("<u4").tobytes()


class Writer:
    def __init__(self, stream, dictionary: bytes):
        self.stream, self.pack, self.at = stream, packer(dictionary), 0
        self.hash, self.index = hashlib.sha256(dictionary).digest(), []

    def add(self, key: int | None, raw: bytes) -> None:
        frame = self.pack.compress(raw)
        self.stream.write(frame)
        self.at += len(frame)
        self.index.append((NO_ID if key is None else key, self.at, len(raw) // 4))

    def close(self) -> None:
        self.stream.write(np.array(self.index, "<i8").reshape(-1, 3).tobytes())
        self.stream.write(struct.pack(FOOTER, len(self.index), self.hash, MAGIC))
        self.stream.close()


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, source, dictionary: bytes):
        self.source, size = source, source.size()
        tail = struct.calcsize(FOOTER)
        count, digest, magic = struct.unpack(FOOTER, source.read_at(tail, size - tail))
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError("not a file of token ids with this dictionary")
        raw = source.read_at(24 * count, size - tail - 24 * count)
        self.index = np.frombuffer(raw, "<i8").reshape(-1, 3)
        self.unpack = unpacker(dictionary)

    def document(self, k: int) -> np.ndarray:
        begin = int(self.index[k - 1, 1]) if k else 0
        frame = self.source.read_at(int(self.index[k, 1]) - begin, begin)
        return np.frombuffer(self.unpack.decompress(frame), "<u4")


def _write(folder: str, tokenizer: str, dictionary: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, first = f"{folder}/{uuid.uuid4().hex}.ids", None, None
        for batch in batches:
            for part in slices(batch, "t", SLICE_BYTES):
                keys, texts = part.column("id").to_pylist(), part.column("t").to_pylist()
                rows, ends = encoder(tokenizer).encode(texts)
                for k, key in enumerate(keys):
                    if out is None:
                        store, place = shared_file(path)
                        store.create_dir(place.rpartition("/")[0], recursive=True)
                        out, first = Writer(store.open_output_stream(place), dictionary), key
                    out.add(key, serialized(rows[ends[k] : ends[k + 1], 0]))
        if out is not None:
            total = sum(n for _, _, n in out.index)
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([first], pa.int64()), pa.array([total], pa.int64())],
                ["path", "first", "ids"],
            )

    return write


def fit_dictionary(texts: DataFrame, tokenizer: str, sample: int = SAMPLE) -> bytes:
    """Trained on about ``sample`` documents picked by a hash of their id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ends = encoder(tokenizer).encode(batch.column("t").to_pylist())
            raw = [serialized(rows[a:b, 0])[: 4 * 4096] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(raw, pa.binary())], ["id", "raw"])

    chosen = hash_share(texts, F.col("id"), sample)
    rows = chosen.mapInArrow(encode, "id long, raw binary").toPandas()
    return trained([bytes(x) for x in rows.sort_values(["id", "raw"])["raw"]])


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, bytes]:
    """The table of files (path, first id, ids in it) and the dictionary."""
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    rows = df.select(named(id_col).cast("long").alias("id"), text.alias("t"))
    dictionary = fit_dictionary(rows, tokenizer)
    store, place = shared_file(f"{folder}/{hashlib.sha256(dictionary).hexdigest()}.dictionary")
    store.create_dir(place.rpartition("/")[0], recursive=True)
    with store.open_output_stream(place) as out:
        out.write(dictionary)
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "t")
    shape = "path string, first long, ids long"
    return stored(ordered.mapInArrow(_write(folder, tokenizer, dictionary), shape), "files"), dictionary


def read_token_files(files: DataFrame, dictionary: bytes) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    # One row per file: the list of files is short, whatever the table holds.
    before = Window.orderBy(F.col("first").asc_nulls_first(), "path").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = files.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["before"]):
                store, place = shared_file(path)
                with store.open_input_file(place) as source:
                    file = Reader(source, dictionary)
                    counts = file.index[:, 2]
                    keys = pd.array(file.index[:, 0], "Int64")
                    keys[file.index[:, 0] == NO_ID] = pd.NA
                    crc = [zlib.crc32(file.document(k).tobytes()) for k in range(len(counts))]
                    starts = start + np.cumsum(counts) - counts
                    yield pd.DataFrame({"doc_id": keys, "start": starts, "n_tokens": counts,
                                        "ids_crc32": np.array(crc, np.int64)})

    shape = "doc_id long, start long, n_tokens long, ids_crc32 long"
    paths = placed.select("path", "before").repartition(max(1, files.count()), "path")
    return paths.mapInPandas(read, shape)


def round_trip(df: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write all documents to new files in the shared folder and read them back."""
    folder = scratch_dir(df.sparkSession, "token-ids")
    files, dictionary = write_token_files(df, folder, tokenizer or tokenizer_path("byte_bpe_50k.json"))
    return read_token_files(files, dictionary)
