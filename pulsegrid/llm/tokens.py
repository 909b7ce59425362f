"""Token ids of whole texts through a cache of the pieces between blanks.

Most words of a corpus repeat. The tokenizers here never join characters across a blank,
so a text's ids are the ids of its pieces, one after another. Each distinct piece of a
batch goes through the library once; frequent ones stay cached in the worker process.
Words of Latin letters are one unit to the tokenizers, so they go to the model without the
search for units; the encoder tries this on all those letters first. A text in which a blank touches other white space is given to the library as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pulsegrid.llm.common import per_process

CACHED = 400_000
SLICE_BYTES = 6_000_000
JOINED = 2_000
MARK = "\x00"
#: All that Python's \\s matches, for Arrow, whose own \\s knows ASCII only.
SPACE = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
UNSAFE = f" {SPACE}|{SPACE} "
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
#: A word, a stop, and the same once more on the next line.
PARTS = re.compile(f"({LETTERS})([.,]?)(?:\n({LETTERS})([.,]?))?")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """Encodes batches of texts; ``spans`` adds the character span of each token."""

    def __init__(self, path: str, spans: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.spans = spans
        self.width = 3 if spans else 1
        self.cache: dict[str, bytes] = {}
        before = repr(self.lib.pre_tokenizer)
        if self.lib.normalizer is None and before.startswith("ByteLevel(add_prefix_space=False"):
            self.mode = "leading"  # a blank belongs to the piece behind it
            self.starts = np.zeros(self.lib.get_vocab_size() + 1, bool)
            self.starts[[i for t, i in self.lib.get_vocab().items() if t.startswith("Ġ")]] = True
        elif "Removed" in before and not spans:
            self.mode = "between"  # blanks are dropped
            self.mark = self._whole(MARK)[:, 0].tolist()
        else:
            self.mode = "whole"
        plain = self.mode != "whole" and not spans
        self.stops = {c: self._whole(c).tobytes() for c in ".,"} if plain else {}
        self.heads: dict[str, bytes] = {}  # words without a blank before them
        self.feed = self._whole("\n").tobytes()
        self.direct = plain and self._letters_are_units()
        #: Whether a line feed does what a blank does.
        self.feeds = self.mode == "between" and bool((self._whole("a\nb") == self._whole("a b")).all())

    def _rows(self, encoding) -> np.ndarray:
        ids = np.array(encoding.ids, "<u4").reshape(-1, 1)
        if not self.spans:
            return ids
        return np.hstack([ids, np.array(encoding.offsets, "<u4").reshape(-1, 2)])

    def _whole(self, text: str) -> np.ndarray:
        return self._rows(self.lib.encode(text, add_special_tokens=False))

    def _letters_are_units(self) -> bool:
        """Whether words of Latin letters get the same ids with and without the search for units."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.bare = Tokenizer(self.lib.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        # No letter holds the byte of the mark.
        self.bar = self.bytes.pre_tokenize_str(MARK)[0][0]
        self.bar_id = self.bare.encode(self.bar).ids
        if len(self.bar_id) != 1 or not all(t.special for t in self.lib.get_added_tokens_decoder().values()):
            return False
        letters = [chr(c) for c in range(256) if re.fullmatch(LETTERS, chr(c))]
        words = [*letters, "".join(letters), "the", "The", "THE", "Été"]
        for lead in (True, False):
            blank = " " if lead and self.mode == "leading" else ""
            if self._letters(words, lead) != [self._whole(blank + w).tobytes() for w in words]:
                return False
        ends = [self._whole(x).tobytes() for x in ("ÿ", "a")]
        return self.mode != "leading" or self._whole("ÿ.\na").tobytes() == self.stops["."].join(
            [ends[0], self.feed + ends[1]]
        )

    def _letters(self, words: list[str], lead: bool) -> list[bytes]:
        """Rows of words of Latin letters, with ``lead`` as they are behind a blank."""
        text = " ".join(words)
        if self.lib.normalizer is not None:
            text = self.lib.normalizer.normalize_str(text)
        # The bytes as the model knows them; a blank is one of them.
        text = self.bytes.pre_tokenize_str(text)[0][0]
        blank = "Ġ" if lead and self.mode == "leading" else ""
        text = blank + text.replace("Ġ", f" {self.bar} {blank}")
        found = self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids
        rows = np.array(found, "<u4").reshape(-1, 1)
        cuts = np.flatnonzero(rows[:, 0] == self.bar_id[0])
        if len(cuts) == len(words) - 1:
            return self._cut(rows, np.concatenate([[0], cuts + 1]), np.append(cuts, len(rows)))
        blank = " " if lead and self.mode == "leading" else ""
        return [self._whole(blank + w).tobytes() for w in words]

    def _learn(self, words: Iterable[str], known: dict[str, bytes], lead: bool) -> dict[str, bytes]:
        """Rows of words of Latin letters that are not known yet; they become known while there is room."""
        wanted, fresh = list(dict.fromkeys(w for w in words if w not in known)), {}
        for at in range(0, len(wanted), JOINED):
            chunk = wanted[at : at + JOINED]
            fresh.update(zip(chunk, self._letters(chunk, lead)))
        if len(self.cache) + len(self.heads) < CACHED:
            known.update(fresh)
        return fresh

    def _parted(self, pieces: list[str], lead: bool) -> list[bytes | None]:
        """Rows of the pieces that are words of Latin letters, with stops, on one line or two."""
        if not self.direct:
            return [None] * len(pieces)
        parts = [m and m.groups() for m in map(PARTS.fullmatch, pieces)]
        known = self.cache if lead else self.heads
        fresh = self._learn((p[0] for p in parts if p), known, lead)
        # A line's first word has no blank before it.
        behind = self._learn((p[2] for p in parts if p and p[2]), self.heads, False)
        none, out = {"": b"", None: b"", **self.stops}, []
        for p in parts:
            if p is None:
                out.append(None)
                continue
            word, stop, next_word, next_stop = p
            rows = (fresh[word] if word in fresh else known[word]) + none[stop]
            if next_word:
                head = behind[next_word] if next_word in behind else self.heads[next_word]
                rows += self.feed + head + none[next_stop]
            out.append(rows)
        return out

    def _cut(self, rows: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw, size = rows.tobytes(), 4 * self.width
        return [raw[a:b] for a, b in zip((begins * size).tolist(), (ends * size).tolist())]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Rows of each piece from one call over all of them; spans count from the piece."""
        if self.mode == "leading":
            rows = self._whole(" " + " ".join(pieces))
            cuts = np.flatnonzero(self.starts[rows[:, 0]])
            if len(cuts) == len(pieces):
                if self.spans:
                    lengths = np.array([len(p) + 1 for p in pieces])
                    base = np.cumsum(lengths) - lengths
                    per = np.diff(np.append(cuts, len(rows)))
                    rows[:, 1:] -= np.repeat(base, per).astype("<u4")[:, None]
                return self._cut(rows, cuts, np.append(cuts[1:], len(rows)))
        elif self.mode == "between" and len(self.mark) == 1:
            rows = self._whole(f" {MARK} ".join(pieces))
            cuts = np.flatnonzero(rows[:, 0] == self.mark[0])
            if len(cuts) == len(pieces) - 1:
                begins = np.concatenate([[0], cuts + 1])
                return self._cut(rows, begins, np.append(cuts, len(rows)))
        lead = " " if self.mode == "leading" else ""
        return [self._whole(lead + p).tobytes() for p in pieces]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Rows of each piece.

        ASCII letters and a stop or comma behind them never share a token. Other letters can
        become letter and mark when normalised, and a mark shares a token with the stop.
        """
        cache, stops = self.cache, self.stops
        found = list(map(cache.get, pieces))
        missing = [k for k, x in enumerate(found) if x is None]
        parted = self._parted([pieces[k] for k in missing], True)
        for k, x in zip(missing, parted):
            found[k] = x
        missing = [k for k, x in zip(missing, parted) if x is None]
        if not missing:
            return found
        cores = [pieces[k] for k in missing]
        if stops:
            cores = [
                p[:-1] if p[-1:] in stops and p.isascii() and p[:-1].isalpha() else p for p in cores
            ]
        wanted = list(dict.fromkeys(p for p in cores if p not in cache))
        fresh = {}
        for at in range(0, len(wanted), JOINED):
            chunk = wanted[at : at + JOINED]
            fresh.update(zip(chunk, self._joined(chunk)))
        for k, core in zip(missing, cores):
            piece = pieces[k]
            rows = fresh[core] if core in fresh else cache[core]
            found[k] = rows if core is piece or core == piece else rows + stops[piece[-1]]
        if len(cache) + len(self.heads) < CACHED:
            cache.update(fresh)
        return found

    def _firsts(self, pieces: list[str]) -> list[bytes]:
        """Rows of pieces without a blank before them."""
        parted = self._parted(pieces, False)
        return [self._whole(p).tobytes() if x is None else x for p, x in zip(pieces, parted)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All rows (id, and with spans start and end) and where each text's rows begin and end."""
        if not texts:
            return np.zeros((0, self.width), "<u4"), np.zeros(1, np.int64)
        column = pa.array(texts, pa.large_string())
        if self.mode == "leading":
            unsafe = pc.indices_nonzero(pc.match_substring_regex(column, UNSAFE)).to_pylist()
        else:
            unsafe = range(len(texts)) if self.mode == "whole" else []
        whole = {k: self._whole(texts[k]) for k in unsafe}
        if whole:
            column = pa.array(["" if k in whole else t for k, t in enumerate(texts)], pa.large_string())
        if self.feeds:
            column = pc.replace_substring(column, "\n", " ")
        lists = pc.split_pattern(column, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        table = self._pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        if self.mode == "leading":
            # The first piece of a text has no blank before it.
            firsts = bounds[:-1]
            at[firsts] = len(table) + np.arange(len(texts))
            heads = lists.values.take(pa.array(firsts)).to_pylist()
            heads = self._firsts(heads)
            table += [whole[k].tobytes() if k in whole else h for k, h in enumerate(heads)]
        elif whole:
            at[bounds[:-1]] = len(table) + np.arange(len(texts))
            table += [whole[k].tobytes() for k in range(len(texts))]
        rows = np.frombuffer(b"".join(table), "<u4").reshape(-1, self.width)
        lengths = np.fromiter(map(len, table), np.int64, len(table)) // (4 * self.width)
        begins = np.cumsum(lengths) - lengths
        per_piece = lengths[at]
        ends = np.cumsum(per_piece)
        total = int(ends[-1]) if len(ends) else 0
        shift = begins[at] - (ends - per_piece)
        out = rows[np.repeat(shift, per_piece) + np.arange(total)]
        edges = np.concatenate([[0], ends])[bounds]
        if self.spans and self.mode == "leading":
            # A piece begins at the blank before it; the first one at its first character.
            size = pc.utf8_length(lists.values).to_numpy().astype(np.int64) + 1
            begin = np.cumsum(size) - size
            begin -= np.repeat(begin[bounds[:-1]], np.diff(bounds))
            begin -= 1
            begin[bounds[:-1]] = 0
            out = out.copy()
            out[:, 1:] += np.repeat(begin, per_piece).astype("<u4")[:, None]
        return out, edges


def encoder(path: str, spans: bool = False) -> PieceEncoder:
    name = f"encoder_{spans}_" + re.sub(r"\W", "_", path)
    return per_process(name, lambda: PieceEncoder(path, spans))
