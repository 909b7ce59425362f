"""Review text as column expressions; no Python code runs per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. (?d): "." stops only at \n. (?U): \s covers Unicode white space,
# to which the four separators \x1c-\x1f are added.
TAG_PATTERN = r"(?d)<.*?>"
NON_LETTER_PATTERN = r"(?U)[^a-zA-Z\s\x1c-\x1f]"
TOKEN_PATTERN = r"\b\w\w+\b"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which may use it many times."""
    return F.transform(F.array(value), body)[0]


def strip_tags(text: Column) -> Column:
    """Delete tags; nothing is put in their place, so words around one join up."""
    return F.regexp_replace(text, TAG_PATTERN, "")


def clean_text(text: Column) -> Column:
    """Lowercase, delete tags, delete all but a-z and white space."""
    return F.regexp_replace(strip_tags(F.lower(text)), NON_LETTER_PATTERN, "")


def tokens(text: Column) -> Column:
    """Words of at least two word characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def ngrams(words: Column, sizes: tuple[int, ...] = (1, 2)) -> Column:
    """All n-grams of the wanted sizes, shorter ones first, in text order."""

    def grams(w: Column, n: int) -> Column:
        joined = w
        for shift in range(1, n):
            # The shorter array is padded with NULL, and NULL makes the n-gram NULL.
            later = F.slice(w, F.lit(shift + 1), F.greatest(F.size(w) - shift, F.lit(0)))
            joined = F.zip_with(joined, later, lambda a, b: F.concat(a, F.lit(" "), b))
        return joined if n == 1 else F.filter(joined, lambda g: g.isNotNull())

    return let(words, lambda w: F.concat(*[grams(w, n) for n in sizes]))
