"""Pseudo-random columns derived from a row key.

``rand()`` and ``randn()`` depend on how rows fall into partitions, so a lost
executor or another cluster size would change the result. A hash of the key and
a seed gives each row the same draw wherever and however often it is computed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13  # 52 bits, which a double holds exactly


MISSING = "\\N"


def hash_hex(seed: object, *parts: str | Column) -> Column:
    """md5 of ``seed:part:part...`` as 32 hex digits; a missing part counts as one of its own."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    known = [F.coalesce(c.cast("string"), F.lit(MISSING)) for c in columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *known))


def below(hash_column: Column, rate: float) -> Column:
    """True for a share ``rate`` of hashes, compared as text without a conversion."""
    return F.substring(hash_column, 1, HEX_DIGITS) < F.lit(f"{int(rate * 16**HEX_DIGITS):013x}")


def least_digits(p: float) -> str | None:
    """The first digits of the hashes whose uniform draw is ``p`` or more begin here; None if none is."""
    least = math.ceil(p * 16**HEX_DIGITS)
    return f"{least:0{HEX_DIGITS}x}" if least < 16**HEX_DIGITS else None


def hash_uniform(seed: object, *parts: str | Column) -> Column:
    """Uniform draw in [0, 1)."""
    digits = F.substring(hash_hex(seed, *parts), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(16**HEX_DIGITS))


def hash_normal(seed: object, *parts: str | Column) -> Column:
    """Standard normal draw, Box-Muller over two uniform draws."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - hash_uniform(f"{seed}:r", *parts)))
    return radius * F.cos(F.lit(2 * math.pi) * hash_uniform(f"{seed}:a", *parts))
