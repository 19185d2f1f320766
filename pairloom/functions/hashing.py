"""Hashes that depend on values alone, never on how rows are laid out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(seed: int, cols: list[Column], digits: int = 8) -> Column:
    """A non-negative bigint from the first hex digits of an MD5 over seed and columns."""
    joined = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(joined), 1, digits), 16, 10).cast("bigint")


def digest(col: Column) -> Column:
    """A 32-byte stand-in for a long text, for grouping without shuffling the text."""
    return F.unhex(F.sha2(col, 256))
