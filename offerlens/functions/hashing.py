"""Draws that depend only on a seed, a purpose and the row key.

A hash gives the same draw whatever the partitioning, the column order or the
number of retries, which a running random generator does not.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(seed: int, purpose: str, key: Iterable[str | Column]) -> Column:
    """Hex MD5 of seed, purpose and row key: a reproducible random order."""
    parts = [F.col(f"`{k}`") if isinstance(k, str) else k for k in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), *[p.cast("string") for p in parts]))


def uniform(seed: int, purpose: str, key: Iterable[str | Column]) -> Column:
    """Uniform draw in [0, 1): the first 52 bits of the digest over 2**52."""
    bits = F.conv(F.substring(key_digest(seed, purpose, key), 1, 13), 16, 10).cast("long")
    return bits.cast("double") / F.lit(float(2**52))
