"""Prefix, positional and length filters of exact set-similarity joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import slices
from offerlens.llm.words import CHARS, U

RARITY_BUCKETS = 1 << 16


def rarity(texts: DataFrame, hashes: Callable[[list[str]], np.ndarray]) -> np.ndarray:
    """Counts of the hashes of all ``texts`` (column text) by their last 16 bits.

    Only these counts reach the driver. They order elements from rare to
    common; elements that share a count are ordered by their hash, so any counts
    give the same join result, and true ones the least work.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY_BUCKETS, np.int64)
        for batch in batches:
            rows = batch.column("text").to_pylist()
            for lo, hi in slices(rows, CHARS):
                total += np.bincount((hashes(rows[lo:hi]) & U(RARITY_BUCKETS - 1)).astype(np.int64), minlength=RARITY_BUCKETS)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(RARITY_BUCKETS, np.int64)
    for row in counts:
        out[row["bucket"]] = row["n"]
    return out


def prefixes(element: np.ndarray, limit: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements of all prefixes, their positions, prefix lengths) of sets given by limits into their elements.

    Two sets whose Jaccard similarity reaches the threshold share an element
    among the first size - ceil(threshold * size) + 1 of both, in any common order.
    """
    size = np.diff(limit)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((element, counts[(element & U(RARITY_BUCKETS - 1)).astype(np.int64)], owner))
    at = np.arange(len(element)) - np.repeat(limit[:-1], size)
    length = (size - np.ceil(threshold * size - 1e-9) + 1).astype(np.int64)
    keep = at < np.repeat(length, size)
    return element[order][keep], at[keep], length


def may_match(threshold: float, a_size: str | Column, b_size: str | Column, a_at: str | Column, b_at: str | Column) -> Column:
    """Whether two sets can reach the threshold whose first shared element has the given positions in their orders.

    The smaller must be large enough, and the shared element and those after
    it must be enough for the common elements that are needed. A later shared
    element may fail this; the pair's first one then decides.
    """
    t = F.lit(threshold)
    a, b, i, j = (F.col(c) if isinstance(c, str) else c for c in (a_size, b_size, a_at, b_at))
    need = F.ceil(t / (t + 1) * (a + b) - 1e-9)
    return (F.least(a, b) >= t * F.greatest(a, b) - 1e-9) & (F.least(a - i, b - j) >= need)
