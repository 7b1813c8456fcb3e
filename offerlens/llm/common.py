"""Helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name(column: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + column.replace("`", "``") + "`")


def text_key(column: str | Column = "text") -> Column:
    """16-byte identity of a text: equal texts have equal keys; NULL stays NULL."""
    return F.unhex(F.md5(name(column) if isinstance(column, str) else column))


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names, so no other column can clash."""
    return docs.select(name(id_column).cast("long").alias("doc_id"), name(text_column).cast("string").alias("text"))


def without(docs: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``docs`` without columns that have the name of an output column, in any case."""
    taken = {c.lower() for c in columns}
    return docs.select(*[name(c) for c in docs.columns if c.lower() not in taken])


def fresh(docs: DataFrame, stem: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def checksum(column: Column, remainder_of: int) -> Column:
    """crc32 of a number written as text, modulo ``remainder_of``; NULL for NULL."""
    return F.crc32(column.cast("string")) % remainder_of


def slices(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``chars`` characters, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def ranges(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes add up to about ``limit``, one row at least."""
    start, total, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if i >= start:
        yield start, i + 1
