"""Passages that occur more than once, by sparse suffixes at minimiser positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import id_and_text, slices, text_key
from offerlens.llm.words import CHARS, U, Words, mix, powers, words
from offerlens.session import stage

LEAST_WORDS = 50
PREFIX = 12  # words of a suffix that choose its place; a window of 50 words has 39 such prefixes
_STEP = U(0xD1342543DE82EF95)


def _run_hashes(w: Words, length: int) -> np.ndarray:
    """64-bit hash of ``length`` words from every word on; meaningless where a text ends before."""
    n = len(w.hashes)
    power = powers(_STEP, n + 1, "words")
    total = np.concatenate((np.zeros(1, U), np.cumsum(w.hashes * power[:n])))
    inverse = powers(U(pow(int(_STEP), -1, 1 << 64)), n + 1, "words-inverse")
    out = np.zeros(n, U)
    if n >= length:
        out[:n - length + 1] = mix((total[length:] - total[:n - length + 1]) * inverse[:n - length + 1] + U(length))
    return out


def selected(w: Words, least: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, minimisers, prefix hashes): each window of ``least`` words inside one text with its minimiser's place.

    The minimiser is the leftmost prefix with the smallest hash in the window,
    so equal windows choose equal places, whatever surrounds them.
    """
    value = _run_hashes(w, prefix)
    n, span = len(value), least - prefix + 1
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), value
    best, reach = np.arange(n), 1
    while reach < span:
        shift = min(reach, span - reach)
        left, right = best[:len(best) - shift], best[shift:]
        best = np.where(value[left] <= value[right], left, right)
        reach += shift
    window = np.flatnonzero(np.repeat(w.first[1:], np.diff(w.first)) - np.arange(n) >= least)
    return window, best[window], value


def _suffixes(least: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices(texts, CHARS):
                w = words(texts[lo:hi])
                _, at, value = selected(w, least, prefix)
                at = np.unique(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[at].view(np.int64)), batch.column("t").take(pa.array(w.doc[at] + lo)),
                     pa.array((at - w.first[w.doc[at]]).astype(np.int32))], ["prefix", "t", "at"])

    return run


def _extended(least: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            places = batch.column("places")
            for lo, hi in slices(texts, CHARS):
                w = words(texts[lo:hi])
                window, at, value = selected(w, least, prefix)
                part = places.slice(lo, hi - lo)
                wanted = np.zeros(len(w.hashes), bool)
                wanted[np.repeat(w.first[:-1], pc.list_value_length(part).to_numpy()) + part.flatten().to_numpy()] = True
                keep = wanted[at]
                window, at = window[keep], at[keep]
                doc = w.doc[window]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_run_hashes(w, least)[window].view(np.int64)), pa.array(value[at].view(np.int64)),
                     batch.column("t").take(pa.array(doc + lo)), pa.array((window - w.first[doc]).astype(np.int32))],
                    ["content", "prefix", "t", "start"])

    return run


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS, prefix: int = PREFIX) -> DataFrame:
    """(t, start, words, later): spans of a text's words that occur elsewhere too, ``least_words`` long or more.

    Suffixes are kept only at minimiser positions. Those whose first words no
    other suffix shares have no repeated neighbour and go. The rest are
    extended to both sides: every window of ``least_words`` words that hangs
    on the suffix is compared as a whole. (Comparing only neighbours in
    sorted order misses a passage whose neighbour agrees further to the right
    but less to the left, so equal windows meet by their hash instead.)
    Overlapping windows join to a span. later is false for spans at the first
    occurrence of their words, in the order of text key and place, and true
    for all others. Texts are compared by their lower-case words; equal texts
    count once here. A text of fewer words has no span.
    """
    texts = id_and_text(docs).where("text is not null").select(text_key().alias("t"), "text")
    suffixes = texts.mapInArrow(_suffixes(least_words, prefix), "prefix long, t binary, at int").distinct()
    suffixes = stage(suffixes, "suffixes")
    place = F.struct("t", "at")
    shared = suffixes.groupBy("prefix").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b")
    candidates = suffixes.join(shared.select("prefix"), "prefix", "left_semi").groupBy("t").agg(F.collect_set("at").alias("places"))
    found = texts.join(candidates, "t").dropDuplicates(["t"])
    windows = stage(found.mapInArrow(_extended(least_words, prefix), "content long, prefix long, t binary, start int"), "windows")
    place = F.struct("t", "start")
    repeated = windows.groupBy("content", "prefix").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last")
    marked = windows.join(repeated.select("content", "prefix", "first"), ["content", "prefix"]).select(
        "t", "start", (F.struct("t", "start") != F.col("first")).alias("later"))
    return _joined(marked, least_words)


def _joined(windows: DataFrame, length: int) -> DataFrame:
    """Spans of overlapping or touching windows of one text and kind."""
    line = Window.partitionBy("t", "later").orderBy("start")
    new = F.coalesce(F.col("start") > F.lag("start").over(line) + length, F.lit(True))
    numbered = windows.withColumn("new", new.cast("int")).withColumn("span", F.sum("new").over(line))
    return numbered.groupBy("t", "later", "span").agg(
        F.min("start").alias("start"), (F.max("start") - F.min("start") + length).alias("words")).select("t", "start", "words", "later")


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS, prefix: int = PREFIX) -> DataFrame:
    """(doc_id, start, words, later): passages of each document that occur elsewhere in ``docs``.

    start and words count the document's words. later says whether the
    passage also occurs at a place that comes first, so that exactly the
    later spans may be cut. A text with several documents is one passage in
    all of them, later in all but that with the smallest doc_id, which also
    has the text's other passages. Documents without a repeated passage have
    no row; NULL and short texts never do. Repeated rows are one document; rows with
    a NULL id count as one per text.
    """
    spans = stage(repeated_spans(docs, least_words, prefix), "spans")
    size = F.size(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    rows = id_and_text(docs).where("text is not null").select("doc_id", text_key().alias("t"), F.length("text").alias("n")).distinct()
    owners = rows.groupBy("t").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    copied = owners.where("copies > 1")
    sizes = id_and_text(docs).select(text_key().alias("t"), "text").join(copied.select("t"), "t", "left_semi").dropDuplicates(["t"])
    sizes = stage(sizes.select("t", size.alias("words")).where(F.col("words") >= least_words).join(copied, "t"), "copied")
    whole = rows.join(sizes, "t").select("doc_id", F.lit(0).alias("start"), "words", (~F.col("doc_id").eqNullSafe(F.col("first"))).alias("later"))
    parts = spans.join(owners, "t").where("later or copies = 1").select(F.col("first").alias("doc_id"), "start", "words", "later")
    return whole.unionByName(parts)


def cut_later(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of the given (start, words) spans and what stands between those words."""
    w = words([text.lower()]) if len(text.lower()) != len(text) else words([text])
    out, place = [], 0
    for start, count in sorted(spans):
        begin, end = int(w.start[start]), int(w.end[start + count - 1])
        if end > place:
            out.append(text[place:max(begin, place)])
            place = end
    return "".join(out) + text[place:]
