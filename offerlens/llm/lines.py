"""Near-equal lines by an exact set-similarity join with prefix, positional, length and parity filters."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import id_and_text, slices
from offerlens.llm.prefix import RARITY_BUCKETS, rarity
from offerlens.llm.words import CHARS, U, counted, mix, words
from offerlens.session import stage

THRESHOLD = 0.8
PLACES = 1 << 24  # bits of the table that tells which documents hold a line to compare; 2 MB at any size

_TOKEN_BITS, _HASH_BITS = U(45), U(37)
_LINES = 1 << 19
_DRAWS = tuple(U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
PARITIES = ("parity", "parity2")
SHARES = 8  # lines of a group that all others of it are compared with
_ROW = ("doc_id long, t long, lines int, line int, key long, low boolean, size int, parity long, parity2 long, "
        "group1 long, group2 long, prefix binary")
_PAIR = "a long, b long, a_settled int, b_settled int"
_PAIRS = 1 << 18  # pairs that are compared at a time
_POSTINGS = 1 << 20  # postings that are cut into blocks at a time
_BLOCK = "part int, sizes int, block binary"


def _token_sets(texts: list[str], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines with a word: (text, line number, limits into tokens, distinct tokens from rare to common).

    A token is a word's rarity class, then 37 bits of its hash, so one sort
    of numbers both removes repeated words and orders the rest.
    """
    w = words(texts)
    line = np.searchsorted(w.line_end, w.start)
    token = (rank[(w.hashes & U(RARITY_BUCKETS - 1)).astype(np.int64)] << _HASH_BITS) | (w.hashes >> (U(64) - _HASH_BITS))
    new = np.append(line[:1] >= 0, line[1:] != line[:-1])
    used, line = line[new], np.cumsum(new) - 1
    limits, tokens = [np.zeros(1, np.int64)], []
    for low in range(0, len(used), _LINES):  # as many lines at a time as the other bits can number
        i, j = np.searchsorted(line, (low, low + _LINES))
        both = np.sort(((line[i:j] - low).astype(U) << _TOKEN_BITS) | token[i:j])
        both = both[np.append(True, both[1:] != both[:-1])]
        ends = np.searchsorted(both >> _TOKEN_BITS, np.arange(1, min(_LINES, len(used) - low) + 1, dtype=U))
        limits.append(limits[-1][-1] + ends)
        tokens.append(both & U((1 << int(_TOKEN_BITS)) - 1))
    first_line = np.append(0, np.cumsum([t.count("\n") + 1 for t in texts]))
    owner = np.searchsorted(first_line, used, side="right") - 1
    return owner, used - first_line[owner], np.concatenate(limits), np.concatenate(tokens or [np.zeros(0, U)])


def _lowest(key: np.ndarray, doc_id: pa.Array, t: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Whether a row has the lowest place of its key."""
    order = np.lexsort((line, t, doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False), key))
    low = np.zeros(len(key), bool)
    low[order[np.append(True, key[order][1:] != key[order][:-1])]] = True
    return low


def _rows(counts: np.ndarray, threshold: float):
    """A row for every line with a word: its key, and where no earlier one of the slice has that key its size, the parities of
    its tokens by 128 classes, two groups, its prefix. A document's first row holds the number of its lines; one without has a row without a line."""
    rank = np.minimum(8 * np.log2(counts + 1.0), 255).astype(U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices(texts, CHARS):
                owner, number, limit, token = _token_sets(texts[lo:hi], rank)
                doc_id, t = batch.column("doc_id").slice(lo, hi - lo), batch.column("t").slice(lo, hi - lo)
                lines = np.bincount(owner, minlength=hi - lo)
                bare = np.flatnonzero(lines == 0)
                if len(bare):
                    blank = {f.name: pa.nulls(len(bare), f.type) for f in _schema()}
                    yield pa.RecordBatch.from_arrays(list((blank | {
                        "doc_id": doc_id.take(pa.array(bare)), "t": t.take(pa.array(bare)), "lines": pa.array(np.zeros(len(bare), np.int32))}).values()), schema=_schema())
                size = np.diff(limit)
                if not len(size):
                    continue
                first, scrambled = limit[:-1], mix(token)
                key = mix(np.add.reduceat(scrambled, first) + size.astype(U)).view(np.int64)
                bit, half = U(1) << (scrambled >> U(58)), (scrambled >> U(57)) & U(1)
                parity, parity2 = (np.bitwise_xor.reduceat(bit * h, first) for h in (U(1) - half, half))
                least = [np.minimum.reduceat(scrambled * d, first) for d in _DRAWS]
                group1, group2 = mix(least[0] + mix(least[1])), mix(least[2] + mix(least[3]))
                length = (size - np.ceil(threshold * size - 1e-9) + 1).astype(np.int64)
                at = np.arange(len(token)) - np.repeat(first, size)
                prefix = (scrambled[at < np.repeat(length, size)] >> U(32)).astype(np.uint32)
                rows = pa.array(owner)
                doc_id, t = doc_id.take(rows), t.take(rows)
                low = pa.array(_lowest(key, doc_id, t.to_numpy(), number))
                yield pa.RecordBatch.from_arrays(
                    [doc_id, t, pa.array(lines[owner].astype(np.int32), mask=np.append(False, owner[1:] == owner[:-1])), pa.array(number.astype(np.int32)),
                     pa.array(key), low, *[pc.if_else(low, x, pa.scalar(None, x.type)) for x in (
                         pa.array(size.astype(np.int32)), *[pa.array(x.view(np.int64)) for x in (parity, parity2, group1, group2)],
                         pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.append(0, 4 * np.cumsum(length)).astype(np.int32)), pa.py_buffer(prefix)]))]],
                    schema=_schema())

    return run


def _schema() -> pa.Schema:
    """The columns of _ROW in Arrow's types."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in _ROW.split(", "))])


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whole numbers of stretches, given by their first numbers and sizes, in a row."""
    end = np.cumsum(size)
    return np.repeat(first - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def _posted(threshold: float, parts: int):
    """Blocks of postings by part of the words and class of sizes, from sets with the words of their prefixes.

    A posting is a word and the size of its set, the set's key and parities, and the word's position with the mark of a settled
    set. A set of a class of sizes is only similar to smaller ones of its class and the one before.
    """
    ratio = max(math.log(1 / threshold), 0.01)

    def blocks(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sets = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        prefix = sets.column("prefix")
        n = pc.binary_length(prefix).to_numpy().astype(np.int64) // 4
        owner, word = np.repeat(np.arange(len(n)), n), np.frombuffer(b"".join(prefix.to_pylist()), np.int32).astype(np.int64)
        size = sets.column("size").to_numpy().astype(np.int64)[owner]
        part, sizes = word % parts, (np.log(size) / ratio).astype(np.int64)
        classes = int(sizes.max()) + 1 if len(sizes) else 1
        code = part * classes + sizes
        order = np.argsort(code.astype(np.uint16) if parts * classes <= 1 << 16 else code, kind="stable")  # 16 bits are sorted by digits
        owner, word, size, part, sizes = (x[order] for x in (owner, word, size, part, sizes))
        place = ((_spans(np.zeros(len(n), np.int64), n)[order] << 1) | sets.column("settled").to_numpy()[owner]).astype(np.int32)
        columns = [(word << 32) | size, *[sets.column(c).to_numpy()[owner] for c in ("key", *PARITIES)], place]
        start = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (sizes[1:] != sizes[:-1])))
        cut = [b"".join(c[i:j].tobytes() for c in columns) for i, j in zip(start.tolist(), [*start[1:].tolist(), len(word)])]
        return pa.RecordBatch.from_arrays([pa.array(part[start], pa.int32()), pa.array(sizes[start], pa.int32()), pa.array(cut, pa.binary())], ["part", "sizes", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.column("prefix").nbytes // 4
            if n > _POSTINGS:
                yield blocks(held)
                held, n = [], 0
        if held:
            yield blocks(held)

    return run


def _columns(block: bytes) -> list[np.ndarray]:
    """Word and size, key, the parities, position and mark of a block's postings."""
    n = len(block) // 36
    return [*np.frombuffer(block, np.int64, 4 * n).reshape(4, n), np.frombuffer(block, np.int32, n, 32 * n)]


def _compared(threshold: float, met: np.ndarray, at: np.ndarray, settled: np.ndarray, fresh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (a, b), some at a time, of postings ordered by word and size that share a word, may be similar by their sizes and are
    not both settled; b is fresh.

    a comes first, so its set is not the larger, and the first word that similar sets share is among fewer words of it
    than of a larger set: the rest of its postings only look for smaller sets.
    """
    size = met & 0xFFFFFFFF
    least = met - size + np.ceil(threshold * size - 1e-9).astype(np.int64)
    # The words of b from this one on must be enough for all words that are needed in common: that bounds the size of a as well.
    most = met - size + np.maximum(np.floor((size - at) * (1 + threshold) / threshold - size + 1e-6), 0).astype(np.int64)
    found = at < size - np.ceil(2 * threshold / (1 + threshold) * size - 1e-9) + 1
    for asking, answering in ((fresh & (settled == 0), found), (fresh & (settled == 1), found & (settled == 0))):
        b, of = np.flatnonzero(asking), np.flatnonzero(answering)
        low = np.searchsorted(met[of], least[b])
        n = np.minimum(np.searchsorted(of, b), np.searchsorted(met[of], most[b], side="right")) - low
        b, low, n = b[n > 0], low[n > 0], n[n > 0]
        total, start = np.cumsum(n), 0
        while start < len(b):
            end = max(np.searchsorted(total, (total[start - 1] if start else 0) + _PAIRS, side="right"), start + 1)
            yield of[_spans(low[start:end], n[start:end])], np.repeat(b[start:end], n[start:end])
            start = end


def _meeting(threshold: float):
    """Pairs of sets that may be similar, from blocks ordered by part and class of sizes. Held are the postings of one class and
    those of smaller sets that it may still meet."""
    def pairs(rows: list[np.ndarray], old: int) -> tuple[pa.RecordBatch, list[np.ndarray]]:
        order = np.argsort(rows[0])
        met, key, parity, parity2, place = (x[order] for x in rows)
        at, settled, size = place >> 1, place & 1, met & 0xFFFFFFFF
        kept = [np.zeros((2, 0), np.int64)]
        for a, b in _compared(threshold, met, at, settled, order >= old):
            need = np.ceil(threshold / (threshold + 1) * (size[a] + size[b]) - 1e-9)
            near = np.minimum(size[a] - at[a], size[b] - at[b]) >= need
            a, b, need = a[near], b[near], need[near]
            apart = sum(np.bitwise_count((p[a] ^ p[b]).view(U)).astype(np.int64) for p in (parity, parity2))
            near = (apart <= size[a] + size[b] - 2 * need) & (key[a] != key[b])
            kept.append(np.stack([a[near], b[near]]))
        a, b = np.concatenate(kept, axis=1)
        a, b = np.where(key[a] < key[b], (a, b), (b, a))
        found = pa.RecordBatch.from_arrays([pa.array(x) for x in (key[a], key[b], settled[a], settled[b])], ["a", "b", "a_settled", "b_settled"])
        stay = size >= math.ceil(threshold * size.max() - 1e-9)
        return found, [x[stay] for x in (met, key, parity, parity2, place)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smaller, fresh, here = None, [], None
        for part, sizes, block in itertools.chain((row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("part", "sizes", "block")))), [(None, None, None)]):
            if fresh and (part, sizes) != here:
                before = smaller if smaller is not None and smaller[0] == here[0] else (None, [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.int32)])
                found, rest = pairs([np.concatenate(x) for x in zip(before[1], *fresh)], len(before[1][0]))
                smaller, fresh = (here[0], rest), []
                yield found
            here = part, sizes
            if block is not None:
                fresh.append(_columns(block))

    return run


def _may_be_similar(threshold: float, a: str, b: str) -> Column:
    """Whether two sets can reach the threshold by their sizes and parities.

    Tokens in only one of two sets change the parity of a class each, so the
    classes that differ are at most as many as those tokens.
    """
    t, x, y = F.lit(threshold), F.col(f"{a}size"), F.col(f"{b}size")
    apart = sum(F.bit_count(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}"))) for p in PARITIES)
    return (F.least(x, y) >= t * F.greatest(x, y) - 1e-9) & (apart <= x + y - 2 * F.ceil(t / (t + 1) * (x + y) - 1e-9))


def _places_table(hashes: DataFrame) -> DataFrame:
    """(cell, bits): a table of PLACES bits with those of the hashes (column h) set."""
    return hashes.groupBy(_cell("h").alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))


def _cell(h: str) -> Column:
    return F.pmod(F.shiftright(h, 6), F.lit(PLACES // 64)).cast("int")


def _texts_of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, lines = [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            split = text.split("\n")
            keys += [w["key"] for w in wanted]
            lines += [split[w["line"]] for w in wanted]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lines, pa.string())], ["key", "text"])


def _similar(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist()
            good = np.zeros(len(a), bool)
            for lo, hi in slices([x + y for x, y in zip(a, b)], CHARS):
                known: dict[str, int] = {}
                x, y = (np.array([known.setdefault(line, len(known)) for line in side[lo:hi]]) for side in (a, b))
                line, token, _ = counted(*(lambda w: (w.doc, w.hashes))(words(list(known))))
                limit = np.searchsorted(line, np.arange(len(known) + 1))
                kinds, token = np.unique(token, return_inverse=True)
                size, pair = np.diff(limit), np.arange(hi - lo)
                # The words of both lines of every pair in a row: those in common come twice.
                both = np.sort(np.concatenate([np.repeat(pair, size[z]) * len(kinds) + token[_spans(limit[z], size[z])] for z in (x, y)]))
                common = np.bincount(both[1:][both[1:] == both[:-1]] // max(len(kinds), 1), minlength=hi - lo)
                good[lo:hi] = common >= threshold * (size[x] + size[y] - common) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good))

    return run


def repeated_lines(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(lines, repeats): every line with a word, and the keys of word sets that repeat an earlier one.

    lines is (doc_id, t, line, key); t is a hash of the text, key stands for
    the line's set of lower-case words, order the document id, then t and line
    number. repeats is (later, earlier): a key and a similar key that occurs first.
    Words are ordered by rarity over the whole table (hashed counts; any
    common order gives the same result), so only a line's rarest words are
    joined: two sets that reach the threshold share one there. Length,
    position and the parity of the words' hash classes bound the overlap
    before a pair is kept, and the Jaccard similarity of a kept pair is
    computed from the lines. Lines are first grouped by minima of their word hashes and
    compared with the earliest of each of a few shares of their group: that settles most of a large
    group of near-equal lines with a few comparisons a line. A settled line is not compared with
    those before it again; all others meet in the join, so no repeat is missed.
    """
    rows, _, repeats = _judged(docs, threshold)
    return rows.where("key is not null").select("doc_id", "t", "line", "key"), repeats


def _judged(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of all lines, (key, place) with the first place of every key, repeats) as repeated_lines has them."""
    plain = id_and_text(docs).where("text is not null").select("doc_id", F.xxhash64("text").alias("t"), "text")
    counts = rarity(plain, lambda texts: words(texts).hashes)
    rows = stage(plain.mapInArrow(_rows(counts, threshold), _ROW), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "t", "line")
    smallest = threshold / (1 - threshold) if threshold < 1 else float("inf")  # smaller sets have only equal ones
    # A slice of texts has one low row of a key at most, so they are brought together without a combination before.
    every = stage(rows.where("low").repartition("key").groupBy("key").agg(
        F.min(place).alias("place"), *[F.first(c).alias(c) for c in ("size", *PARITIES, "group1", "group2", "prefix")]), "line-sets")
    sets = every.where(F.col("size") >= smallest - 1e-9)

    def verified(pairs: DataFrame) -> DataFrame:
        """(later, earlier) of the pairs (a, b, a_place, b_place) that reach the threshold."""
        pairs = stage(pairs, "line-pairs")
        keys = pairs.select(F.col("a").alias("key"), F.col("a_place").alias("place")).union(pairs.select("b", "b_place"))
        keys = keys.distinct().select("key", "place.doc_id", "place.t", "place.line")
        home = F.xxhash64("doc_id", "t")
        wanted = keys.groupBy("doc_id", "t").agg(F.collect_list(F.struct("key", "line")).alias("wanted"))
        places = _places_table(keys.select(home.alias("h")))
        near = plain.withColumn("h", home).withColumn("cell", _cell("h")).join(F.broadcast(places), "cell").where("(shiftrightunsigned(bits, cast(h & 63 as int)) & 1) = 1")
        found = near.join(wanted.withColumnRenamed("doc_id", "d"), (near["t"] == wanted["t"]) & near["doc_id"].eqNullSafe(F.col("d")))
        texts = stage(found.select("text", "wanted").mapInArrow(_texts_of_lines, "key long, text string").dropDuplicates(["key"]), "line-texts")
        sides = (pairs.select("a", "b").join(texts.select(F.col("key").alias("a"), F.col("text").alias("a_text")), "a")
                 .join(texts.select(F.col("key").alias("b"), F.col("text").alias("b_text")), "b"))
        links = pairs.join(sides.mapInArrow(_similar(threshold), "a long, b long"), ["a", "b"])
        late = F.col("a_place") > F.col("b_place")
        return stage(links.select(F.when(late, F.col("a")).otherwise(F.col("b")).alias("later"),
                                  F.when(late, F.col("b")).otherwise(F.col("a")).alias("earlier")), "line-links")

    met = sets.select("key", "place", "size", *PARITIES, F.explode(F.array("group1", "group2")).alias("group"))
    # Smaller groups have as few pairs themselves.
    several = sets.select(F.explode(F.array("group1", "group2")).alias("group")).groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARES)
    several = stage(several.select("group"), "line-large-groups").hint("merge")
    grouped = stage(met.join(several, "group", "left_semi"), "line-groups")
    share = F.pmod("key", F.lit(SHARES)).alias("share")
    earliest = grouped.groupBy("group", share).agg(F.min(F.struct("place", "key", "size", *PARITIES)).alias("low"))
    earliest = earliest.select("group", *[F.col(f"low.{c}").alias(f"b_{c}") for c in ("place", "key", "size", *PARITIES)])
    met = grouped.join(earliest, "group").where((F.col("place") > F.col("b_place")) & _may_be_similar(threshold, "", "b_"))
    settled = verified(met.select(F.col("key").alias("a"), F.col("b_key").alias("b"), F.col("place").alias("a_place"), F.col("b_place")).dropDuplicates(["a", "b"]))

    marked = sets.join(settled.select(F.col("later").alias("key"), F.lit(1).alias("settled")).distinct(), "key", "left")
    # Blocks, as single postings would be the most rows by far: as many parts as there are millions of words in all lines.
    blocks = marked.select("key", *PARITIES, "size", F.coalesce("settled", F.lit(0)).alias("settled"), "prefix").mapInArrow(
        _posted(threshold, 1 + int(counts.sum()) // 1_000_000), _BLOCK)
    ordered = blocks.repartition("part").sortWithinPartitions("part", "sizes")
    pairs = ordered.mapInArrow(_meeting(threshold), _PAIR).distinct()
    placed = sets.select("key", "place")
    pairs = (pairs.join(placed.select(F.col("key").alias("a"), F.col("place").alias("a_place")), "a")
             .join(placed.select(F.col("key").alias("b"), F.col("place").alias("b_place")), "b"))
    # A settled line has its earlier one: only those without are compared with all before them.
    pairs = pairs.where(F.when(F.col("a_place") > F.col("b_place"), F.col("a_settled")).otherwise(F.col("b_settled")) == 0).drop("a_settled", "b_settled")
    return rows, every.select("key", "place"), settled.unionByName(verified(pairs))


def without_repeats(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, lines (with a word), removed (numbers of the lines to remove, from 0, ascending).

    A line goes when an earlier line (by document id, text hash, line number)
    has a set of words with a Jaccard similarity of the threshold or more,
    equal sets included; whether that line goes itself does not matter. Lines
    without a word are never counted or removed. Every document has a row,
    one with a NULL or empty text with 0 lines; repeated rows (equal id and
    text) are one document, NULL ids come last.
    """
    rows, first, repeats = _judged(docs, threshold)
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "t", "line")
    gone = repeats.select(F.col("later").alias("key")).distinct().withColumn("similar", F.lit(True))
    first = first.withColumnRenamed("place", "first").join(gone, "key", "left")
    none = F.lit(None).cast("int")
    removed = rows.where("key is not null").join(first, "key").where(F.col("similar").isNotNull() | (place != F.col("first")))
    parts = removed.select("doc_id", "t", F.lit(0).alias("lines"), "line").unionByName(
        rows.where("lines is not null").select("doc_id", "t", "lines", none.alias("line"))).unionByName(
        id_and_text(docs).where("text is null").select("doc_id", F.lit(None).cast("long").alias("t"), F.lit(0).alias("lines"), none.alias("line")))
    return parts.groupBy("doc_id", "t").agg(F.max("lines").cast("long").alias("lines"), F.sort_array(F.collect_set("line")).alias("removed")).drop("t")


def kept_text(text: str, removed: list[int]) -> str:
    """A text without its removed lines."""
    gone = set(removed)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
