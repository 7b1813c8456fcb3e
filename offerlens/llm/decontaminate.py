"""Benchmark decontamination by spaced seeds that hit every overlap, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import fresh, name, text_key
from offerlens.session import stage

LEAST_WORDS = 12  # an overlap has this many words at least, or the whole item where it is shorter
SIMILARITY = 0.8
FILTER_BITS = 21  # seeds of documents pass a broadcast set of at most 2^21 slots, whatever the benchmark's size
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for NULL."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def masks(n: int, least_words: int = LEAST_WORDS, similarity: float = SIMILARITY) -> tuple[tuple[int, int], ...]:
    """Masks (width, gap) of which one at least hits every overlap with an item of ``n`` words.

    A mask reads two blocks of ``width`` words and ignores the ``gap`` words
    between them. Of ``c + 2`` blocks side by side, ``c`` changed words leave
    two unchanged, so the gaps of 0 to ``c`` blocks hit every layout. A long
    overlap has one of fewer than twice ``least_words`` words in it that is as
    similar, as one of its halves is; a shorter item is overlapped whole. Where
    there is no room for two blocks, one is read (its gap is ``-width``).
    """
    sizes = (n,) if n < least_words else range(least_words, 2 * least_words)
    changes = {k: math.floor(k * (1 - similarity) + 1e-9) for k in sizes}
    width = min(k // (c + 2) for k, c in changes.items())
    if not width:
        width = min(k // (c + 1) for k, c in changes.items())
        return ((width, -width),)
    return tuple((width, width * d) for d in range(max(changes.values()) + 1))


def seeds(rows: DataFrame, tokens: str, taken: dict[tuple[int, int], Column]) -> DataFrame:
    """The other columns of ``rows`` with (at, hash) of every window of its words under the masks whose condition holds.

    The hash covers the mask and the words it reads. Words are hashed once,
    then blocks of words, then pairs of blocks, one row a window.
    """
    keys = [c for c in rows.columns if c != tokens]
    hashed = rows.withColumn(tokens, F.transform(tokens, lambda w: F.xxhash64(w)))
    widths = sorted({width for width, _ in taken})

    def blocks(width: int) -> Column:
        all_places = F.transform(tokens, lambda h, i: F.xxhash64(h, *[F.get(F.col(tokens), i + j) for j in range(1, width)]))
        return F.slice(all_places, 1, F.greatest(F.size(tokens) - (width - 1), F.lit(0)))

    cut = hashed.select(*keys, *[blocks(width).alias(f"_{width}") for width in widths])
    parts = [F.col(f"_{width}").alias(f"_{width}") for width in widths]
    parts += [F.slice(f"_{width}", 1 + width + gap, F.size(f"_{width}")).alias(f"_{width}_{m}") for m, (width, gap) in enumerate(taken)]
    windows = cut.select(*keys, F.posexplode(F.arrays_zip(*parts)).alias("at", "_w")).select(*keys, "at", "_w.*")
    hashes = [
        F.when(condition & F.col(f"_{width}").isNotNull() & F.col(f"_{width}_{m}").isNotNull(),
               F.xxhash64(F.lit(width), F.lit(gap), f"_{width}", f"_{width}_{m}"))
        for m, ((width, gap), condition) in enumerate(taken.items())]
    return windows.select(*keys, "at", F.explode(F.array(*hashes)).alias("hash")).where("hash is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(t, item_id, start, words, matched): a document's best overlap with each item it contains.

    t is the text key, start the first word of the overlap in the document.
    Hits of a seed give a diagonal (document position minus item position).
    Along it the whole overlap of item and document is compared word by word.
    A stretch counts with ``least_words`` words or more (or all words of a
    shorter item) and a share of matches of ``similarity`` or more; of those
    the best is taken: the one with the largest number of matches minus, at
    0.8, four times the mismatches. So substitutions are tolerated wherever
    they stand, and parts of an item are found; the seeds hit every overlap
    that counts. Equal texts are judged once. Items without a word never match;
    items with equal words are each reported. Texts of any length are read whole,
    and no other column of either table is looked at, whatever its name.
    """
    raw = docs.select(text_key().alias("t"), name("text").alias("text")).where("text is not null")
    texts = raw.select("t", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    items = benchmark.select(name("item_id").alias("item_id"), words(name("text")).alias("iw")).where(F.size("iw") > 0).distinct()
    items = stage(items, "items")
    known = items.select(F.xxhash64("iw").alias("item"), "iw")
    # Sizes below least_words, and least_words for all others: a few numbers.
    size = F.least(F.size("iw"), F.lit(least_words))
    users: dict[tuple[int, int], list[int]] = {}
    for n in sorted({least_words, *(r["n"] for r in items.select(size.alias("n")).distinct().collect())}):
        for mask in masks(n, least_words, similarity):
            users.setdefault(mask, []).append(n)
    probes = seeds(known.withColumn("n", F.least(F.size("iw"), F.lit(least_words))), "iw",
                   {m: F.col("n").isin(of) for m, of in users.items()})
    probes = stage(probes.select("hash", F.col("at").alias("item_at"), "item").distinct(), "item-seeds")
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("slot")
    slots = F.broadcast(probes.select(slot).distinct())
    asked = seeds(texts, "w", {m: F.lit(True) for m in users}).select("*", slot).join(slots, "slot", "left_semi")
    hits = asked.join(probes, "hash").select(
        "t", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    hits = stage(hits, "hits")
    found = raw.join(hits.select("t").distinct(), "t", "left_semi").dropDuplicates(["t"]).select("t", words(F.col("text")).alias("w"))
    pairs = hits.join(found, "t").join(items.withColumn("item", F.xxhash64("iw")), "item")
    low = F.greatest(F.lit(0), -F.col("diagonal"))
    high = F.least(F.size("iw"), F.size("w") - F.col("diagonal"))
    compared = pairs.withColumn("low", low).withColumn("same", F.zip_with(
        F.slice("iw", low + 1, high - low), F.slice("w", low + F.col("diagonal") + 1, high - low), lambda a, b: a == b))
    best = compared.withColumn("best", _best_stretch(F.col("same"), F.least(F.lit(least_words), F.size("iw")), similarity))
    stretch = best.select(
        "t", "item_id", (F.col("low") + F.col("diagonal") + F.col("best.start")).alias("start"),
        F.col("best.words").alias("words"), F.col("best.matched").alias("matched"))
    rank = F.struct("matched", -F.col("words"), -F.col("start"))
    return stretch.where("words > 0").groupBy("t", "item_id").agg(F.max_by(F.struct("start", "words", "matched"), rank).alias("o")).select(
        "t", "item_id", "o.start", "o.words", "o.matched")


def _best_stretch(same: Column, least: Column, similarity: float) -> Column:
    """Start, length and matches of the best stretch of ``least`` words or more; words is 0 if none is similar enough.

    A match gains 1 and a mismatch loses as much as makes a stretch at the
    similarity 0, so a stretch is similar enough if its gain is not negative.
    The largest gain wins, then the earliest end, then the latest start. Every
    end is held against the lowest running sum ``least`` words before it or earlier.
    """
    loss = round(similarity / (1 - similarity), 9) if similarity < 1 else 1e9

    def gain(hit: Column) -> Column:
        return F.when(hit, 1.0).otherwise(-loss)

    def step(state: Column, hit: Column) -> Column:
        at, left = state["at"] + 1, state["at"] + 1 - least
        total, hits = state["total"] + gain(hit), state["hits"] + hit.cast("int")
        before = F.get(same, left - 1)  # the word that the latest start has just passed
        moved = left > 0
        low, low_hits = (F.when(moved, state["low"] + gain(before)).otherwise(0.0),
                         F.when(moved, state["low_hits"] + before.cast("int")).otherwise(0))
        lower = moved & (low <= state["least"])
        return F.struct(
            at.alias("at"), total.alias("total"), hits.alias("hits"), low.alias("low"), low_hits.alias("low_hits"),
            F.when(lower, low).otherwise(state["least"]).alias("least"),
            F.when(lower, low_hits).otherwise(state["least_hits"]).alias("least_hits"),
            F.when(lower, left).otherwise(state["begin"]).alias("begin"),
            *[state[c].alias(c) for c in ("top", "start", "words", "matched")])

    def judged(state: Column) -> Column:
        top = state["total"] - state["least"]
        better = (state["at"] >= least) & (top > state["top"])
        return F.struct(
            *[state[c].alias(c) for c in ("at", "total", "hits", "low", "low_hits", "least", "least_hits", "begin")],
            F.when(better, top).otherwise(state["top"]).alias("top"),
            F.when(better, state["begin"]).otherwise(state["start"]).alias("start"),
            F.when(better, state["at"] - state["begin"]).otherwise(state["words"]).alias("words"),
            F.when(better, state["hits"] - state["least_hits"]).otherwise(state["matched"]).alias("matched"))

    # The sums are of whole numbers at 0.8; other similarities are rounded to 9 digits.
    begin = {"at": 0, "total": 0.0, "hits": 0, "low": 0.0, "low_hits": 0, "least": 0.0, "least_hits": 0, "begin": 0,
             "top": -1e-6, "start": 0, "words": 0, "matched": 0}
    return F.aggregate(
        same, F.struct(*[F.lit(v).alias(k) for k, v in begin.items()]),
        lambda state, hit: F.element_at(F.transform(F.array(step(state, hit)), judged), 1))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, start, words, matched), one row per document and item found in it.

    Clean documents have no row. Repeated rows of ``docs`` each have theirs; a
    NULL id stays NULL. NULL and empty texts are clean. No items, no rows.
    """
    found = stage(overlaps(docs, benchmark, **options), "overlaps")
    return docs.select(name("doc_id").cast("long").alias("doc_id"), text_key().alias("t")).join(found, "t").select(
        "doc_id", "item_id", "start", "words", "matched")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` without an overlap, columns unchanged; NULL and empty texts stay."""
    t = fresh(docs, "_t")
    leaked = stage(overlaps(docs, benchmark, **options).select(F.col("t").alias(t)).distinct(), "leaked")
    return docs.withColumn(t, text_key()).join(leaked, t, "left_anti").drop(t)
