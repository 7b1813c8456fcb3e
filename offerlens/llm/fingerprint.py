"""Bottom-k sketches of word shingles, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import id_and_text
from offerlens.session import stage

WIDTH = 5
K = 128
DIGITS = 16  # hexadecimal digits of MD5 that a hash keeps
NOT_WORD = r"[^\p{L}\p{N}]+"


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Distinct hashes of all runs of ``width`` lower-case words; a shorter text is one run; none without a word.

    A hash is the first 16 hexadecimal digits of the MD5 of the words joined by blanks.
    """
    return F.array_distinct(_runs(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != ""), width))


def _runs(words: Column, width: int) -> Column:
    # One lambda argument holds the words, so they are split once and not per shingle.
    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
        hashed = F.transform(starts, lambda i: F.left(F.md5(F.array_join(F.slice(w, i + 1, F.lit(width)), " ").cast("binary")), F.lit(DIGITS)))
        return F.when(F.size(w) > 0, hashed).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(F.array(words), of))


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The k smallest shingle hashes of a text in ascending order; all of them where there are fewer."""
    return F.slice(F.sort_array(shingle_hashes(text, width)), 1, k)


def to_text(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the k smallest hashes of the union that both sketches hold.

    Two empty sketches are alike (1), an empty and a filled one are not (0).
    """
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(
        F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.greatest(F.size(union), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has: among hashes below both sketches' limits."""
    limit = F.least(*[F.when(F.size(x) < k, F.lit("g")).otherwise(F.element_at(x, -1)) for x in (a, b)])
    low = F.filter(a, lambda h: h <= limit)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(low, b)) / F.greatest(F.size(low), F.lit(1)))


def distinct_shingles(hashes: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th smallest hash as a fraction."""
    largest = F.conv(F.left(F.element_at(hashes, -1), F.lit(13)), 16, 10).cast("double") / float(1 << 52)
    return F.when(F.size(hashes) < k, F.size(hashes).cast("double")).otherwise((k - 1) / largest)


def merged(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of ``by``, equal to that of the groups' texts taken together.

    Hashes are made distinct before they are ranked, and only a group's k
    smallest of every task's share meet, so a group of any size is no burden.
    """
    salted = sketches.select(*by, F.explode(column).alias("h")).withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(64))).distinct()
    per_salt = salted.groupBy(*by, "salt").agg(F.slice(F.sort_array(F.collect_set("h")), 1, k).alias("part"))
    return per_salt.groupBy(*by).agg(F.slice(F.sort_array(F.flatten(F.collect_list("part"))), 1, k).alias(column))


def _place(limits: list[int], value: Column) -> Column:
    """Number of sorted limits at or below a value, by binary search."""
    array = F.array(*[F.lit(x).cast("long") for x in limits])
    steps = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(len(limits) + 1)))))

    def halved(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        right = (state["low"] < state["high"]) & (F.get(array, middle) <= value)
        return F.struct(
            F.when(right, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(right | (state["low"] >= state["high"]), state["high"]).otherwise(middle).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(len(limits)).alias("high"))
    return F.aggregate(steps, start, halved)["low"]


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, text, next_text and the group and order columns g0, g1, h.

    The next document is that with the next larger doc_id; the last one's is
    the first. NULL ids come first; ties follow a hash of the text. Ranges of
    ids between sampled quantiles are sorted side by side, and each range's
    last row gets the first text of the next range, so no task sees all rows.
    An id that fills whole ranges is split further by the text hash.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("h", F.xxhash64("text"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select("doc_id").dropna().approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    cuts = sorted(int(c) for c in cuts)
    hot = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    limits = sorted({*cuts, *(v + 1 for v in hot)})
    split = F.col("doc_id").isNull() | (F.col("doc_id").isin(hot) if hot else F.lit(False))
    placed = rows.withColumn("g0", F.when(F.col("doc_id").isNull(), -1).otherwise(_place(limits, F.col("doc_id")) if limits else F.lit(0)))
    placed = placed.withColumn("g1", F.when(split, (F.shiftright("h", 58) + 32).cast("int")).otherwise(0))
    order = [F.asc_nulls_first("doc_id"), F.asc("h")]
    heads = placed.groupBy("g0", "g1").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")).alias("first"))
    line = Window.orderBy("g0", "g1")
    heads = heads.select("g0", "g1", "first", F.coalesce(F.lead("first").over(line), F.first("first").over(
        line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    heads = stage(heads.select("g0", "g1", F.col("next.doc_id").alias("n_id"), F.col("next.h").alias("n_h")), "range-heads")
    wanted = heads.select("n_id", "n_h").distinct()
    first_texts = rows.join(F.broadcast(wanted), rows["doc_id"].eqNullSafe(wanted["n_id"]) & (rows["h"] == wanted["n_h"])).select(
        "n_id", "n_h", F.col("text").alias("after")).dropDuplicates(["n_id", "n_h"])
    after = stage(heads.alias("x").join(first_texts.alias("y"), F.expr("x.n_id <=> y.n_id and x.n_h = y.n_h")).select("x.g0", "x.g1", "y.after"), "range-texts")
    within = Window.partitionBy("g0", "g1").orderBy(*order)
    led = placed.withColumn("lead_text", F.lead("text").over(within))
    return led.join(after, ["g0", "g1"]).select(
        "doc_id", "text", F.col("lead_text").isNull().alias("last"), F.coalesce("lead_text", "after").alias("next_text"), "g0", "g1", "h")


def fingerprints(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces the last quarter of the code points by as many
    (or all) of the next document's first ones. A fingerprint is the sketch's
    hashes as one string. A NULL text counts as empty, with an empty
    fingerprint. Equal texts have equal fingerprints. Repeated rows each have a
    row and are each other's next.
    """
    pairs = with_next(docs)
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - quarter), F.left("next_text", quarter))
    rows = pairs.select("doc_id", "g0", "g1", "h", "last", n.cast("long").alias("n_chars"), edited.alias("edited"), "text",
                        F.when(F.col("last"), F.col("next_text")).alias("after"))
    sketched = rows.select("doc_id", "g0", "g1", "h", "last", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                           sketch(F.col("text"), k, width).alias("a"), sketch(F.col("edited"), k, width).alias("e"),
                           F.when(F.col("last"), sketch(F.col("after"), k, width)).alias("z"))
    within = Window.partitionBy("g0", "g1").orderBy(F.asc_nulls_first("doc_id"), F.asc("h"))
    led = sketched.withColumn("b", F.coalesce(F.lead("a").over(within), F.col("z")))
    return led.select("doc_id", "n_chars", "edited_sha256", to_text(F.col("a")).alias("fingerprint"), to_text(F.col("e")).alias("edited_fingerprint"),
                      resemblance(F.col("a"), F.col("e"), k).alias("near_edited"), resemblance(F.col("a"), F.col("b"), k).alias("near_next"))
