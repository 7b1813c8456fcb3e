"""Near duplicates by ProbMinHash signatures, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import fresh, id_and_text, name, slices, text_key
from offerlens.llm.components import components
from offerlens.llm.prefix import may_match, prefixes, rarity
from offerlens.llm.words import CHARS, U, counted, mix, shingles, words
from offerlens.session import stage

WIDTH = 5
THRESHOLD = 0.8
BANDS = 24
BAND_ROWS = 5  # a pair at the threshold shares a band with probability 1 - (1 - 0.8**5)**24 = 0.99993
HAS_WORD = r"[\p{L}\p{N}]"


def probability_signature(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash: per text and register the element whose arrival was first.

    Every element is a Poisson process with its weight as rate; each arrival
    falls into one register, and hash and arrival number give both time and
    register. A text's elements stop as soon as their next arrival comes after
    the latest first arrival of its registers. Two texts agree in a register
    with probability equal to their probability Jaccard similarity.
    """
    first = np.full(n * registers, np.inf)
    chosen = np.zeros(n * registers, U)
    time = np.zeros(len(element))
    arrival = 0
    latest = np.full(n, np.inf)
    while len(element):
        steps = 1 if arrival < 3 else 16
        number = np.arange(arrival, arrival + steps, dtype=U)
        seeds = mix(element[:, None] + (number * U(0x9E3779B97F4A7C15))[None, :])
        gaps = -np.log(((seeds >> U(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / weight[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        place = doc[:, None] * registers + (mix(seeds + U(1)) % U(registers)).astype(np.int64)
        early = times < latest[doc][:, None]
        at, when = place[early], times[early]
        np.minimum.at(first, at, when)
        won = first[at] == when
        chosen[at[won]] = np.broadcast_to(element[:, None], place.shape)[early][won]
        touched = np.unique(doc)
        latest[touched] = first.reshape(n, registers)[touched].max(axis=1)
        time = times[:, -1]
        alive = time < latest[doc]
        doc, element, weight, time = doc[alive], element[alive], weight[alive], time[alive]
        arrival += steps
    return chosen.reshape(n, registers)


def band_keys(texts: list[str], width: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of texts with a word, their 64-bit band keys). All shingles weigh the same, so bands follow the Jaccard similarity of sets."""
    doc, element, _ = counted(*shingles(words(texts), width))
    places, doc = np.unique(doc, return_inverse=True)
    signature = probability_signature(doc, element, np.ones(len(element)), len(places), bands * rows)
    keys = np.tile(np.arange(bands, dtype=U), (len(places), 1))
    for j in range(rows):
        keys = mix(keys + signature.reshape(len(places), bands, rows)[:, :, j])
    return places, keys.view(np.int64)


def _banded(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices(texts, CHARS):
                places, keys = band_keys(texts[lo:hi], width, bands, rows)
                owners = batch.column("t").take(pa.array(np.repeat(places + lo, bands)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), owners], ["band", "t"])

    return run


def _verified(width: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist()
            similar = np.zeros(len(first), bool)
            for lo, hi in slices([x + y for x, y in zip(first, second)], CHARS):
                known: dict[str, int] = {}
                pairs = [(known.setdefault(x, len(known)), known.setdefault(y, len(known)))
                         for x, y in zip(first[lo:hi], second[lo:hi])]
                doc, element, _ = counted(*shingles(words(list(known)), width))
                limit = np.searchsorted(doc, np.arange(len(known) + 1))
                for k, (x, y) in enumerate(pairs):
                    x, y = element[limit[x]:limit[x + 1]], element[limit[y]:limit[y + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    similar[lo + k] = both >= threshold * (len(x) + len(y) - both) - 1e-9
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(similar))

    return run


def near_links(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS,
               rows: int = BAND_ROWS) -> DataFrame:
    """(node, root): text keys of texts that have a near duplicate, with the smallest key of their class.

    Copies collapse to one text key first. Texts that share a band are
    candidates, and verification takes the exact Jaccard similarity of their
    sets of shingles, which the signatures estimate as well: how often a text
    repeats a shingle counts in neither. (A line that many texts repeat must
    not make them alike, nor set copies apart.) Pairs within a band are not all formed. The text that meets
    the most others is the centre of its bands: edited copies resemble their
    original more than each other, and the original meets most. Every text is
    checked against the most central text it meets, then against the centre of each
    of its bands. Texts whose bands still hold several classes are joined
    exactly: on their rarest shingles, of which two texts of the wanted
    similarity share one, with positional and length filters, and only across
    classes. Two texts of one class need no further check, so no link between
    classes is lost, a group of copies costs a check per copy and band, and a
    passage that many different texts share makes no pairs.
    """
    plain = id_and_text(docs).where(F.col("text").rlike(HAS_WORD)).select(text_key().alias("t"), "text")
    banded = plain.mapInArrow(_banded(width, bands, rows), "band long, t binary").distinct()
    banded = stage(banded, "bands")
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(banded.join(sizes, "band"), "shared")
    company = shared.groupBy("t").agg(F.sum("n").alias("company"))
    ranked = stage(shared.join(company, "t").select("band", "t", F.struct("company", "t").alias("rank")), "ranked")
    centres = ranked.groupBy("band").agg(F.max("rank").alias("centre"))
    met = stage(ranked.select("band", "t").join(centres, "band"), "met")
    texts = stage(plain.join(met.select("t").distinct(), "t", "left_semi").dropDuplicates(["t"]), "met-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        sides = (pairs.distinct().join(texts.select(F.col("t").alias("a"), F.col("text").alias("a_text")), "a")
                 .join(texts.select(F.col("t").alias("b"), F.col("text").alias("b_text")), "b"))
        return stage(sides.mapInArrow(_verified(width, threshold), "a binary, b binary"), "links")

    nearest = met.groupBy("t").agg(F.max("centre").alias("centre")).select(F.col("t").alias("a"), F.col("centre.t").alias("b"))
    links = verified(nearest.where("a != b"))
    members = stage(_labelled(met, stage(components(links), "classes")), "members")
    links = links.union(verified(_with_centre(members)))
    members = _labelled(met, stage(components(links), "classes")).select("t", "root").distinct()
    apart = stage(members.join(texts, "t"), "apart")
    counts = rarity(apart, lambda rows: counted(*shingles(words(rows), width))[1])
    rare = stage(apart.mapInArrow(_rare(width, threshold, counts), "element long, t binary, root binary, size int, at int"), "rare")
    links = links.union(verified(_across(rare, threshold)))
    return stage(components(links), "classes")


def _labelled(met: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of bands that still hold texts of several classes."""
    members = met.join(classes.withColumnRenamed("node", "t"), "t", "left").select(
        "band", "t", F.col("centre.t").alias("centre"), F.coalesce("root", "t").alias("root"))
    split = members.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1")
    return members.join(split.select("band"), "band", "left_semi")


def _with_centre(members: DataFrame) -> DataFrame:
    centres = members.where("t = centre").select("band", F.col("root").alias("centre_root"))
    return members.join(centres, "band").where("root != centre_root").select(F.col("t").alias("a"), F.col("centre").alias("b"))


def _rare(width: int, threshold: float, counts: np.ndarray):
    """The rarest shingles of every text, as many as any text of its likeness must share one of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices(texts, CHARS):
                doc, element, _ = counted(*shingles(words(texts[lo:hi]), width))
                limit = np.searchsorted(doc, np.arange(hi - lo + 1))
                first, at, length = prefixes(element, limit, counts, threshold)
                rows = np.repeat(np.arange(hi - lo), length)
                owner = pa.array(rows + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), batch.column("t").take(owner), batch.column("root").take(owner),
                     pa.array(np.diff(limit)[rows].astype(np.int32)), pa.array(at.astype(np.int32))],
                    ["element", "t", "root", "size", "at"])

    return run


def _across(rare: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different classes that share a rare shingle and can reach the threshold.

    Shingles of exactly the same texts (told by two XORs of the texts' hashes and their number) would make the
    same pairs: only the first in the common order stays, which is the one
    the positional filter needs. Of each shingle's texts those outside its
    largest class meet every other.
    """
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "t"))
    sets = rare.groupBy("element").agg(
        F.count(F.lit(1)).alias("n"), mark(1).alias("x1"), mark(2).alias("x2"), F.sum("at").alias("place"),
        F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1")
    kept = sets.groupBy("n", "x1", "x2").agg(F.min_by("element", F.struct("place", "element")).alias("element")).select("element")
    rare = stage(rare.join(kept, "element", "left_semi"), "rare-kept")
    sizes = rare.groupBy("element", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("element").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    sided = rare.join(main, "element").withColumn("in_main", F.col("root") == F.col("main"))
    a = sided.where("not in_main").select("element", *[F.col(c).alias(f"a_{c}") for c in ("t", "root", "size", "at")])
    b = sided.select("element", *[F.col(c).alias(f"b_{c}") for c in ("t", "root", "size", "at", "in_main")])
    apart = F.expr("a_root != b_root and (b_in_main or a_t < b_t)")
    return a.join(b, "element").where(apart & may_match(threshold, "a_size", "b_size", "a_at", "b_at")).select(
        F.col("a_t").alias("a"), F.col("b_t").alias("b"))


def duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, class_id, copies (rows of its class).

    class_id is the smallest doc_id of the class. Classes are the connected
    sets of texts whose sets of five-word shingles have a Jaccard similarity
    of the threshold or more, copies included.
    A text without a letter or digit (NULL and empty included) has no
    shingles and is a class of its own. A text of under five words is one
    shingle. Rows with a NULL id take part; repeated rows count as copies.
    """
    source = id_and_text(docs)
    roots = near_links(docs, **options)
    rows = source.select("doc_id", F.when(F.col("text").rlike(HAS_WORD), text_key()).alias("t"))
    texts = rows.where("t is not null").groupBy("t").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    texts = texts.join(roots.withColumnRenamed("node", "t"), "t", "left").withColumn("root", F.coalesce("root", "t"))
    classes = texts.groupBy("root").agg(F.min("low").alias("class_id"), F.sum("n").alias("copies"))
    named = texts.select("t", "root").join(classes, "root").select("t", "class_id", "copies")
    return rows.join(named, "t", "left").select(
        "doc_id", F.when(F.col("t").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id, then the smallest text key.

    Texts without a word stay, all of them. Of repeated rows that could
    all stay, one does. All columns are returned unchanged.
    """
    roots = near_links(docs, **options)
    t, first, again = (fresh(docs, stem) for stem in ("_t", "_first", "_again"))
    keyed = docs.withColumn(t, F.when(name("text").rlike(HAS_WORD), text_key()))
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "t")
    texts = (keyed.where(name(t).isNotNull()).select(name(t).alias("t"), name("doc_id").cast("long").alias("doc_id"))
             .groupBy("t", "doc_id").agg(F.count(F.lit(1)).alias("n")))
    texts = texts.join(roots.withColumnRenamed("node", "t"), "t", "left").withColumn("root", F.coalesce("root", "t"))
    winners = texts.groupBy("root").agg(F.min(order).alias("w"), F.min_by("n", order).alias("n")).select(
        F.col("w.t").alias(t), F.col("w.doc_id").alias(first), (F.col("n") > 1).alias(again))
    kept = keyed.join(winners, (keyed[f"`{t}`"] == winners[f"`{t}`"]) & keyed["doc_id"].eqNullSafe(winners[f"`{first}`"]))
    kept = kept.select(*[keyed[f"`{c}`"] for c in keyed.columns], winners[f"`{again}`"])
    repeated = kept.where(name(again)).dropDuplicates([t])
    rest = kept.where(~name(again)).unionByName(repeated)
    return rest.select(*[name(c) for c in docs.columns]).unionByName(
        keyed.where(name(t).isNull()).select(*[name(c) for c in docs.columns]))
