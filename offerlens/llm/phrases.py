"""Phrases whose words keep company: collocations from a weighted de Bruijn graph of words."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import name, ranges
from offerlens.session import stage

ORDER = 5  # words of an edge; nodes have one less
LEAST_COUNT = 100
COVER_PERCENT = 100
TOP = 2000
CHARS = 1 << 22
BITS = 1 << 26  # places in the table of frequent words: 8 MB at any size of the corpus
POSITIONS = 1 << 20  # keys made at a time
RANGE_KEYS = 1 << 18
RANGES = 1 << 16  # bounds sent to the tasks: 512 KB at any size of the corpus
SAMPLED = 10_000  # words a range in the sample that evens out the ranges
_BITMAP = 4096 * 8  # bits of one of Spark's bitmaps
_GROUPS = 64  # shares in which a language's best phrases are found side by side


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(name("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(name("text").cast("string"), F.lit("")).alias("text"))


def _tokens(langs: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Distinct words; per word occurrence its index, its piece and its language's index; the languages.

    Only A to Z are lowered. Full stops stand for all marks that end a piece, as no word holds one.
    """
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), r"[.,;:!?\x0A-\x0D]+", " . ")
    lists = pc.ascii_split_whitespace(marked)
    words, doc = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    mark = pc.equal(words, ".").to_numpy(zero_copy_only=False)
    new = mark.copy()
    new[1:] |= doc[1:] != doc[:-1]
    piece = np.cumsum(new)
    use = ~mark & pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    coded = words.filter(pa.array(use)).dictionary_encode()
    lang = langs.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), piece[use], lang.indices.to_numpy()[doc[use]], lang.dictionary.to_pylist()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in batches:
        texts = batch.column(1)
        for lo, hi in ranges(pc.binary_length(texts).to_pylist(), CHARS):
            yield batch.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, count) of all words, those at the ends of pieces included. NULL languages are ``und``, NULL texts empty."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _slices(batches):
            words, index, _, lang, names = _tokens(langs, texts)
            both, counts = np.unique(lang.astype(np.int64) * max(len(words), 1) + index, return_counts=True)
            of, word = np.divmod(both, max(len(words), 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()).take(pa.array(of)), words.take(pa.array(word)), pa.array(counts)], names=["lang", "word", "count"])

    rows = _texts(docs).mapInArrow(counted, "lang string, word string, count long")
    return rows.groupBy("lang", "word").agg(F.sum("count").alias("count"))


def _head(lang: str, word: str) -> str:
    """First token of a key: no other language or word gives the same, and it holds no blank."""
    return f"{word}\n{lang.encode().hex()}"


def frequent_bits(words: DataFrame) -> bytes:
    """A bit for every checksum of a language's word; those of the given words are set. Its size does not depend on their number."""
    place = F.crc32(F.concat("word", F.lit("\n"), F.lower(F.hex(F.col("lang").cast("binary")))).cast("binary")) % BITS + 1  # bitmaps count from 1
    maps = words.select(place.alias("p")).groupBy((F.bitmap_bucket_number("p") - 1).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    table = np.zeros(BITS // 8, np.uint8)
    for row in maps:
        at = row["block"] * (_BITMAP // 8)
        table[at:at + _BITMAP // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return table.tobytes()


class _Ranges:
    """Ranges of codes of keys, at most ``RANGES`` from a sample, each cut into equal parts where more are wanted.

    A key's code strings together 16 bits of the checksums of its first four
    words. The codes of all keys that begin with a phrase lie side by side, so a phrase
    that begins a third of all keys is spread over a third of the ranges.
    """

    def __init__(self, bounds: list[int], parts: int) -> None:
        self.bounds, self.parts = np.array([0, *bounds, 1 << 63], np.uint64), parts

    def of(self, codes: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.bounds, codes, side="right") - 1
        low, width = self.bounds[place], self.bounds[place + 1] - self.bounds[place]
        part = (codes - low) // np.maximum(width // np.uint64(self.parts), 1).astype(np.uint64)
        return place * self.parts + np.minimum(part.astype(np.int64), self.parts - 1)

    def cut(self, codes: np.ndarray, k: int) -> np.ndarray:
        """Whether keys with the same first k words as those of these codes may lie in several ranges."""
        below = np.uint64((1 << max(63 - 16 * k, 0)) - 1)
        return self.of(codes & ~below) != self.of(codes | below)


def _codes(sums: list[np.ndarray]) -> np.ndarray:
    """Codes from the checksums of the first four words, 63 bits."""
    code = np.zeros(len(sums[0]), np.uint64)
    for k, part in enumerate(sums[:4]):
        shift = 63 - 16 * (k + 1)
        code |= (part & 0xFFFF).astype(np.uint64) << np.uint64(shift) if shift >= 0 else (part & 0xFFFF).astype(np.uint64) >> np.uint64(-shift)
    return code


def _checksums(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))


def _edges(frequent: bytes, order: int) -> Callable[[pa.Array, pa.Array], Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]]:
    """Keys with their weights and codes in ascending order of codes, for some texts at a time."""
    bits = np.frombuffer(frequent, np.uint8)

    def of(langs: pa.Array, texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        words, index, piece, lang, names = _tokens(langs, texts)
        both, pair = np.unique(lang.astype(np.int64) * max(len(words), 1) + index, return_inverse=True)
        language, word = np.divmod(both, max(len(words), 1))
        heads = [_head(names[a], w) for a, w in zip(language, words.take(pa.array(word)).to_pylist())]
        sums = _checksums(heads)
        place = sums % BITS
        use = ((bits[place >> 3] >> (place & 7)) & 1).astype(bool)[pair]
        at, piece = np.flatnonzero(use), piece[use]
        if len(at) < 2:
            return
        follows = np.append((np.diff(at) == 1) & (np.diff(piece) == 0), False)
        firsts, heads, word_sums = np.flatnonzero(follows), pa.array(heads, pa.string()), _checksums(words.to_pylist())
        for low in range(0, len(firsts), POSITIONS):
            step = firsts[low:low + POSITIONS]
            first = pair[at[step]]
            columns, parts, on = [heads.take(pa.array(first))], [sums[first]], np.ones(len(step), bool)
            for k in range(1, order):
                on = on & follows[np.minimum(step + k - 1, len(at) - 1)]
                spot = index[at[np.minimum(step + k, len(at) - 1)]]
                columns.append(words.take(pa.array(spot, mask=~on)))
                parts.append(np.where(on, word_sums[spot], 0))
            keys = pc.binary_join_element_wise(*columns, " ", null_handling="skip").dictionary_encode()
            which = keys.indices.to_numpy()
            seen = np.empty(len(keys.dictionary), np.int64)
            seen[which[::-1]] = np.arange(len(which))[::-1]
            codes = _codes([p[seen] for p in parts])
            sort = np.argsort(codes)
            yield keys.dictionary.take(pa.array(sort)), np.bincount(which)[sort], codes[sort]

    return of


def edges(docs: DataFrame, frequent: bytes, words: int, order: int = ORDER) -> tuple[DataFrame, _Ranges]:
    """(range, keys, weights): how often ``order`` words stand in a row, and the shorter ends of pieces; and the ranges.

    A key is the words, with the language after the first. Words without a bit in ``frequent`` cut a
    piece, as no frequent phrase holds them. Every task adds up equal keys and sends those of a
    range in one row. ``words``, about the words of ``docs``, only sets the number of ranges.
    """
    context = docs.sparkSession.sparkContext
    table = context.broadcast(frequent)
    texts = _texts(docs)
    wanted = -(-words // RANGE_KEYS)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _edges(table.value, order)
        for langs, some in _slices(batches):
            for _, _, codes in of(langs, some):
                yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64))], names=["code"])

    bounds: list[int] = []
    if wanted > 1:  # the sample only evens out the ranges
        count = min(wanted, RANGES)
        share = texts if words < SAMPLED * count else texts.sample(SAMPLED * count / words, 7)
        found = share.mapInArrow(sampled, "code long").approxQuantile("code", [i / count for i in range(1, count)], 0.1 / count)
        bounds = sorted({int(x) for x in found if 0 < x < 2**63})
    ranges_ = _Ranges(bounds, max(1, wanted // RANGES))
    shared = context.broadcast(ranges_)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _edges(table.value, order)
        for langs, some in _slices(batches):
            for keys, weights, codes in of(langs, some):
                place = shared.value.of(codes)
                starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                offsets = pa.array(np.append(starts, len(place)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[starts]), pc.binary_join(pa.ListArray.from_arrays(offsets, keys), "  "),
                     pa.ListArray.from_arrays(offsets, pa.array(weights, pa.int32()))], names=["range", "keys", "weights"])

    return texts.mapInArrow(found, "range long, keys string, weights array<int>"), ranges_


def phrase_counts(graph: DataFrame, ranges_: _Ranges, least: int = LEAST_COUNT, order: int = ORDER) -> DataFrame:
    """(lang, phrase, k, a) of all phrases of 2 to ``order`` words that occur ``least`` times.

    The count of a node is the flow out of it, the sum over longer keys that
    begin with it, plus the ends of pieces equal to it. A range holds all keys of
    a phrase unless a bound lies among their codes; only for those phrases parts of
    the count meet in a second step. A task holds one range, some ``RANGE_KEYS`` keys.
    """
    shared = graph.sparkSession.sparkContext.broadcast(ranges_)

    def flows(group: pa.Table) -> pa.Table:
        keys = pc.split_pattern(group.column("keys").combine_chunks(), "  ").flatten()
        weight = group.column("weights").combine_chunks().flatten().to_numpy().astype(np.int64)
        lists = pc.split_pattern(keys, " ")
        start, coded = lists.offsets.to_numpy()[:-1], lists.flatten().dictionary_encode()
        size, ids = pc.list_value_length(lists).to_numpy(), coded.indices.to_numpy().astype(np.int64)
        sums = _checksums(coded.dictionary.to_pylist())
        node, row, code = ids[start], np.arange(len(size)), []
        code.append(sums[node])
        out_keys, out_counts = [], []
        for k in range(2, order + 1):
            long = size[row] >= k  # shorter ends of pieces leave the flow here
            row, node = row[long], node[long]
            if not len(row):
                break
            nxt = ids[start[row] + k - 1]
            code = [c[long] for c in code] + [sums[nxt]]
            _, first, node = np.unique(node * len(sums) + nxt, return_index=True, return_inverse=True)
            flow = np.bincount(node, weights=weight[row]).astype(np.int64)
            keep = flow >= least
            if k < 4:
                keep |= shared.value.cut(_codes([c[first] for c in code]), k)
            keep = np.flatnonzero(keep)
            out_keys += [" ".join(key.split(" ")[:k]) for key in keys.take(pa.array(row[first[keep]])).to_pylist()]
            out_counts += flow[keep].tolist()
        return pa.table({"key": pa.array(out_keys, pa.string()), "a": pa.array(out_counts, pa.int64())})

    total = graph.groupBy("range").applyInArrow(flows, "key string, a long").groupBy("key").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    head = F.substring_index("key", " ", 1)
    word = F.substring_index(head, "\n", 1)
    rest = F.expr("substring(key, length(substring_index(key, ' ', 1)) + 1)")
    return total.select(
        F.unhex(F.substring_index(head, "\n", -1)).cast("string").alias("lang"), F.concat(word, rest).alias("phrase"),
        F.size(F.split(rest, " ")).alias("k"), "a")


def _first(phrase: str, k) -> F.Column:
    return F.array_join(F.slice(F.split(phrase, " "), 1, k), " ")


def compacted(phrases: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """``phrases`` without those whose flow passes undivided through a longer one.

    A phrase with a single way on (or back) is an inner part of a unary path and
    merges into the phrase one word longer. As a longer phrase is never more
    frequent than the ones between, looking one word further finds all.
    """
    words = F.split("phrase", " ")
    inner = F.array(F.array_join(F.slice(words, 1, F.col("k") - 1), " "), F.array_join(F.slice(words, 2, F.col("k") - 1), " "))
    longest = phrases.where("k > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("through")).groupBy(
        "lang", "phrase").agg(F.max("through").alias("through"))
    return phrases.join(longest, ["lang", "phrase"], "left").where(
        f"through is null or 100 * through < {percent} * a").drop("through")


def unary_paths(phrases: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, phrase, words, a): the edges of ``order`` words, chained where a node has one way in and one out of its whole flow.

    Every edge doubles its jump towards the head of its path until all have arrived, so the
    rounds grow with the logarithm of the longest path. A path of any length is a
    passage that always occurs as a whole. Phrases may be of any number; none gives none.
    """
    longest = phrases.where(F.col("k") == order).select("lang", "phrase", "a")
    nodes = phrases.where(F.col("k") == order - 1).select("lang", F.col("phrase").alias("node"), F.col("a").alias("flow"))
    words = F.split("phrase", " ")
    ends = longest.select("lang", "phrase", "a", F.array_join(F.slice(words, 1, order - 1), " ").alias("tail"),
                          F.array_join(F.slice(words, 2, order - 1), " ").alias("node"))
    into = ends.select("lang", "node", F.col("phrase").alias("before"), "a")
    out = ends.select("lang", F.col("tail").alias("node"), "phrase", "a")
    # Where an edge carries a node's whole flow there is no other edge on that side.
    links = nodes.join(into, ["lang", "node"]).where("a = flow").drop("a").join(out, ["lang", "node"]).where("a = flow")
    state = stage(longest.join(links.select("lang", "phrase", "before"), ["lang", "phrase"], "left").select(
        "lang", "phrase", "a", F.coalesce("before", "phrase").alias("head"), F.col("before").isNotNull().cast("int").alias("steps")), "paths")
    while True:
        to = state.select("lang", F.col("phrase").alias("head"), F.col("head").alias("further"), F.col("steps").alias("more"))
        state = stage(state.join(to, ["lang", "head"]).select(
            "lang", "phrase", "a", F.col("further").alias("head"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved")), "paths")
        if state.where("moved").isEmpty():
            break
    last = F.struct("steps", F.element_at(words, -1).alias("word"))
    tails = F.transform(F.slice(F.array_sort(F.collect_list(last)), 2, F.count(F.lit(1)).cast("int")), lambda x: x["word"])
    return state.groupBy("lang", "head").agg(tails.alias("tails"), F.max("a").alias("a")).select(
        "lang", F.array_join(F.concat(F.array("head"), "tails"), " ").alias("phrase"), (F.size("tails") + order).alias("words"), "a")


def scored(phrases: DataFrame, words: DataFrame, candidates: DataFrame) -> DataFrame:
    """``candidates`` with l, r and score of their lowest-scoring cut, and n of their language. All arithmetic is exact."""
    n = words.groupBy("lang").agg(F.sum("count").alias("n"))
    counts = phrases.select("lang", "phrase", "a").unionByName(words.select("lang", F.col("word").alias("phrase"), F.col("count").alias("a")))
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "k").select(
        "lang", "phrase", "a", "cut", _first("phrase", F.col("cut")).alias("first"),
        F.array_join(F.slice(F.split("phrase", " "), F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"]).join(
        counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]).join(n, "lang")
    big = {c: f"cast({c} as decimal(19, 0))" for c in "anlr"}
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {big['a']} * {big['n']}) div ({big['l']} * {big['r']})")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r", "n", "a")).alias("x")
    return cuts.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, percent: int = COVER_PERCENT, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of 2 to 5 words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lowered (A to Z), cut into pieces at . , ; : ! ? and line ends, and
    into words at blanks and tabs. A phrase occurs inside pieces, overlaps counted. Its score is
    floor(1000 a n / (l r)) for the cut with the least score, the earliest of equal ones.
    Phrases inside a longer one of equal count (``percent`` of it) are left out. Ties
    go to the more frequent, then to the smaller phrase in byte order.

    A NULL language is ``und``; NULL and empty texts have no words; repeated rows count
    as often as they occur; an empty table gives no rows. Other columns, whatever
    their names, are not looked at. Very long texts are read whole, in one task each.
    """
    words = stage(word_counts(docs), "words")
    frequent = words.where(F.col("count") >= least)
    total = words.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    phrases = stage(phrase_counts(*edges(docs, frequent_bits(frequent), total), least), "phrases")
    rows = scored(phrases, words, compacted(phrases, percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(_GROUPS))
    best = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).where(F.col("place") <= top)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
