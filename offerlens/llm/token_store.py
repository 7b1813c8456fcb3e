"""Token ids in Parquet list columns: ordered, with running offsets, for selective reads."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm.common import id_and_text, slices
from offerlens.llm.words import U, mix, worker_state
from offerlens.session import stage

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
CACHED = 500_000  # words a worker remembers before those not met again since are forgotten
END = 2

# A blank or line feed between two characters that are not white space starts a piece of its own in
# the tokenizer's split, so the parts around it are encoded alike alone and together. A part that
# begins without a blank is marked.
_BARE = "\x01"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = r"[!-&(-/:-@\[-^`{-~]"  # ASCII punctuation without the apostrophe, which may begin a contraction
_STOP = re.compile(rf"{_MARKS}(?<=[^\W\d_].){_MARKS}*(?=[ \n]|\Z)")  # punctuation after a letter, up to the end of a word
_SPACE = "[" + "".join(rf"\x{{{i:x}}}" for i in range(0x110000) if chr(i).isspace()) + "]"
_ODD = rf"\A\x01?(?:\z|{_SPACE})|{_SPACE}\z"  # a part that is empty or touches other white space
_PLACES = 256  # of a part's bytes, which have scrambled codes of their own


def _tokenizer(path: str) -> dict:
    """The worker's tokenizer, the strings of its added tokens, the ids that begin with a blank, and the words it remembers:
    their strings, their ids in a row, the limits of these, whether a word was met again, their hashes in order and whose these are."""
    state = worker_state()
    if path not in state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        blank = np.zeros(1 + max(tokenizer.get_vocab().values()), bool)
        blank[[i for token, i in tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        state[path] = {"tokenizer": tokenizer, "added": added, "blank": blank, "words": pa.array([], pa.large_string()),
                       "ids": np.zeros(0, "<i4"), "limit": np.zeros(1, np.int64), "met": np.zeros(0, bool),
                       "hash": np.zeros(0, U), "whose": np.zeros(0, np.int64)}
    return state[path]


def _ids(tokenizer, texts: list[str]) -> list[bytes]:
    return [array("i", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _ids_by_default(tokenizer, texts: list[str]) -> list[bytes]:
    """Ids of texts by the library's default, which takes the string of a special token as that token."""
    tokenizer.encode_special_tokens = False
    try:
        return _ids(tokenizer, texts)
    finally:
        tokenizer.encode_special_tokens = True


def _ids_of_words(tokenizer, blank: np.ndarray, words: list[str], at_once: int = 2000) -> list[bytes]:
    """Ids of words with a blank before each: encoded in a row and cut where an id begins with a blank."""
    out = []
    for rows, group in zip(_ids(tokenizer, ["".join([" " + w for w in words[i:i + at_once]]) for i in range(0, len(words), at_once)]),
                           range(0, len(words), at_once)):
        cuts = (np.flatnonzero(blank[np.frombuffer(rows, "<i4")]) * 4).tolist() + [len(rows)]
        assert len(cuts) - 1 == len(words[group:group + at_once])
        out += [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


def _ids_of_bare_words(tokenizer, words: list[str], at_once: int = 2000) -> list[bytes]:
    """Ids of words without a blank: encoded in a row, a line feed between two, and cut at the line feeds."""
    plain, others = [w for w in words if "\n" not in w], [w for w in words if "\n" in w]
    feed = tokenizer.token_to_id("\u010a")
    done = dict(zip(others, _ids(tokenizer, others)))
    groups = [plain[i:i + at_once] for i in range(0, len(plain), at_once)]
    for group, row in zip(groups, _ids(tokenizer, ["\n".join(g) for g in groups])):
        cuts = (np.flatnonzero(np.frombuffer(row, "<i4") == feed) * 4).tolist() + [len(row)]
        assert len(cuts) == len(group)
        done.update((w, row[a:b]) for w, a, b in zip(group, [0] + [c + 4 for c in cuts], cuts))
    return [done[w] for w in words]


def _marked(text: str) -> str:
    """A text with blanks around every line feed and before all punctuation that follows a letter and ends a word, as these are pieces of their own."""
    return _BARE + _STOP.sub(f" {_BARE}\\g<0>", text).replace("\n", f" {_BARE}\n {_BARE}")


def _joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids in a row, limits of the items in them)."""
    return np.frombuffer(b"".join(ids), "<i4"), np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4))


def _taken(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of values, given by their first places and sizes, in a row."""
    end = np.cumsum(size)
    return values[np.repeat(first - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each of some words, from sums of codes of their bytes by place."""
    state = worker_state()
    if "byte_codes" not in state:
        state["byte_codes"] = mix(np.arange(1, 256 * _PLACES + 1, dtype=U))
    limit = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[limit[0]:limit[-1]]
    limit = limit - limit[0]
    at = np.arange(len(data)) - np.repeat(limit[:-1], np.diff(limit))
    total = np.append(U(0), np.cumsum(state["byte_codes"][(at % _PLACES) * 256 + data], dtype=U))
    return mix(total[limit[1:]] - total[limit[:-1]])


def _places(state: dict, names: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """The place of each name among the words remembered, or -1. Hashes only point to a word: the strings decide."""
    place = np.full(len(names), -1, np.int64)
    if len(state["hash"]):
        order = np.argsort(hashes)
        near = np.minimum(np.searchsorted(state["hash"], hashes[order]), len(state["hash"]) - 1)
        same = state["hash"][near] == hashes[order]
        at, found = order[same], state["whose"][near[same]]
        equal = pc.equal(names.take(pa.array(at)), state["words"].take(pa.array(found))).to_numpy(zero_copy_only=False)
        place[at[equal]] = found[equal]
    return place


def _remember(state: dict, fresh: pa.Array, hashes: np.ndarray, spaced: int) -> None:
    """Encode words, of which the first so many have a blank before them and the rest the mark, and keep their ids."""
    words = fresh.to_pylist()
    ids, ends = _joined(_ids_of_words(state["tokenizer"], state["blank"], words[:spaced]) + _ids_of_bare_words(state["tokenizer"], [w[1:] for w in words[spaced:]]))
    order = np.argsort(hashes)
    at = np.searchsorted(state["hash"], hashes[order])
    state["hash"], state["whose"] = np.insert(state["hash"], at, hashes[order]), np.insert(state["whose"], at, len(state["words"]) + order)
    state["words"] = pa.concat_arrays([state["words"], fresh])
    state["ids"], state["limit"] = np.append(state["ids"], ids), np.append(state["limit"], state["limit"][-1] + ends[1:])
    state["met"] = np.append(state["met"], np.zeros(len(fresh), bool))


def _forget(state: dict) -> None:
    """Only words met again since the last time stay."""
    met = state["met"]
    kept = np.flatnonzero(met)
    size = np.diff(state["limit"])[kept]
    state["words"], state["ids"] = state["words"].take(pa.array(kept)), _taken(state["ids"], state["limit"][kept], size)
    state["limit"], state["met"] = np.append(0, np.cumsum(size)), np.zeros(len(kept), bool)
    stay = met[state["whose"]]
    state["hash"], state["whose"] = state["hash"][stay], (np.cumsum(met) - 1)[state["whose"][stay]]


def encode(texts: list[str], tokenizer_path: str, special_as_text: bool = True) -> list[bytes]:
    """Ids of whole texts as little-endian 32-bit numbers, equal to the tokenizer's own for each text."""
    values, limit = encoded(texts, tokenizer_path, special_as_text)
    return [values[a:b].tobytes() for a, b in zip(limit[:-1], limit[1:])]


def encoded(texts: list[str], tokenizer_path: str, special_as_text: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, limits of the texts in them), equal to the tokenizer's own for each text.

    Every distinct word is encoded by the tokenizer once, as long as the
    worker remembers it; a text's ids are those of its words in a row. Words are
    numbered by Arrow, so each distinct one is looked up once in a call. The
    string of a special token is ordinary text, or without ``special_as_text``
    that token, as by the library's default: texts that hold the string of
    an added token then go through the tokenizer whole.
    """
    if not texts:
        return np.zeros(0, "<i4"), np.zeros(1, np.int64)
    state = _tokenizer(tokenizer_path)
    held = [] if special_as_text else [k for k, t in enumerate(texts) if any(a in t for a in state["added"])]
    whole = dict(zip(held, _ids_by_default(state["tokenizer"], [texts[k] for k in held]) if held else ()))
    parts = pc.split_pattern(pa.array([_BARE if k in whole else _marked(t) for k, t in enumerate(texts)], pa.large_string()), " ")
    limit, coded = parts.offsets.to_numpy(), parts.values.dictionary_encode()
    number, names = coded.indices.to_numpy(), coded.dictionary
    hashes = _hashes(names)
    place = _places(state, names, hashes)
    at = np.flatnonzero(place < 0)
    # Parts that are empty or touch other white space: such texts are cut with care, and those parts not remembered.
    # So are texts that hold the mark themselves, as their words could pass for marked parts.
    missing = names.take(pa.array(at))
    odd = pc.and_(pc.match_substring_regex(missing, _ODD), pc.not_equal(missing, _BARE + "\n")).to_numpy(zero_copy_only=False)
    careful = np.fromiter((_BARE in t for t in texts), bool, len(texts))
    careful[held] = True
    if odd.any():
        apart = np.zeros(len(names), bool)
        apart[at[odd]] = True
        careful |= np.logical_or.reduceat(apart[number], limit[:-1])
    passing: list[bytes] = []
    if careful.any():
        cut = {k: [(k,)] if k in whole else [(i > 0, w) for i, w in enumerate(_CUT.split(texts[k]))] for k in np.flatnonzero(careful).tolist()}
        order = {p: len(names) + i for i, p in enumerate(dict.fromkeys(p for row in cut.values() for p in row))}
        single = [p for p in order if len(p) == 2]
        done = dict(zip(single, _ids(state["tokenizer"], [" " + w if later else w for later, w in single])))
        passing = [done[p] if len(p) == 2 else whole[p[0]] for p in order]
        rows = [np.array([order[p] for p in cut[k]]) if k in cut else number[limit[k]:limit[k + 1]] for k in range(len(texts))]
        number, limit = np.concatenate(rows), np.append(0, np.cumsum([len(r) for r in rows]))
        used = np.zeros(len(names) + len(passing), bool)
        used[number] = True
        at = at[used[at]]
    n = len(state["words"])
    state["met"][place[place >= 0]] = True
    bare = pc.starts_with(names.take(pa.array(at)), _BARE).to_numpy(zero_copy_only=False)
    at = np.append(at[~bare], at[bare])
    place[at] = n + np.arange(len(at))
    _remember(state, names.take(pa.array(at)), hashes[at], np.count_nonzero(~bare))
    ids, ends = _joined(passing)
    first = np.append(state["limit"][place], state["limit"][-1] + ends[:-1])
    size = np.append(state["limit"][place + 1] - state["limit"][place], np.diff(ends))[number]
    values = _taken(np.append(state["ids"], ids), first[number], size)
    if n + len(at) > CACHED:
        _forget(state)
    return values, np.append(0, np.cumsum(size))[limit]


def _encoded(tokenizer_path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = 0
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in slices(texts, 1 << 20):
                ids, limit = encoded(texts[lo:hi], tokenizer_path, special_as_text=False)
                offsets = limit + np.arange(hi - lo + 1)
                values = pa.array(np.insert(ids, limit[1:], end), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)),
                     pa.array(before + offsets[:-1]), pa.array(np.diff(offsets)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)],
                    ["doc_id", "part", "before", "n_tokens", "ids"])
                before += int(offsets[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end: int = END, encoding: str = "dictionary",
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Write doc_id, part, before, n_tokens and ids of every document in ascending doc_id order.

    The whole text is encoded (NULL as empty), the strings of special tokens
    as these, and ``end`` appended. Files are
    ranges of doc_id, NULLs first, ties in the order of a text hash; part is
    the file's place and before counts the ids ahead of a document in its
    file. Ids are dictionary-coded, or bit-packed differences with
    ``encoding="delta"``; the other columns are differences. Row groups and
    pages have the given sizes, and the page index lets a reader skip pages
    by doc_id, or read lengths without ids. An empty table writes no rows.
    """
    ordered = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(F.asc("doc_id"), F.asc("tie")).sortWithinPartitions(F.asc("doc_id"), F.asc("tie"))
    rows = ordered.drop("tie").mapInArrow(
        _encoded(tokenizer_path, end), "doc_id long, part int, before long, n_tokens long, ids array<int>")
    (rows.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower())
     .option("parquet.page.row.count.limit", 1000).option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids"),
                low: int | None = None, high: int | None = None) -> DataFrame:
    """Chosen columns of written documents, of ids from ``low`` to ``high``; start is the number of ids before a document.

    Offsets of the files come from their lengths alone, so reading starts or
    lengths never touches the ids.
    """
    schema = "doc_id long, part int, before long, n_tokens long, ids array<int>"
    files = spark.read.schema(schema).parquet(path)
    rows = files
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    if "start" in columns:
        ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        offsets = stage(parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")), "offsets")
        rows = rows.join(offsets, "part").withColumn("start", F.col("ahead") + F.col("before"))
    return rows.select(*columns)


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every written document, from its ids as stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = np.ascontiguousarray(ids.values.to_numpy().astype("<u4", copy=False))
            limits = ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(limits[:-1], limits[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("before"), pa.array(np.diff(limits).astype(np.int64)),
                 pa.array(crc, pa.int64())], ["doc_id", "part", "before", "n_tokens", "ids_crc32"])

    files = spark.read.schema("doc_id long, part int, before long, n_tokens long, ids array<int>").parquet(path)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = stage(parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")), "offsets")
    sums = files.mapInArrow(run, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return sums.join(offsets, "part").select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
