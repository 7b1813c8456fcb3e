"""Periodic runs: stretches of words that repeat a short block four times or more."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import id_and_text, ranges

LEAST_REPEATS = 4
LEAST_WORDS = 6
CHARS = 1 << 22
SCHEMA = "doc_id long, words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, number of words, its runs by start and period, and the text without the repeats.

    Words are maximal stretches without blanks, tabs and line ends, numbered
    from 0. A run has a smallest period q, max(6, 4 q) words at least, and
    neither neighbouring word continues it. ``collapsed`` keeps all words but
    those that some run contains after its first q words, joined by one blank.

    A NULL or empty text has no words, no runs and an empty ``collapsed``. Every
    row gives a row, repeated and NULL ids too; an empty table gives none.
    Other columns of ``docs``, whatever their names, are not looked at. A
    document is the work of one task; a stretch of it in which all words recur
    takes some 600 bytes of memory a word, the rest of a very long text 30.
    """
    return id_and_text(docs).mapInArrow(_of_batches, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. NULL without runs."""
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run and its exponent in thousandths, and hashes of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def _of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for lo, hi in ranges(sizes.tolist(), CHARS):
            yield _of_slice(batch.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo))


def _of_slice(doc_ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    n = len(texts)
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, doc = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    filled = pc.greater(pc.binary_length(words), 0)
    words, doc = words.filter(filled), doc[filled.to_numpy(zero_copy_only=False)]
    first = np.searchsorted(doc, np.arange(n + 1))
    ids = words.dictionary_encode().indices.to_numpy()
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    kept = np.ones(len(ids), bool)
    for lo, hi in recurring(ids, doc):
        owner, base = doc[lo], lo - first[doc[lo]]
        for start, length, period in runs_of(ids[lo:hi].tolist()):
            found[owner].append((int(base + start), length, period))
            kept[lo + start + period:lo + start + length] = False
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc[kept], minlength=n))))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pa.array(kept))), " ")
    runs = [[dict(zip(("start", "length", "period"), r)) for r in sorted(of, key=lambda r: (r[0], r[2]))] for of in found]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(np.diff(first)), pa.array(runs, pa.list_(run)), collapsed],
        names=["doc_id", "words", "runs", "collapsed"])


def recurring(ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that hold every run: in each, every word occurs at least four times.

    Every word of a run occurs four times in it, so words that are rarer cut
    their stretch, and again within the pieces. The automaton is exact on any
    text, so the cutting may stop when it no longer pays.
    """
    at = np.arange(len(ids))
    while len(at):
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(doc[at]) != 0)
        piece = np.cumsum(new) - 1
        _, word, counts = np.unique(piece * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
        keep = (counts[word] >= LEAST_REPEATS) & (np.bincount(piece)[piece] >= LEAST_WORDS)
        gone = len(at) - int(keep.sum())
        if gone * 32 <= len(at):
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(at))
            return [(int(at[s]), int(at[e - 1]) + 1) for s, e in zip(starts, ends) if e - s >= LEAST_WORDS]
        at = at[keep]
    return []


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, greatest lengths, and the state of every prefix."""
    link, longest, moves = [-1], [0], [{}]
    states = []
    last = 0
    for w in words:
        state = len(link)
        link.append(0)
        longest.append(longest[last] + 1)
        moves.append({})
        p = last
        while p >= 0 and w not in moves[p]:
            moves[p][w] = state
            p = link[p]
        if p >= 0:
            q = moves[p][w]
            if longest[p] + 1 < longest[q]:
                clone = len(link)
                link.append(link[q])
                longest.append(longest[p] + 1)
                moves.append(moves[q].copy())
                while p >= 0 and moves[p].get(w) == q:
                    moves[p][w] = clone
                    p = link[p]
                link[q] = clone
                q = clone
            link[state] = q
        states.append(state)
        last = state
    return link, longest, states


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one sequence.

    The states on the way from a prefix's state to the root stand for its
    suffixes. The tree of suffix links is kept as link-cut trees whose
    preferred paths hold states that occurred last at the same place. The
    access of prefix e recolours its way to e; each path it meets names the
    last end e - d of suffixes of up to L words. Where d <= L they overlap or
    touch: a square of period d, and the words from e - d - L + 1 to e have this period
    and no longer stretch to the left has it. No smaller period can hold, as
    suffixes would have occurred later than e - d. While the run goes on, every further
    prefix meets it again, so the last one gives its end.
    """
    link, longest, states = suffix_automaton(words)
    # Vertices are states + 1, so that 0 means none. ``up`` is the parent in a path's splay tree or,
    # at its root, the vertex above the path. A path's colour stands at the root of its splay tree.
    up = [0] + [p + 1 for p in link]
    left, right = [0] * len(up), [0] * len(up)
    ends = [-1] * len(up)

    def splay(x: int) -> None:
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                grand = up[z]
                inner = bool(grand) and (left[grand] == z or right[grand] == z)
                if not inner:
                    ends[x] = ends[z]
                if (left[z] == y) == (left[y] == x):
                    turn(y)
                turn(x)
            else:
                ends[x] = ends[y]
                turn(x)
                return

    def turn(x: int) -> None:
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            up[inner] = y
        up[y] = x
        up[x] = z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    spans: dict[tuple[int, int], int] = {}
    for e, state in enumerate(states):
        below, x = 0, state + 1
        while x:
            splay(x)
            end = ends[x]
            if end >= 0:
                period, length = e - end, longest[x - 1]
                stretch = period + length
                if stretch >= LEAST_WORDS and stretch >= LEAST_REPEATS * period:
                    spans[e - stretch + 1, period] = e
            cut = right[x]
            if cut:
                ends[cut] = end  # the deeper states keep their place
            right[x] = below
            below, x = x, up[x]
        splay(state + 1)
        ends[state + 1] = e
    return [(start, end - start + 1, period) for (start, period), end in spans.items()]
