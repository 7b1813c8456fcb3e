"""Quality classifier: subword embeddings averaged per document, softmax output, NumPy gradient descent."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import checksum, id_and_text, name, slices
from offerlens.llm.words import U, code_points, mix, powers, worker_state

BUCKETS = 1 << 16
DIMENSIONS = 8
LENGTHS = (2, 3, 4)  # characters of a word's n-grams, its ends marked by a blank
PER_CLASS = 3000  # labelled documents of each class in the fitted sample, about
SEED = 29
_BASE = U(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class QualityModel:
    """Log-odds of label 1 per feature bucket (embedding times output weights), and the intercept."""

    table: np.ndarray
    intercept: float


def features(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Feature buckets of several texts by kind, and per kind the texts' limits.

    Words are runs of characters other than white space, case kept. A text's
    features are its words and the n-grams of its words' characters; a word
    that repeats the one before it is one and the same feature for all words.
    """
    state = worker_state()
    if "space" not in state:
        state["space"] = np.fromiter((chr(i).isspace() for i in range(0x110000)), bool, 0x110000)
    joined = " " + " ".join(t + " " for t in texts) + " " * max(LENGTHS)
    points = code_points(joined)
    space = state["space"][points]
    points = np.where(space, 32, points).astype(U)
    limits = np.concatenate(([1], 1 + np.cumsum([len(t) + 2 for t in texts])))
    buckets, ends = [], []
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    total = np.concatenate((np.zeros(1, U), np.cumsum(mix(points) * powers(_BASE, len(points), "quality"))))
    inverse = powers(U(pow(int(_BASE), -1, 1 << 64)), len(points), "quality-inverse")
    words = mix((total[end] - total[start]) * inverse[start])
    ends.append(np.searchsorted(start, limits))
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[np.minimum(ends[0][:-1], len(words) - 1) if len(words) else []] = False  # the word before is another text's
    buckets.append((np.where(again, U(0), words) & U(BUCKETS - 1)).astype(np.int32))
    run = np.zeros(len(points), U)
    inner = np.cumsum(space)
    size = len(points)
    for j in range(max(LENGTHS)):
        run[:size - j] = run[:size - j] * U(0x100000001B3) + points[j:]
        if j + 1 in LENGTHS:
            # no blank between the first and the last character, and not both of two
            whole = np.zeros(size, bool)
            whole[:size - j] = (inner[j - 1:size - 1] == inner[:size - j]) if j > 1 else ~(space[:-1] & space[1:])
            at = np.flatnonzero(whole)
            buckets.append((mix(run[at] + U(j)) & U(BUCKETS - 1)).astype(np.int32))
            ends.append(np.searchsorted(at, limits))
    return buckets, ends


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, share = [], []
        for text in batch.column("text").to_pylist():
            buckets, _ = features([text])
            counts = np.bincount(np.concatenate(buckets), minlength=BUCKETS)
            at.append(np.flatnonzero(counts).astype(np.int32))
            share.append((counts[at[-1]] / max(1, counts.sum())).astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(at, pa.list_(pa.int32())),
                                          pa.array(share, pa.list_(pa.float32()))], ["label", "at", "share"])


def descend(rows: list[tuple[int, np.ndarray, np.ndarray]], weight: np.ndarray, epochs: int = 8, rate: float = 0.2,
            seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stochastic gradient descent: (embeddings, output weights, output intercepts) for two classes.

    ``weight`` is a class's weight in the loss. The rate falls linearly to zero.
    """
    draw = np.random.default_rng(seed)
    embedding = draw.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    output, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            label, at, share = rows[k]
            hidden = share @ embedding[at]
            score = hidden @ output + bias
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1.0
            p *= rate * (1 - done / steps) * weight[label]
            back = output @ p
            output -= np.outer(hidden, p)
            bias -= 0.1 * p
            embedding[at] -= (share * min(len(at), 200))[:, None] * back[None, :]
            done += 1
    return embedding, output, bias


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = SEED) -> QualityModel:
    """Fit on ``labels`` (doc_id, label 0 or 1; one row per id) and the texts of ``docs``; NULL texts are left out.

    The sample has about ``per_class`` labels of each class (all, where
    there are fewer), chosen by a seeded hash of the id, and one text of each id, the one with the smallest hash. That bounds what is
    broadcast to find the texts, whose sparse feature counts, of ``BUCKETS``
    entries at most, reach the driver. Classes weigh in the loss as they do in
    the table. Without labels of both classes the score leans fully to the only
    one, and is a half without any.
    """
    rows = labels.dropna().where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        share = 0.5 if not counts else 0.999 if 1 in counts else 0.001
        return QualityModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_class / n))])
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = F.broadcast(rows.where(draw < F.element_at(shares, F.col("label"))))
    # An id of many rows gives one text, so the rows are bounded as the labels are.
    found = id_and_text(docs).where("text is not null").join(sample, "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    sample = (found.select("text", "label")
              .mapInArrow(_counts, "label int, at array<int>, share array<float>").toArrow())
    data = [(k.as_py(), a.values.to_numpy(), np.asarray(s.values.to_numpy(), float))
            for k, a, s in zip(sample["label"], sample["at"], sample["share"])]
    data.sort(key=lambda row: (row[0], len(row[1]), row[1].sum()))
    taken = np.bincount([k for k, _, _ in data], minlength=2)
    if not len(data):
        return QualityModel(np.zeros(BUCKETS, np.float32), 0.0)
    weight = np.array([counts[k] / max(1, taken[k]) for k in (0, 1)], float)
    embedding, output, bias = descend(data, weight / (weight @ taken) * taken.sum(), seed=seed)
    return QualityModel((embedding @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def scores(model: QualityModel, texts: list[str]) -> np.ndarray:
    """Probability of label 1 for every whole text; the intercept's for a text without a word."""
    out = np.empty(len(texts))
    for lo, hi in slices(texts, 1 << 19):
        buckets, ends = features(texts[lo:hi])
        total, n = np.zeros(hi - lo), np.zeros(hi - lo)
        for b, e in zip(buckets, ends):
            sums = np.concatenate(([0.0], np.cumsum(model.table[b], dtype=np.float64)))
            total += sums[e[1:]] - sums[e[:-1]]
            n += np.diff(e)
        out[lo:hi] = total / np.maximum(n, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(out + model.intercept, -500, 500)))


def predict(docs: DataFrame, model: QualityModel, least: float = 0.7) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 from ``least`` on). A NULL text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scores(model, [t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = id_and_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out of learning: crc32 of its id as text leaves 2 modulo 4; never for a NULL id."""
    return F.coalesce(checksum(doc_id, 4) == 2, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of labels that may be learned from; ids with conflicting labels are left out."""
    rows = labels.select(name("doc_id").cast("long").alias("doc_id"), name("quality").cast("int").alias("label")).dropna()
    return rows.where(checksum(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").drop("high")
