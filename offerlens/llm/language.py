"""Language identification: sparse multinomial regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import checksum, name, ranges, slices
from offerlens.llm.words import U, code_points, mix, worker_state

HAS_LETTER = r"\p{L}"
UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SCALE = 30.0  # brings relative frequencies to the size the learning rate expects
PER_LANGUAGE = 1200  # documents per language in the fitted sample, about
SEED = 17
LEAST_CHARS = 2048  # what a short text counts in a slice of texts, as it takes a row of bucket flags


@dataclass(frozen=True)
class LanguageModel:
    """Weights per n-gram bucket and language with TF-IDF folded in, intercepts, and the temperature."""

    languages: tuple[str, ...]
    weights: np.ndarray
    intercepts: np.ndarray
    temperature: float


def ngram_buckets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per n-gram order the bucket at every character of the joined texts, and the texts' limits.

    Letters count in lower case; everything else is a space. Texts are
    parted by spaces, so no n-gram holds letters of two texts.
    """
    state = worker_state()
    if "letter" not in state:
        state["letter"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    gap = " " * max(ORDERS)
    lowered = [t.lower() + gap for t in texts]
    points = code_points("".join(lowered))
    points = np.where(state["letter"][points], points, 32).astype(U)
    limits = np.concatenate(([0], np.cumsum([len(t) for t in lowered])))
    out = []
    run = np.zeros(len(points), U)
    for j in range(max(ORDERS)):
        run[:len(points) - j] = run[:len(points) - j] * U(0x100000001B3) + points[j:]
        if j + 1 in ORDERS:
            out.append((mix(run + U(j)) & U(BUCKETS - 1)).astype(np.int32))
    return out, limits


def _documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition: number of documents in which each bucket occurs, and of documents."""
    seen = np.zeros(BUCKETS, np.int64)
    n = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy() + LEAST_CHARS
        for lo, hi in ranges(sizes.tolist(), 1 << 18):
            orders, limits = ngram_buckets(batch.column("text").slice(lo, hi - lo).to_pylist())
            owner = np.repeat(np.arange(hi - lo) * BUCKETS, np.diff(limits))
            present = np.zeros((hi - lo) * BUCKETS, bool)
            for buckets in orders:
                present[owner + buckets] = True
            seen += present.reshape(hi - lo, BUCKETS).sum(axis=0, dtype=np.int32)
            n += hi - lo
    if n:
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], at))), pa.array(np.concatenate(([n], seen[at])))],
                                         ["bucket", "n"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse relative n-gram frequencies of labelled documents."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        at, frequency = [], []
        for text in texts:
            orders, _ = ngram_buckets([text])
            counts = np.bincount(np.concatenate(orders), minlength=BUCKETS)
            at.append(np.flatnonzero(counts).astype(np.int32))
            frequency.append((counts[at[-1]] / counts.sum()).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("held"), pa.array(at, pa.list_(pa.int32())),
             pa.array(frequency, pa.list_(pa.float32()))], ["lang", "held", "at", "frequency"])


def follow_the_regularised_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = 4,
                                  rate: float = 0.3, l1: float = 0.02, l2: float = 0.01,
                                  seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net: (weights per bucket and class, intercepts).

    Every weight follows from its accumulated shifted gradient z and squared
    gradients n: zero while |z| is within the L1 bound, else the closed form
    with a step per coordinate. The last bucket is the intercept, unpenalised.
    """
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def solved(at: np.ndarray) -> np.ndarray:
        bound = np.where(at == BUCKETS, 0.0, l1)[:, None]
        part = z[at]
        return -np.where(np.abs(part) > bound, part - np.sign(part) * bound, 0.0) / ((1.0 + np.sqrt(n[at])) / rate + l2)

    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            label, at, value = rows[k]
            at, value = np.append(at, BUCKETS), np.append(value, 1.0)
            w = solved(at)
            score = value @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1.0
            gradient = value[:, None] * p[None, :]
            squared = gradient ** 2
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) * rate ** -1 * w
            n[at] += squared
    every = solved(np.arange(BUCKETS + 1))
    return every[:-1], every[-1]


def calibrated(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature with the least log loss on held documents, on a grid from 0.05 to 20."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 61))

    def loss(temperature: float) -> float:
        s = scores / temperature
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]).mean())

    return float(min(grid, key=loss))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, seed: int = SEED) -> LanguageModel:
    """Fit on ``labelled`` (text, lang). Rows without a label or a letter are left out.

    Document frequencies count every row. Weights are fitted on a sample of
    about ``per_language`` different texts of each language (all, where there are
    fewer), chosen by a seeded hash of the text, each once however often it is repeated; a fifth of it sets the
    temperature. That sample is all that reaches the driver, as sparse vectors
    of at most ``BUCKETS`` entries. No labelled row gives a model without languages.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER)).select("text", "lang")
    texts = rows.select("lang", F.xxhash64("text").alias("t")).distinct()
    counts = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    frequency = rows.select("text").mapInArrow(_documents_with, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen = {r["bucket"]: r["n"] for r in frequency.collect()}
    total = seen.pop(-1)
    idf = np.full(BUCKETS, np.log(1.0 + total))
    idf[list(seen)] = np.log((1.0 + total) / (1.0 + np.array(list(seen.values()))))
    share = rows.sparkSession.createDataFrame([(k, min(1.0, per_language / n)) for k, n in counts.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1 << 40)) / float(1 << 40)
    sample = (rows.join(F.broadcast(share), "lang").withColumn("draw", draw).where("draw < share")
              .dropDuplicates(["lang", "text"]).select("lang", "text", (F.pmod(F.xxhash64(F.lit(seed + 1), "text"), F.lit(5)) == 0).alias("held"))
              .mapInArrow(_frequencies, "lang string, held boolean, at array<int>, frequency array<float>").toArrow())
    place = {k: i for i, k in enumerate(languages)}
    values = [np.asarray(f.values.to_numpy(), float) * idf[a.values.to_numpy()] * SCALE
              for a, f in zip(sample["at"], sample["frequency"])]
    data = [(place[k.as_py()], a.values.to_numpy(), v) for k, a, v in zip(sample["lang"], sample["at"], values)]
    held = sample["held"].to_numpy()
    order = sorted(range(len(data)), key=lambda i: (data[i][0], len(data[i][1]), data[i][2].sum()))
    weights, intercepts = follow_the_regularised_leader([data[i] for i in order if not held[i]] or data, len(languages), seed=seed)
    kept = [data[i] for i in order if held[i]]
    scores = np.array([v @ weights[a] + intercepts for _, a, v in kept]).reshape(len(kept), len(languages))
    temperature = calibrated(scores, np.array([k for k, _, _ in kept], int))
    return LanguageModel(languages, (weights * idf[:, None] * SCALE).astype(np.float32), intercepts, temperature)


def probabilities(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Calibrated probability of every language for every text, read off the whole text."""
    out = np.empty((len(texts), len(model.languages)))
    for lo, hi in slices(texts, 1 << 18):
        orders, limits = ngram_buckets(texts[lo:hi])
        total = sum(np.add.reduceat(model.weights[b], limits[:-1], axis=0, dtype=np.float64) for b in orders)
        score = total / (len(ORDERS) * np.diff(limits))[:, None] + model.intercepts
        score = score / model.temperature
        p = np.exp(score - score.max(axis=1, keepdims=True))
        out[lo:hi] = p / p.sum(axis=1, keepdims=True)
    return out


def predict(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, in place of columns of these names.

    A NULL text, one without a letter, or a model without languages gives
    ``und`` with score 0. The row order and all other columns stay.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    plain = [f"_c{i}" for i in range(len(kept))]  # Arrow functions take no dots in names
    lowered = [c.lower() for c in kept]
    own = text_column.lower() not in lowered  # the text has one of the two names and travels beside the kept columns
    at = len(kept) if own else lowered.index(text_column.lower())
    extra = [name(text_column).alias("_text")] if own else []
    known = F.coalesce(name(text_column).rlike(HAS_LETTER), F.lit(False)).alias("_known")
    source = docs.select(*[name(c).alias(p) for c, p in zip(kept, plain)], *extra, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            rows = np.flatnonzero(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)) if model.languages else []
            texts = batch.column(at) if len(rows) == batch.num_rows else batch.column(at).take(pa.array(rows, pa.int64()))
            for lo, hi in ranges(pc.binary_length(texts).to_pylist(), 1 << 20):
                p = probabilities(model, texts.slice(lo, hi - lo).to_pylist())
                scores[rows[lo:hi]], languages[rows[lo:hi]] = p.max(axis=1), p.argmax(axis=1)
            found = pa.array([*model.languages, UNKNOWN], pa.string()).take(pa.array(languages))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], found, pa.array(scores)], names=[*batch.schema.names[:len(kept)], "lang_pred", "score"])

    schema = source.select(*plain).schema.add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(run, schema).select(*[name(p).alias(c) for c, p in zip(kept, plain)], "lang_pred", "score")


def accepted(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` in a learned language with a probability of ``least`` or more, columns unchanged.

    Texts without a letter go; with a model that knows no language everything
    goes but for an empty table. A column named lang_pred or score stays as it is.
    """
    names = [f"_k{i}" for i in range(len(docs.columns))]
    renamed = docs.select(*[name(c).alias(n) for c, n in zip(docs.columns, names)])
    text = names[[c.lower() for c in docs.columns].index("text")]
    found = predict(renamed, model, text).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[name(n).alias(c) for c, n in zip(docs.columns, names)])


def held_out(doc_id: str = "doc_id"):
    """Whether a document is held out of learning: crc32 of its id as text leaves 1 modulo 3; never for a NULL id."""
    return F.coalesce(checksum(name(doc_id), 3) == 1, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """Text and label of documents that may be learned from; a NULL id may not."""
    return docs.where(checksum(name("doc_id"), 3) != 1).select(name("text").alias("text"), name("lang").alias("lang"))
