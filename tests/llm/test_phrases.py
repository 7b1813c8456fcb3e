"""Collocations against counts of every phrase, with small batches, many ranges and low limits."""

import random
import re
from collections import Counter

import pytest

from offerlens.llm.phrases import collocations, edges, frequent_bits, phrase_counts, unary_paths, word_counts
from pyspark.sql import functions as F


def _counts(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, least, top=2000, percent=100):
    f, n = _counts(rows)
    found = {c: a for c, a in f.items() if a >= least and len(c[1]) >= 2}
    dropped = {(lang, c[i:i + k]) for (lang, c), a in found.items() for k in range(2, len(c)) for i in range(len(c) - k + 1)
               if 100 * a >= percent * found[lang, c[i:i + k]]}
    out = []
    for lang in n:
        ranked = []
        for (of, c), a in found.items():
            if of == lang and (of, c) not in dropped:
                score, k = min((1000 * a * n[lang] // (f[lang, c[:k]] * f[lang, c[k:]]), k) for k in range(1, len(c)))
                ranked.append((-score, -a, " ".join(c).encode(), f[lang, c[:k]], f[lang, c[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def scattered(spark, monkeypatch):
    """Small batches and many ranges, so that bounds fall among the keys of a phrase."""
    from offerlens.llm import phrases

    monkeypatch.setattr(phrases, "RANGE_KEYS", 300)
    monkeypatch.setattr(phrases, "RANGES", 40)
    monkeypatch.setattr(phrases, "POSITIONS", 50)
    old = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for (key, _), value in zip(old.items(), ("7", "13", "false")):
        spark.conf.set(key, value)
    yield spark
    for key, value in old.items():
        spark.conf.set(key, value)


def test_equals_counts_of_every_phrase(scattered, documents):
    rows = [(r["lang"], r["text"]) for r in documents.collect()]
    assert _rows(collocations(documents, least=12)) == brute(rows, 12)
    assert _rows(collocations(documents, least=8, percent=60, top=40)) == brute(rows, 8, 40, 60)


def test_random_texts(scattered):
    draw = random.Random(3)
    words = ["a", "B", "b", "\x01c", "c\x1f", "é", "É", "x\\n", "|", "\"", "a\x01", "日本"]
    rows = [(draw.choice(["en", "e n", None, "", "und", "de\n"]), "".join(draw.choice(words) + draw.choice([" ", "  ", "\t", ". ", ",", "\r\n", " : ", " ", " "])
             for _ in range(draw.randint(0, 80)))) for _ in range(120)]
    rows += [("en", None), (None, None), ("en", "a b b a é " * 400), ("en", "a b b a é " * 400)]
    df = scattered.createDataFrame(rows, "lang string, text string")
    for least in (2, 5):
        assert _rows(collocations(df, least=least)) == brute(rows, least)


def test_scores_beyond_64_bits(spark):
    rows = [("en", "p q " * 30_000)] * 40
    got = collocations(spark.createDataFrame(rows, "lang string, text string"), least=100)
    assert _rows(got) == brute(rows, 100) and 1000 * got.first()["a"] * got.first()["n"] > 2**40
    big = spark.range(1).select(F.expr("(cast(1000 as decimal(4, 0)) * cast(9000000000000 as decimal(19, 0)) * cast(30000000000007 as decimal(19, 0)))"
                                       " div (cast(9000000000011 as decimal(19, 0)) * cast(9500000000000 as decimal(19, 0)))"))
    assert big.first()[0] == 1000 * 9000000000000 * 30000000000007 // (9000000000011 * 9500000000000)


def test_unary_paths_are_whole_passages(spark):
    passage = [f"w{i}" for i in range(23)]
    rows = [("en", " ".join(passage)), ("en", "x " + " ".join(passage) + " y")] * 4 + [("en", " ".join(passage[:9]))] * 3
    df = spark.createDataFrame(rows, "lang string, text string")
    counts = phrase_counts(*edges(df, frequent_bits(word_counts(df)), 300), 3)
    # Three texts end within the passage, so the path breaks there, as it does at the texts that go on before and after it.
    paths = {r["phrase"]: r["a"] for r in unary_paths(counts).collect()}
    assert paths == {" ".join(passage[:9]): 11, " ".join(passage[5:]): 8, " ".join(["x"] + passage[:4]): 4, " ".join(passage[-4:] + ["y"]): 4}
    assert unary_paths(counts.limit(0)).collect() == []


def test_odd_rows(odd_rows, no_rows):
    assert collocations(no_rows).collect() == []
    got = collocations(odd_rows, least=100).collect()
    assert {(r["phrase"], r["a"]) for r in got if r["lang"] == "en"} <= {("and then", a) for a in range(100, 400)}
    assert [r["rank"] for r in sorted(got, key=lambda r: (r["lang"], r["rank"])) if r["lang"] == "en"] == list(range(1, 1 + sum(r["lang"] == "en" for r in got)))
