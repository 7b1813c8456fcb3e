"""Runs against a brute-force search by every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from offerlens.llm import queries
from offerlens.llm.runs import digest, periodic_runs, recurring, runs_of


def brute(words):
    found = set()
    for q in range(1, len(words) // 4 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            block = words[start:start + length]
            if length >= max(6, 4 * q) and not any(block[p:] == block[:-p] for p in range(1, q)):
                found.add((start, length, q))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(words):
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    dropped = {i for start, length, q in found for i in range(start + q, start + length)}
    return (len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_of_random_sequences():
    draw = random.Random(5)
    for _ in range(1500):
        letters = draw.choice((1, 2, 2, 3, 4))
        words = [draw.randrange(letters) for _ in range(draw.randint(0, 40))]
        block = [draw.randrange(letters) for _ in range(draw.randint(1, 8))]
        words += (block * 10)[:draw.randint(0, 9 * len(block))] + [draw.randrange(letters) for _ in range(draw.randint(0, 10))]
        assert sorted(runs_of(words), key=lambda r: (r[0], r[2])) == brute(words)
        ids, doc = np.array(words + [9] + words), np.array([0] * len(words) + [1] * (len(words) + 1))
        pieces = [(lo + s, n, q) for lo, hi in recurring(ids, doc) for s, n, q in runs_of(ids[lo:hi].tolist())]
        shift = len(words)
        assert sorted(pieces) == sorted(brute(words) + [(shift + s, n, q) for s, n, q in brute([9] + words)])


def test_query_equals_brute_force(spark, folder, documents):
    texts = {r["doc_id"]: split(r["text"]) for r in documents.collect()}
    rows, runs = queries.op11_runs(spark, folder).collect(), 0
    assert len(rows) == len(texts)
    for row in rows:
        words = texts[row["doc_id"]]
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n <= 3000:
            assert tuple(row)[1:] == expected(words)
            runs += row["n_runs"]
    assert runs


@pytest.mark.parametrize("text", [
    None, "", " \n\t", "ha ha ha ha ha", "ha ha ha ha ha ha", "a b a b a b a b a", "x\x1cy " * 6, " a\x0bb  a\tb\ra b\na b c c c c c c ",
    "no no no no no no yes yes yes yes yes yes", "           ",
])
def test_edges(spark, text):
    row = digest(periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert tuple(row)[1:] == expected(split(text))


def test_ties_go_to_the_earliest_run(spark):
    row = periodic_runs(spark.createDataFrame([(1, "a b " * 4 + "z " + "c d " * 4)], "doc_id long, text string"))
    assert digest(row).first()["start"] == 0 and len(row.first()["runs"]) == 2
    assert row.first()["collapsed"] == "a b z c d"


def test_a_very_long_text(spark):
    words = [f"w{i}" for i in range(5_000)]
    text = " ".join(words * 7 + ["end"] + words[:3] * 20_000)
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == [(0, 35_000, 5_000), (35_001, 60_000, 3)]
    assert row["collapsed"].split() == words + ["end"] + words[:3]


def test_odd_rows(odd_rows, no_rows):
    rows = periodic_runs(odd_rows).collect()
    assert len(rows) == 13 and all(r["collapsed"] is not None and r["runs"] is not None for r in rows)
    assert digest(periodic_runs(no_rows)).collect() == []
