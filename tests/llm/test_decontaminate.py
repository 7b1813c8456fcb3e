"""Benchmark overlaps with planted substitutions."""

import random
from itertools import combinations

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from offerlens.llm import decontaminate, sql


def _planted(spark, cases):
    """Documents that hold a part of an item of their own with words substituted: (words of the part, places, words of the item)."""
    docs, items = [], []
    for i, (part, places, size) in enumerate(cases):
        item = [f"i{i}w{j}" for j in range(size)]
        text = [f"other{i}" if j in places else w for j, w in enumerate(item[:part])]
        docs.append((i, " ".join([f"lead{i}", *text, f"trail{i}"])))
        items.append((i, " ".join(item)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def _longest(same, least, similarity=0.8):
    return any(10 * sum(same[a:e]) >= round(10 * similarity) * (e - a) for a in range(len(same)) for e in range(a + least, len(same) + 1))


def test_best_stretch_finds_every_similar_stretch(spark):
    draw = random.Random(5)
    rows = [([draw.random() < p for _ in range(draw.randint(1, 30))], least) for p in (0.6, 0.75, 0.85) for least in (5, 12) for _ in range(150)]
    got = spark.createDataFrame(rows, "same array<boolean>, n int").select(
        "same", "n", decontaminate._best_stretch(F.col("same"), F.col("n"), 0.8).alias("b")).collect()
    assert len(got) == len(rows) and {bool(r.b.words) for r in got} == {True, False}
    for r in got:
        assert bool(r.b.words) == _longest(r.same, r.n)
        if r.b.words:
            part = r.same[r.b.start:r.b.start + r.b.words]
            assert len(part) == r.b.words >= r.n and sum(part) == r.b.matched and 5 * r.b.matched >= 4 * r.b.words


@pytest.mark.parametrize("part, places, size", [(20, (9, 14), 20), (12, (10,), 12), (12, (0,), 40), (14, (2, 12), 14)])
def test_substitutions_near_the_ends_or_each_other_are_tolerated(spark, part, places, size):
    rows = decontaminate.contaminated(*_planted(spark, [(part, places, size)])).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(0, 0)] and rows[0].matched >= 0.8 * rows[0].words >= 0.8 * 12


def _hit(same, mask):
    width, gap = mask
    clean = [all(same[i:i + width]) for i in range(len(same) - width + 1)]
    return any(clean[i] and clean[i + width + gap] for i in range(len(clean) - width - gap))


def test_seeds_hit_every_layout():
    for n in range(1, 2 * decontaminate.LEAST_WORDS):
        changed = n // 5
        for places in combinations(range(n), changed):
            same = [i not in places for i in range(n)]
            assert any(_hit(same, m) for m in decontaminate.masks(n)), (n, places)
    for least, similarity in ((6, 0.7), (9, 0.8), (9, 0.75)):
        for n in range(least, 2 * least):
            for places in combinations(range(n), int(n * (1 - similarity) + 1e-9)):
                assert any(_hit([i not in places for i in range(n)], m) for m in decontaminate.masks(n, least, similarity))


def test_masks_of_long_items_read_six_words_and_ignore_others():
    assert decontaminate.masks(40) == decontaminate.masks(12) == ((3, 0), (3, 3), (3, 6), (3, 9), (3, 12))
    assert decontaminate.masks(1) == ((1, -1),) and decontaminate.masks(4) == ((2, 0),) and decontaminate.masks(8) == ((2, 0), (2, 2))


def _frames(draw, vocabulary, documents, items):
    """Items of 1 to 40 words, and documents half of which hold a part of an item with words substituted."""
    def some(n):
        return [draw.choice(vocabulary) for _ in range(n)]

    known = [some(draw.randint(1, 40)) for _ in range(items)]
    texts = []
    for i in range(documents):
        text = some(draw.randint(0, 80))
        if i % 2:
            item = draw.choice(known)
            start = draw.randint(0, max(0, len(item) - 12))
            part = [w if draw.random() > 0.18 else draw.choice(vocabulary) for w in item[start:start + draw.randint(10, 40)]]
            text[len(text) // 2:len(text) // 2] = part
        texts.append(" ".join(text))
    return texts, [" ".join(w) for w in known]


def _by_hand(text, item):
    """Whether some diagonal has a stretch of 12 words (or a shorter item whole) at 0.8."""
    w, iw = text.split(), item.split()
    least = min(12, len(iw))
    for g in range(-len(iw) + 1, len(w)):
        same = [iw[q] == w[q + g] for q in range(max(0, -g), min(len(iw), len(w) - g))]
        if sum(same) >= 0.8 * least and _longest(same, least):
            return True
    return False


def test_planted_overlaps_equal_sql_and_brute_force(spark, tmp_path):
    draw = random.Random(11)
    texts, known = _frames(draw, [f"w{i}" for i in range(3000)] + ["the", "of", "a"] * 300, 160, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(known)), "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contaminated(docs, items).collect()}
    assert {r[:2] for r in got} == {(d, i) for d, t in enumerate(texts) for i, k in enumerate(known) if _by_hand(t, k)}
    assert len(got) > 40
    con = duckdb.connect()
    for name, rows, key in (("documents", texts, "doc_id"), ("benchmark", known, "item_id")):
        con.register(name, pa.table({key: list(range(len(rows))), "text": rows}))
    assert set(con.execute(sql.decontamination()).fetchall()) == got


def test_common_words_make_few_candidates(spark):
    draw = random.Random(3)
    common = [f"c{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]

    def prose(n):
        return " ".join(draw.choices(common, weights, k=n))

    texts = spark.createDataFrame([(i, prose(200).split()) for i in range(200)], "t long, w array<string>")
    items = spark.createDataFrame([(i, prose(40).split()) for i in range(100)], "item long, w array<string>")
    taken = {m: F.lit(True) for m in decontaminate.masks(40)}
    probes = decontaminate.seeds(items, "w", taken).select("item", "hash")
    pairs = decontaminate.seeds(texts, "w", taken).join(probes, "hash").select("t", "item").distinct().count()
    plain = {(2, 0): F.lit(True)}
    before = decontaminate.seeds(texts, "w", plain).join(decontaminate.seeds(items, "w", plain).select("item", "hash"), "hash")
    assert pairs < before.select("t", "item").distinct().count() / 4


def test_substitutions_that_no_spaced_window_passes_are_found(spark):
    cases = [(40, range(4, 40, 5), 40), (15, (3, 7, 11), 60), (12, (3, 8), 12), (5, (2,), 5), (8, (4,), 8), (10, (3, 6), 10), (11, (3, 7), 11)]
    rows = decontaminate.contaminated(*_planted(spark, cases)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, i) for i in range(len(cases))}
    too_many = [(12, (3, 6, 9), 12), (8, (3, 4), 8), (4, (2,), 4), (10, (), 60)]
    assert not decontaminate.contaminated(*_planted(spark, too_many)).collect()
    docs, items = _planted(spark, [(9, (2, 6), 12)])
    assert decontaminate.contaminated(docs, items, least_words=9, similarity=0.75).count() == 1
