"""A group of near-equal lines of which many are not similar to its earliest."""

import random

from offerlens.llm import lines


def test_a_settled_line_meets_none_before_it_again(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(30)]
    texts = []
    for n in range(300):
        row = list(base)
        for i in draw.sample(range(30), draw.choice((1, 2, 3))):
            row[i] = f"v{draw.randrange(40)}"
        texts.append(" ".join(row))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {}
    stage = lines.stage

    def seen(df, name):
        kept.setdefault(name, []).append(stage(df, name))
        return kept[name][-1]

    monkeypatch.setattr(lines, "stage", seen)
    got = {r["doc_id"]: r["removed"] for r in lines.without_repeats(docs).collect()}
    sets = [frozenset(t.split()) for t in texts]
    want = [[0] if any(10 * len(s & e) >= 8 * len(s | e) for e in sets[:n]) else [] for n, s in enumerate(sets)]
    assert [got[n] for n in range(len(texts))] == want and 0 < sum(map(len, want)) < len(texts)

    first, second = kept["line-pairs"]
    settled = {r["later"] for r in kept["line-links"][0].collect()}
    later = [r["a"] if r["a_place"] > r["b_place"] else r["b"] for r in second.collect()]
    assert settled and later and settled.isdisjoint(later)
    assert first.count() <= 2 * lines.SHARES * len(texts)


def _sets(draw, n):
    """Word sets of sizes from 4 to 60, of which many are near copies of others in neighbouring sizes."""
    sets = []
    for _ in range(n):
        if sets and draw.random() < 0.6:
            row = set(draw.choice(sets))
            for word in draw.sample(sorted(row), draw.choice((0, 1, len(row) // 10))):
                row.remove(word)
            row |= {draw.randrange(400) for _ in range(draw.choice((0, 1, 3)))}
        else:
            row = {draw.randrange(400) for _ in range(draw.randrange(4, 60))}
        if len(row) >= 4:
            sets.append(row)
    return sets


def test_lines_of_many_sizes_meet_in_blocks(spark, monkeypatch):
    """Blocks of few postings, several parts and classes of sizes: every similar pair is found."""
    monkeypatch.setattr(lines, "_PAIRS", 7)
    draw = random.Random(11)
    sets = _sets(draw, 400)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in sorted(s))) for i, s in enumerate(sets)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["lines"], r["removed"]) for r in lines.without_repeats(docs).collect()}
    want = [(1, [0] if any(10 * len(s & e) >= 8 * len(s | e) for e in sets[:n]) else []) for n, s in enumerate(sets)]
    assert [got[n] for n in range(len(sets))] == want and 0 < sum(len(w[1]) for w in want) < len(sets)


def _met(sets, settled, parts, at_once):
    """Pairs of sets that meet, each with the marks of both, and how many pairs of postings were compared."""
    import math

    import numpy as np
    import pyarrow as pa

    key = [10 * i + 5 for i in range(len(sets))]
    ordered = [sorted(s) for s in sets]
    prefix = [np.array(r[:len(r) - math.ceil(0.8 * len(r) - 1e-9) + 1], np.int32).tobytes() for r in ordered]
    parity = np.zeros((2, len(sets)), np.uint64)
    for i, s in enumerate(sets):
        for x in s:
            parity[x % 2, i] ^= np.uint64(1) << np.uint64(x // 2 % 64)
    rows = pa.RecordBatch.from_arrays(
        [pa.array(key), *[pa.array(p.view(np.int64)) for p in parity], pa.array([len(s) for s in sets], pa.int32()),
         pa.array(settled, pa.int32()), pa.array(prefix, pa.binary())], ["key", "parity", "parity2", "size", "settled", "prefix"])
    batches = [rows.slice(i, at_once) for i in range(0, len(sets), at_once)]
    blocks = [row for b in lines._posted(0.8, parts)(iter(batches)) for row in b.to_pylist()]
    blocks.sort(key=lambda r: (r["part"], r["sizes"]))
    schema = pa.schema([("part", pa.int32()), ("sizes", pa.int32()), ("block", pa.binary())])
    out, compared = set(), [0]
    whole = lines._compared

    def counted(*given):
        for a, b in whole(*given):
            compared[0] += len(a)
            yield a, b

    lines._compared = counted
    try:
        for batch in lines._meeting(0.8)(pa.RecordBatch.from_pylist(blocks[i:i + 2], schema) for i in range(0, len(blocks), 2)):
            out |= {(r["a"] // 10, r["b"] // 10, r["a_settled"], r["b_settled"]) for r in batch.to_pylist()}
    finally:
        lines._compared = whole
    return out, compared[0]


def test_postings_in_blocks_meet_all_similar_sets_that_are_not_both_settled(monkeypatch):
    draw = random.Random(3)
    sets = _sets(draw, 300)
    settled = [draw.randrange(2) for _ in sets]
    want = {(i, j, settled[i], settled[j]) for i, s in enumerate(sets) for j in range(i + 1, len(sets))
            if not settled[i] & settled[j] and s != sets[j] and 10 * len(s & sets[j]) >= 8 * len(s | sets[j])}
    for parts, at_once, postings, pairs in ((1, 400, 1 << 20, 1 << 18), (3, 7, 40, 5), (50, 1, 1, 1)):
        monkeypatch.setattr(lines, "_POSTINGS", postings)
        monkeypatch.setattr(lines, "_PAIRS", pairs)
        got, _ = _met(sets, settled, parts, at_once)
        assert want <= got and all(not c & d for _, _, c, d in got) and want


def test_sets_of_one_word_but_differing_sizes_are_not_compared():
    """A word that all sets share costs pairs of similar sizes only, not the square of their number."""
    sets = [{0} | set(range(1000 * n, 1000 * n + n)) for n in range(4, 400)]
    _, compared = _met(sets, [0] * len(sets), 4, 1000)
    assert compared < len(sets) ** 2 / 8
