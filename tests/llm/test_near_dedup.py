"""Bands of texts that repeat passages."""

from offerlens.llm import near_dedup


def _block(stem, n):
    return " ".join(f"{stem}w{i}" for i in range(n))


def test_a_passage_repeated_in_one_text_only_keeps_the_bands():
    met = 0
    for k in range(120):
        page, part = _block(f"a{k}", 80), _block(f"b{k}", 30)
        once, often = f"{page} {part}", f"{page} {' '.join([part] * 200)}"
        places, keys = near_dedup.band_keys([once, often], near_dedup.WIDTH, near_dedup.BANDS, near_dedup.BAND_ROWS)
        assert places.tolist() == [0, 1]
        met += bool((keys[0] == keys[1]).any())
    assert met == 120


def test_signatures_follow_the_similarity_that_is_verified():
    part = _block("p", 100)
    texts = [f"{_block('q', 200)} {part}", f"{_block('q', 200)} {' '.join([part] * 50)}"]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    _, keys = near_dedup.band_keys(texts, 5, 4000, 1)
    assert abs((keys[0] == keys[1]).mean() - len(sets[0] & sets[1]) / len(sets[0] | sets[1])) < 0.03


def test_pages_with_a_block_repeated_in_one_of_them_are_one_class(spark):
    rows = []
    for k in range(60):
        page, part = _block(f"a{k}", 80), _block(f"b{k}", 30)
        rows += [(2 * k, f"{page} {part}"), (2 * k + 1, f"{page} {' '.join([part] * 200)}")]
    got = near_dedup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i - i % 2 for i, _ in rows}
