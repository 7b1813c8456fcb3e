"""Every operator and stage takes odd rows and empty tables, with the results its docstring states."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from offerlens.llm import decontaminate, fingerprint, language, lines, mixing, near_dedup, passages, quality, shard, token_store
from offerlens.llm.queries import tokenizer_path
from offerlens.session import new_path


@pytest.fixture
def benchmark(spark):
    from conftest import BASE

    return spark.createDataFrame([(1, BASE[:400]), (2, None), (3, "short item"), (4, "")], "item_id long, text string")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, 1, 1), (None, 1, 0), (7, None, None), (9, 0, 0)], "doc_id long, quality int, toxic int")


def _domains(labels):
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("clean").alias("domain"))


def _tokens(docs):
    path = new_path(docs.sparkSession, "tokens")
    token_store.write_tokens(docs, path, tokenizer_path())
    return token_store.digest(docs.sparkSession, path)


PER_ROW = {
    "shard": lambda d, b, l: shard.digest(shard.shards_of(d, 3)),
    "language": lambda d, b, l: language.predict(d, language.fit(language.learnable(d))),
    "tokens": lambda d, b, l: _tokens(d),
    "near": lambda d, b, l: near_dedup.duplicate_classes(d),
    "mixing": lambda d, b, l: mixing.membership(d, _domains(l), {"clean": 0.8, "low": 0.2}),
    "fingerprint": lambda d, b, l: fingerprint.fingerprints(d),
    "quality": lambda d, b, l: quality.predict(d, quality.fit(d, quality.learnable(l))),
}
FINDINGS = {
    "lines": lambda d, b, l: lines.without_repeats(d),
    "passages": lambda d, b, l: passages.repeated_passages(d),
    "leaks": lambda d, b, l: decontaminate.contaminated(d, b),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_every_odd_row(odd_rows, benchmark, labels, name):
    assert len(PER_ROW[name](odd_rows, benchmark, labels).collect()) == 13


@pytest.mark.parametrize("name", [*PER_ROW, *FINDINGS])
def test_empty_table(no_rows, benchmark, labels, name):
    run = (PER_ROW | FINDINGS)[name]
    assert run(no_rows, benchmark, labels).collect() == []
    assert run(no_rows, benchmark.limit(0), labels.limit(0)).collect() == []


def test_texts_without_words(odd_rows, benchmark, labels):
    rows = {r["doc_id"]: r for r in PER_ROW["language"](odd_rows, benchmark, labels).where("doc_id in (2, 3, 4, 8)").collect()}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows.values())
    near = {r["doc_id"]: r for r in near_dedup.duplicate_classes(odd_rows).where("doc_id is not null").collect()}
    assert all(near[k]["class_id"] == k and near[k]["copies"] == 1 for k in (2, 3, 4))
    assert near[7]["class_id"] == near[10]["class_id"] == 6 and near[6]["copies"] == 5
    marks = {r["doc_id"]: r for r in fingerprint.fingerprints(odd_rows).where("doc_id is not null").collect()}
    assert marks[2]["fingerprint"] == marks[3]["fingerprint"] == "" and marks[6]["fingerprint"] == marks[7]["fingerprint"]


def test_findings_on_odd_rows(odd_rows, benchmark):
    removed = {r["doc_id"]: r for r in lines.without_repeats(odd_rows).where("doc_id is not null").collect()}
    assert removed[7]["removed"] == [0] and removed[6]["removed"] == [] and removed[2]["lines"] == 0
    found = passages.repeated_passages(odd_rows).where("doc_id is not null").collect()
    assert {(r["doc_id"], r["later"]) for r in found if r["doc_id"] in (6, 7)} >= {(6, False), (7, True)}
    assert not any(r["doc_id"] in (1, 2, 3, 4, 5, 8, 9) for r in found)
    leaks = decontaminate.contaminated(odd_rows, benchmark).collect()
    assert {r["doc_id"] for r in leaks} == {6, 7, 10, None} and {r["item_id"] for r in leaks} == {1}


@pytest.mark.parametrize("step", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_the_columns(spark, odd_rows, benchmark, labels, tmp_path, step):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_rows, odd_rows.limit(0)):
        out = step[1](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.collect()


def test_near_duplicates_keep_one_of_a_group(odd_rows):
    kept = [r["doc_id"] for r in near_dedup.one_of_each(odd_rows).collect()]
    assert sorted(k for k in kept if k is not None) == [1, 2, 3, 4, 5, 6, 8, 9] and kept.count(None) == 1
