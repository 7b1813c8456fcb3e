"""Samples and fits that hold at very large repeats and hard targets."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.llm import language, mixing, quality
from offerlens.llm.queries import domains


def test_a_repeated_text_is_one_of_the_sample(spark, monkeypatch):
    rows = [("the same words over and over again", "en")] * 20_000 + [(f"some other words number {i} here", "en") for i in range(300)]
    rows += [(f"andere wörter nummer {i} stehen hier", "de") for i in range(50)]
    seen = []
    descend = language.follow_the_regularised_leader
    monkeypatch.setattr(language, "follow_the_regularised_leader", lambda data, *a, **k: seen.append(len(data)) or descend(data, *a, **k))
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"), per_language=100)
    assert 60 <= seen[0] <= 2 * 200 and model.languages == ("de", "en")
    one = language.fit(spark.createDataFrame(rows[:20_000], "text string, lang string"), per_language=100)
    assert seen[1] == 1 and one.languages == ("en",)


def test_an_id_of_many_rows_gives_one_text(spark, monkeypatch):
    docs = [(1, f"text number {i} of one id") for i in range(20_000)] + [(i, f"good words {i}") for i in range(2, 52)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 52)], "doc_id long, label int")
    seen = []
    descend = quality.descend
    monkeypatch.setattr(quality, "descend", lambda data, *a, **k: seen.append(len(data)) or descend(data, *a, **k))
    quality.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    assert seen == [51]


@pytest.mark.parametrize("targets", [{"clean": 0.05, "low_quality": 0.05, "toxic": 0.90}, {"clean": 0.02, "low_quality": 0.96, "toxic": 0.02}])
def test_hard_targets_are_met(spark, folder, documents, targets):
    table, rates = mixing.document_rates(documents, domains(spark.read.parquet(f"{folder}/labels.parquet")), targets)
    rows = rates.toPandas()
    mass = rows.tokens * rows.rows
    shares = {k: float((mass * rows.rate * rows[f"p{i}"]).sum() / mass.sum()) for i, k in enumerate(table)}
    assert rows.rate.min() >= 0 and max(abs(shares[k] - targets[k]) for k in targets) < 1e-3
    assert rows.miss.iloc[0] == pytest.approx(max(abs(shares[k] - targets[k]) for k in targets), abs=1e-9)


def test_rates_equal_those_of_a_plain_solver(spark):
    """Against many rounds of the plain gradient step in NumPy, targets that can and cannot be reached."""
    draw = np.random.default_rng(2)
    p = draw.dirichlet((0.4, 0.3, 0.2), 200)
    mass = draw.integers(1, 500, 200).astype(float)
    frame = spark.createDataFrame([(int(m), 1, *map(float, q)) for m, q in zip(mass, p)], "tokens long, rows long, p0 double, p1 double, p2 double")
    for goal in ([0.3, 0.3, 0.4], [0.02, 0.08, 0.9], [0.0, 0.0, 1.0]):
        rates, miss = mixing.fitted_rates(frame, goal)
        a = (p * mass[:, None]).T / mass.sum()
        rate = np.ones(200)
        inverse = np.linalg.pinv(a @ p)
        for _ in range(200_000):
            residual = a @ rate - goal
            new = np.maximum(0, rate - p @ (inverse @ residual))
            if np.abs(new - rate).max() < 1e-13:
                break
            rate = new
        got = frame.withColumn("rate", rates).toPandas()
        ours = ((got.tokens * got.rate).to_numpy() @ got[["p0", "p1", "p2"]].to_numpy()) / got.tokens.sum() - goal
        assert got.rate.min() >= 0 and np.abs(ours).max() == pytest.approx(miss, abs=1e-9)
        assert np.abs(ours).max() <= np.abs(a @ rate - goal).max() + 2e-3


def test_the_last_stage_takes_odd_rows(spark, odd_rows):
    name, step = corpus_pipeline.STAGES[-1]
    for docs in (odd_rows, odd_rows.limit(0)):
        out = step(spark, docs, "")
        assert name == "sharding" and out.count() == docs.count()
        assert set(out.columns) == set(docs.columns) | {"slot"}
        assert out.agg(F.sum(F.hash("doc_id", "text", "`a.b`"))).first() == docs.agg(F.sum(F.hash("doc_id", "text", "`a.b`"))).first()
