"""Operators against brute force, exact round trips and held-out accuracy."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import __spark_entry__ as entry
import corpus_pipeline
from compare import first_difference, spark_rows, sql_rows, sql_tables
from pyspark.sql import functions as F

from offerlens.llm import fingerprint, language, lines, mixing, near_dedup, passages, quality, queries, shard, token_store
from offerlens.llm.components import components


def _words(text):
    return re.findall(r"[^\W_]+", text.lower())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, folder, name):
    ours = spark_rows(queries.QUERIES[name](spark, folder))
    assert first_difference(ours, sql_rows(sql_tables(folder), queries.ORACLES[name])) is None and ours[1]


def test_all_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 1 + len(queries.QUERIES))]
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def test_shards_hold_every_row_once_in_a_fixed_order(spark, folder, documents):
    rows = queries.op1_sharding(spark, folder).toPandas()
    sizes = rows.groupby("shard").size()
    assert len(rows) == documents.count() and rows.doc_id.is_unique and sizes.max() - sizes.min() <= 1 and len(sizes) == 24
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in rows.groupby("shard"))
    again = shard.digest(shard.shards_of(documents.repartition(5), 24)).toPandas()
    assert dict(zip(rows.doc_id, zip(rows["shard"], rows.slot))) == dict(zip(again.doc_id, zip(again["shard"], again.slot)))
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(zlib.crc32(texts[i].encode()) == c for i, c in zip(rows.doc_id, rows.text_crc32))


def test_a_repeated_key_is_dealt_to_several_buckets(spark):
    docs = spark.range(600).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x" * 500).alias("text"))
    out = shard.shards_of(docs, 4, bucket_bytes=20_000).toPandas()
    assert len(out) == 600 and sorted(out.groupby("shard").size()) == [150] * 4
    assert all(sorted(g.slot) == list(range(150)) for _, g in out.groupby("shard"))


def test_languages_of_held_out_documents(documents):
    model = language.fit(language.learnable(documents))
    rows = language.predict(documents.withColumn("held", language.held_out()), model).where("held").toPandas()
    assert len(rows) and (rows.lang == rows.lang_pred).mean() > 0.95 and rows.score.between(0, 1).all()
    assert (model.weights == 0).mean() > 0.5


def test_tokens_equal_those_of_whole_texts(spark, folder, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op3_tokens(spark, folder).toPandas().sort_values("doc_id")
    start = 0
    for r, (doc_id, text) in zip(rows.itertuples(), documents.select("doc_id", "text").orderBy("doc_id").collect()):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_tokens_of_odd_white_space():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    texts = ["", " ", "a  b", " lead", "trail ", "x \n y", "a\nb", "a.\nB, c..d. e,. f", "\x01 a \x01b", "tab\t b", "é  x", "it's. ok", "<|endoftext|> a"]
    assert token_store.encode(texts, path) == [np.array(e.ids, "<i4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_selected_tokens_read_only_what_is_asked(spark, documents, tmp_path):
    path = f"{tmp_path}/tokens"
    token_store.write_tokens(documents, path, queries.tokenizer_path(), encoding="delta")
    part = token_store.read_tokens(spark, path, ("doc_id", "n_tokens"), low=10, high=20)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ids" not in plan.split("ReadSchema")[1]
    assert sorted(r["doc_id"] for r in part.collect()) == list(range(10, 21))


def test_repeated_lines_equal_brute_force(documents):
    rows = {r["doc_id"]: r["removed"] for r in lines.without_repeats(documents).collect()}
    seen = []
    for doc_id, text in documents.select("doc_id", "text").orderBy("doc_id").collect():
        gone = []
        for k, line in enumerate(text.split("\n")):
            s = frozenset(_words(line))
            if s:
                if any(len(s & q) >= 0.8 * len(s | q) - 1e-9 for q in seen):
                    gone.append(k)
                seen.append(s)
        assert rows[doc_id] == gone


def test_token_sets_of_more_lines_than_are_numbered_at_once(monkeypatch):
    rank = np.zeros(1 << 16, np.uint64)
    texts = ["a b a\n\nc d", "", "\n!\n" + "\n".join(f"w{i} x w{i}" for i in range(20))]
    whole = lines._token_sets(texts, rank)
    assert whole[0].tolist() == [0, 0] + [2] * 20 and whole[1].tolist() == [0, 2, *range(2, 22)] and set(np.diff(whole[2])) == {2}
    monkeypatch.setattr(lines, "_LINES", 4)
    assert all(np.array_equal(a, b) for a, b in zip(whole, lines._token_sets(texts, rank)))


def test_cut_texts_keep_what_is_not_repeated():
    assert passages.cut_later("A b, c d. E", [(1, 2)]) == "A  d. E"
    assert lines.kept_text("a\nb\nc", [1]) == "a\nc"


def test_near_duplicates_equal_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) for w in map(_words, (r["text"] for r in rows))]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                root[find(i)] = find(j)
    want = defaultdict(set)
    for i, r in enumerate(rows):
        want[find(i)].add(r["doc_id"])
    got = defaultdict(set)
    for r in near_dedup.duplicate_classes(documents).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert sorted(r["doc_id"] for r in near_dedup.one_of_each(documents).collect()) == sorted(map(min, want.values()))


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(1)
    a, b = {int(x): float(w) for x, w in zip(range(60), draw.uniform(1, 5, 60))}, {int(x): float(w) for x, w in zip(range(20, 80), draw.uniform(1, 5, 60))}
    exact = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())
    doc = np.repeat([0, 1], 60)
    element = near_dedup.mix(np.array([*a, *b], np.uint64))
    signature = near_dedup.probability_signature(doc, element, np.array([*a.values(), *b.values()]), 2, 4000)
    assert abs((signature[0] == signature[1]).mean() - exact) < 0.03


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (101, 102), (102, 101)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(links).collect()} == {**{i: 0 for i in range(41)}, 101: 101, 102: 101}


def test_mixing_meets_its_targets(spark, folder):
    rows = queries.op7_mixing(spark, folder).toPandas()
    for domain, share in queries.TARGETS.items():
        assert (rows.tokens * rows.rate * rows[f"p_{domain}"]).sum() / rows.tokens.sum() == pytest.approx(share, abs=0.01)
    assert (rows.rate >= 0).all() and (np.abs(rows.copies - rows.rate) <= 1).all()


def test_rates_without_labels_are_one(documents):
    empty = documents.sparkSession.createDataFrame([], "doc_id long, domain string")
    assert {r["rate"] for r in mixing.membership(documents, empty, {"clean": 1.0}).collect()} == {1.0}


def test_sketches_merge_and_count(documents):
    sketched = documents.select("source", fingerprint.sketch(F.col("text")).alias("sketch"), "text")
    merged = {r["source"]: r["sketch"] for r in fingerprint.merged(sketched, ["source"]).collect()}
    whole = documents.select("source", F.explode(fingerprint.shingle_hashes(F.col("text"))).alias("h")).toPandas()
    for source, part in whole.groupby("source"):
        assert merged[source] == sorted(set(part.h))[:fingerprint.K]
    exact = whole.h.nunique()
    one = fingerprint.merged(sketched.withColumn("all", F.lit(1)), ["all"]).select(fingerprint.distinct_shingles(F.col("sketch"))).first()[0]
    assert abs(one / exact - 1) < 0.3


def test_containment_of_a_part(spark):
    text = " ".join(f"w{i}" for i in range(2000))
    row = spark.createDataFrame([(" ".join(text.split()[:500]), text)], "a string, b string").select(
        fingerprint.containment(fingerprint.sketch(F.col("a")), fingerprint.sketch(F.col("b"))).alias("ab"),
        fingerprint.containment(fingerprint.sketch(F.col("b")), fingerprint.sketch(F.col("a"))).alias("ba")).first()
    assert row["ab"] == 1.0 and abs(row["ba"] - 0.25) < 0.15


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.predict(docs, quality.fit(docs, quality.learnable(labels))).where("held_out").join(labels, "doc_id").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.93 and rows.score.between(0, 1).all()


def test_pipeline_stages_keep_their_contracts(spark, folder, documents):
    out = corpus_pipeline.run(spark, folder).toPandas()
    assert {*documents.columns, "shard", "slot"} == set(out.columns) and set(out.doc_id) <= {r["doc_id"] for r in documents.collect()}
    leaked = {r["doc_id"] for r in queries.op10_decontamination(spark, folder).collect()}
    assert not leaked & set(out.doc_id)
    firsts = {r["class_id"] for r in near_dedup.duplicate_classes(documents).collect()}
    assert set(out.doc_id) <= firsts
