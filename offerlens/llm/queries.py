"""The registered queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm import decontaminate, fingerprint, language, lines, mixing, near_dedup, passages, phrases, quality, runs, secrets, shard, sql, token_store
from offerlens.session import new_path

SHARDS = 24
TOKENIZER = "byte_bpe_50k.json"
TARGETS = {"clean": 0.90, "low_quality": 0.05, "toxic": 0.05}  # wanted shares of tokens


def _table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low_quality").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def tokenizer_path(file: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(file)


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard.digest(shard.shards_of(_table(spark, folder, "documents"), SHARDS))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.fit(language.learnable(docs))
    return language.predict(docs.select("doc_id", "text", language.held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op3_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_store.write_tokens(_table(spark, folder, "documents"), path, tokenizer_path())
    return token_store.digest(spark, path)


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.without_repeats(_table(spark, folder, "documents"))


def op5_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, folder, "documents"))


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.duplicate_classes(_table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.membership(_table(spark, folder, "documents"), domains(_table(spark, folder, "labels")), TARGETS)


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, folder, "documents"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality.predict(docs, quality.fit(docs, quality.learnable(_table(spark, folder, "labels"))))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents, by a hash of the id, repeat a block of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        later = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), later), " ")).otherwise("")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # One lambda argument holds the words, so they are split once.
    return docs.select("doc_id", F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(looped(_table(spark, folder, "documents"))))


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op13_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.secrets(_table(spark, folder, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_language, op3_tokens, op4_line_dedup, op5_passages, op6_near_dedup, op7_mixing, op8_fingerprints,
    op9_quality, op10_decontamination, op11_runs, op12_phrases, op13_secrets)}

ORACLES = {
    "op5_passages": sql.passages_sql(),
    "op8_fingerprints": sql.fingerprints(),
    "op10_decontamination": sql.decontamination(),
    "op12_phrases": sql.collocations(),
}
