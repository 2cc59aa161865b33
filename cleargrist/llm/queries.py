"""One query per operator: production parameters over whole tables, with the columns agreed on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleargrist.llm import (
    decontamination,
    hard_negatives,
    language_id,
    mixing,
    near_dedup,
    oracle,
    personal_data,
    quality_classifier,
    quality_rules,
    secret_scan,
    spelling_variants,
    substring_dedup,
    token_counts,
)
from cleargrist.llm.line_dedup import LineIndex
from cleargrist.llm.tables import documents
from cleargrist.workspace import scratch_path

#: The vocabulary's file, unless the session's setting ``spark.cleargrist.vocabulary`` names another.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = scratch_path(spark, "blob-ledger")
    found = secret_scan.scan_versions(documents(spark, sf_dir), ledger)
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in kinds),
        digest(secret_scan.span_list(base)).alias("base_sha256"),
        secret_scan.span_list(F.col("spans")).alias("spans"),
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = quality_classifier.fit(docs, labels(spark, sf_dir))
    return quality_classifier.score_documents(docs, weights)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cleaned = LineIndex.build(docs).clean(docs)
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", digest(F.col("text")).alias("kept_sha256")
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = spark.conf.get("spark.cleargrist.vocabulary", VOCABULARY)
    counted = token_counts.count_tokens(documents(spark, sf_dir), vocabulary, rule="most")
    return counted.withColumn("n_tokens", F.col("n_tokens").cast("long"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = near_dedup.link_documents(documents(spark, sf_dir), size=4, threshold=80)
    return linked.drop("key")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(documents(spark, sf_dir), length=200)
    return left.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_matches(documents(spark, sf_dir), benchmark(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture = mixing.mix(documents(spark, sf_dir), weights=(1, 2, 3), most=3)
    shards = F.array_sort(F.array_distinct(F.transform("draws", lambda d: d["shard"])))
    return mixture.documents.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.array_join(shards.cast("array<string>"), ",").alias("shards"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: ~s["disguised"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in personal_data.KINDS),
        digest(personal_data.span_list(base)).alias("base_sha256"),
        personal_data.span_list(F.col("spans")).alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    trees = quality_rules.fit(docs, labels(spark, sf_dir))
    rated = quality_rules.rate_documents(docs, trees)
    return rated.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(documents(spark, sf_dir), drop_every=31)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", shifted)
    return hard_negatives.mine_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.fit(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_near_dedup": op5_near_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_mixing": op8_mixing,
    "op9_personal_data": op9_personal_data,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_language_id": op13_language_id,
}

#: Where SQL can express a query over whole tables in fair time: the same rows in DuckDB.
ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": oracle.SECRETS,
    "op3_line_dedup": oracle.LINES,
    "op5_near_dedup": oracle.COPIES,
    "op7_decontamination": oracle.LEAKS,
    "op11_spelling_variants": oracle.VARIANTS,
    "op12_hard_negatives": oracle.NEGATIVES,
}
