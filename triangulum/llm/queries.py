"""The registered queries of the training-data operators, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    arrow_files,
    bpe_automaton,
    centroids,
    chosen_path,
    cross_polytope,
    fingerprint,
    mixing,
    pii,
    quality,
    sharding,
    toxicity,
    url_rules,
)
from .common import read


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; it is not part of the library."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read(spark, sf_dir, "documents"), shards=16)
    law = [F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")]
    return placed.select("doc_id", "size", "text_crc32", law[0], "shard", "slot", law[1])


def op2_arrow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return arrow_files.round_trip(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return cross_polytope.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op4_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"))


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(read(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"), url_rules.rules_table(spark))


def op7_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(read(spark, sf_dir, "documents"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.domains_of(read(spark, sf_dir, "labels"))
    return mixing.rates(read(spark, sf_dir, "documents"), labelled)


def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.digests(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"))


def op11_integer_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


def op12_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align(read(spark, sf_dir, "documents"), *paths)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_bounded_ring, op2_arrow_files, op3_cross_polytope, op4_weak_labels, op5_chosen_path, op6_url_rules,
        op7_quartile_digest, op8_soft_mixing, op9_bpe_automaton, op10_boosted_pii,
        op11_integer_centroids, op12_compression_distance, op13_token_alignment,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_rules": url_rules.ORACLE, "op11_integer_centroids": centroids.oracle()}
