"""Registered queries of the operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    cover_tree, crf_quality, kmeans_tree, kneser_ney, license_templates, packing, quality_rules, segment_sampling, simhash_dedup, spelling,
    token_scan, url_graph, whitening)
from .frames import shared_folder, ship

BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
LEAST_QUALITY = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str = "doc_id") -> Column:
    """crc32 of an id as text, mod 5; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 5


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(BPE))


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> crf_quality.Crf:
    """Learned from the labels of documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(fold() != 0)
    return crf_quality.fit_on(docs, labels)


def op2_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = crf_quality.with_score(docs, quality_model(docs, spark, sf_dir), carry=["doc_id"])
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs.where(fold() != 1))
    return kneser_ney.with_score(docs, model, carry=["doc_id"]).withColumn("held_out", fold() == 1)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, quality_rules.fit_on(docs), carry=["doc_id"])


def op5_gumbel_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return segment_sampling.sample(docs, public_tokenizers.path(PIECES), with_decoded=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    folder = shared_folder(spark, "tokens")
    token_scan.write_token_files(docs, folder, public_tokenizers.path(BPE)).agg(F.sum("n_tokens")).collect()
    found = token_scan.count_tokens(spark, folder)
    return found.withColumn("file", F.substring_index("file", "/", -1))


def op8_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_graph.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op9_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_templates.scan(docs, carry=["doc_id"])
    base = F.filter("places", lambda p: p["base"])
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base["first"]).alias("first_word"),
        F.array_max(base["first"]).alias("last_word"), labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"), "score")


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, whitening.fit(vectors), carry=["vec_id"])


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_crf_quality": op2_crf_quality,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_quality_rules": op4_quality_rules,
    "op5_gumbel_segmentation": op5_gumbel_segmentation,
    "op6_simhash": op6_simhash,
    "op7_token_scan": op7_token_scan,
    "op8_url_graph": op8_url_graph,
    "op9_license_templates": op9_license_templates,
    "op10_cover_tree": op10_cover_tree,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_kmeans_tree": op13_kmeans_tree,
}

ORACLE_SQL: dict[str, str] = {"op8_url_graph": url_graph.oracle_sql(), "op10_cover_tree": cover_tree.oracle_sql()}
