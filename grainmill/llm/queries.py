"""Registered queries of the operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, bagminhash, decontaminate, knn, mixing, ordinal, pii, pitmanyor, quality, spelling, substring, urlfilter, warc
from .common import table
from .sql import KNN_SQL, MIXING_SQL, QUALITY_SQL, SPELLING_SQL, SUBSTRING_SQL, URLFILTER_SQL, WARC_SQL


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeats of 20 words."""
    left = substring.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    found = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.reduce("hits", F.lit(None).cast("double"), lambda a, x: F.greatest(a, x["share"]))
    items = F.transform("hits", lambda x: x["item_id"])
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), items.alias("item_ids"), best.alias("best_share"))


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the best grade and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return ordinal.graded(docs, ordinal.train(docs, table(spark, sf_dir, "labels"))).drop("text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return pii.with_surrogates(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page after it was written to archives and read back."""
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.selectExpr("record_id as page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page."""
    rules = spark.createDataFrame(urlfilter.RULES, "host string, path string, verdict string")
    return urlfilter.url_verdicts(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return pitmanyor.scores(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the documents."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    return knn.exact_neighbours(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of two tokenizers in every document."""
    return alignment.alignments(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_substring_dedup, op3_bagminhash, op4_decontamination, op5_ordinal_quality, op6_mixing, op7_pii_surrogates, op8_warc_revisits, op9_url_rules,
        op10_pitman_yor, op11_spelling_variants, op12_exact_topk, op13_token_alignment,
    )
}
SQL = {
    "op1_quality_rules": QUALITY_SQL,
    "op2_substring_dedup": SUBSTRING_SQL,
    "op6_mixing": MIXING_SQL,
    "op8_warc_revisits": WARC_SQL,
    "op9_url_rules": URLFILTER_SQL,
    "op11_spelling_variants": SPELLING_SQL,
    "op12_exact_topk": KNN_SQL,
}
