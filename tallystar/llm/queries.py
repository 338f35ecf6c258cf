"""The operators bound to the test tables: queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from . import html_extraction, language_id, near_dedup, packing, periodic_runs, quality_classifier, rule_forest, secret_scan, source_mixing, spelling_variants, spot_signatures, token_counts, topk_search
from .common import table
from .shipping import ship_package


def tokenizer() -> str:
    """The vocabulary file that the token queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_rule_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_forest.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer())


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(table(spark, sf_dir, "documents"))


def op13_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.digest(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": _shipped(op1_quality_classifier),
    "op2_minhash_near_dedup": _shipped(op2_minhash_near_dedup),
    "op3_rule_isolation_forest": _shipped(op3_rule_isolation_forest),
    "op4_secret_scan": _shipped(op4_secret_scan),
    "op5_language_id": _shipped(op5_language_id),
    "op6_source_mixing": _shipped(op6_source_mixing),
    "op7_best_fit_packing": _shipped(op7_best_fit_packing),
    "op8_token_counts": _shipped(op8_token_counts),
    "op9_exact_topk": _shipped(op9_exact_topk),
    "op10_html_extraction": _shipped(op10_html_extraction),
    "op11_spelling_variants": _shipped(op11_spelling_variants),
    "op12_periodic_runs": _shipped(op12_periodic_runs),
    "op13_spot_signatures": op13_spot_signatures,
}

SQL: dict[str, str] = {
    "op6_source_mixing": source_mixing.oracle(),
    "op9_exact_topk": topk_search.oracle(),
    "op11_spelling_variants": spelling_variants.oracle(),
    "op13_spot_signatures": spot_signatures.oracle(),
}
