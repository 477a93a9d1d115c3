"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txlake.llm import (
    alignment,
    bpe,
    decontaminate,
    embedding_dedup,
    fingerprints,
    lm,
    near_dedup,
    quality,
    secrets,
    sharding,
    substring_dedup,
    toxicity,
    whitening,
)
from txlake.llm.common import table


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model_scores(table(spark, sf_dir, "documents"))


def op2_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path() -> str:
    """The public byte-level vocabulary; a path, never a copy."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op3_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 16)


def op5_induced_sorting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op7_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op9_fuzzy_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_golub_kahan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def piece_model_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op13_arrow_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), tokenizer_path(), piece_model_path())


QUERIES = {
    "op1_pitman_yor": op1_pitman_yor,
    "op2_byte_cnn": op2_byte_cnn,
    "op3_distinct_words": op3_distinct_words,
    "op4_sampled_splitters": op4_sampled_splitters,
    "op5_induced_sorting": op5_induced_sorting,
    "op6_bayes_minhash": op6_bayes_minhash,
    "op7_containment_search": op7_containment_search,
    "op8_secret_scan": op8_secret_scan,
    "op9_fuzzy_lexicon": op9_fuzzy_lexicon,
    "op10_pivot_permutations": op10_pivot_permutations,
    "op11_bottom_k": op11_bottom_k,
    "op12_golub_kahan": op12_golub_kahan,
    "op13_arrow_alignment": op13_arrow_alignment,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_bayes_minhash": near_dedup.ORACLE,
        "op7_containment_search": decontaminate.ORACLE,
        "op8_secret_scan": secrets.oracle(),
        "op10_pivot_permutations": embedding_dedup.ORACLE,
        "op11_bottom_k": fingerprints.oracle(),
    }
