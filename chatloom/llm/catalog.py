"""The queries of this subpackage, and the SQL of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import (
    op1_quality,
    op2_suffix_dedup,
    op3_warc,
    op4_language,
    op5_simhash,
    op6_decontaminate,
    op7_embeddings,
    op8_sentencepiece,
    op9_token_counts,
    op10_licenses,
    op11_hard_negatives,
    op12_periodic_runs,
    op13_sharding,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality.query,
    "op2_suffix_dedup": op2_suffix_dedup.query,
    "op3_warc": op3_warc.query,
    "op4_language_id": op4_language.query,
    "op5_simhash_dedup": op5_simhash.query,
    "op6_decontamination": op6_decontaminate.query,
    "op7_embedding_dedup": op7_embeddings.query,
    "op8_sentencepiece": op8_sentencepiece.query,
    "op9_token_counts": op9_token_counts.query,
    "op10_license_scan": op10_licenses.query,
    "op11_hard_negatives": op11_hard_negatives.query,
    "op12_periodic_runs": op12_periodic_runs.query,
    "op13_sharding": op13_sharding.query,
}

ORACLE_SQL: dict[str, str] = {
    "op3_warc": op3_warc.ORACLE_SQL,
    "op6_decontamination": op6_decontaminate.ORACLE_SQL,
    "op11_hard_negatives": op11_hard_negatives.ORACLE_SQL,
}
