"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tallystar.llm import (
    byte_pairs,
    centroids,
    embedding_dedup,
    html_extract,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    whitening,
)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_embedding_dedup": embedding_dedup.query,
    "op3_quality_classifier": quality_classifier.query,
    "op4_html_extraction": html_extract.query,
    "op5_mixing": mixing.query,
    "op6_substring_dedup": substring_dedup.query,
    "op7_sharding": sharding.query,
    "op8_quality_rules": quality_rules.query,
    "op9_ngram_join": ngram_join.query,
    "op10_best_fit_packing": packing.query,
    "op11_embedding_whitening": whitening.query,
    "op12_byte_bpe": byte_pairs.query,
    "op13_centroid_clustering": centroids.query,
}
ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_embedding_dedup": embedding_dedup.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op9_ngram_join": ngram_join.ORACLE,
    "op13_centroid_clustering": centroids.ORACLE,
}
