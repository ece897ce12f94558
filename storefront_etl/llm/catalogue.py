"""The training-data queries and their SQL, gathered for ``__spark_entry__.py``."""

from __future__ import annotations

from storefront_etl.llm import (
    byte_bpe,
    discriminant,
    exact_dedup,
    jaccard_join,
    language_id,
    license_scan,
    line_templates,
    merkle_manifest,
    mixing,
    quality,
    sharding,
    spelling,
    substring_dedup,
)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_shard": sharding.op4_shard,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_line_dedup": line_templates.op6_line_dedup,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_language_id": language_id.op10_language_id,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_merkle_manifest": merkle_manifest.op12_merkle_manifest,
    "op13_quality_classifier": discriminant.op13_quality_classifier,
}

# Not SQL, tested against brute force, a round trip or held-out rows: the seeded shuffle (4), components (2),
# bounded-error matching (3), byte-pair merges (7), the forest (9),
# the rank profiles (10) and the discriminant (13).
ORACLE_SQL = {
    "op1_mix_sources": mixing.SQL,
    "op5_substring_dedup": substring_dedup.SQL,
    "op6_line_dedup": line_templates.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op11_spelling_variants": spelling.SQL,
    "op12_merkle_manifest": merkle_manifest.SQL,
}
