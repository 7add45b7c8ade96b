"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import ann, decontaminate, filter_audit, language_id, license_scan, line_dedup, merkle, mixing, near_dedup, piece_codec, quality, token_counts, toxicity

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_line_quality": quality.op4_line_quality,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_near_duplicates": near_dedup.op6_near_duplicates,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_nearest_vectors": ann.op8_nearest_vectors,
    "op9_license_scan": license_scan.op9_license_scan,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_pieces": piece_codec.op11_pieces,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_merkle": merkle.op13_merkle,
}
ORACLES = {
    "op2_mix_sources": mixing.ORACLE_SQL,
    "op10_line_dedup": line_dedup.ORACLE_SQL,
    "op12_filter_audit": filter_audit.ORACLE_SQL,
    "op13_merkle": merkle.ORACLE_SQL,
}
