"""The numbered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import audit, bestfit, bpe, neardup, packing, pii, quality, sharding, substrings, suffixes, topk, vectorcodes, warc

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_near_dedup": neardup.op4_near_dedup,
    "op5_surrogates": pii.op5_surrogates,
    "op6_packing": packing.op6_packing,
    "op7_suffix_dedup": suffixes.op7_suffix_dedup,
    "op8_exact_top_k": topk.op8_exact_top_k,
    "op9_shard_lookup": sharding.op9_shard_lookup,
    "op10_warc_captures": warc.op10_warc_captures,
    "op11_filter_audit": audit.op11_filter_audit,
    "op12_best_fit": bestfit.op12_best_fit,
    "op13_vector_codes": vectorcodes.op13_vector_codes,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality.op1_sql(),
        "op2_substring_dedup": substrings.OP2_SQL,
        "op4_near_dedup": neardup.OP4_SQL,
        "op7_suffix_dedup": suffixes.OP7_SQL,
        "op8_exact_top_k": topk.OP8_SQL,
        "op9_shard_lookup": sharding.op9_sql(),
        "op10_warc_captures": warc.OP10_SQL,
        "op11_filter_audit": audit.OP11_SQL,
        "op13_vector_codes": vectorcodes.op13_sql(),
    }
