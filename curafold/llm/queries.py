"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from . import byte_bpe, exact_dedup, lm_scoring, packing, pii, pipeline, quality_classifier, quality_rules, sharding, simhash, token_store

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_token_store": token_store.query,
    "op3_byte_bpe": byte_bpe.query,
    "op4_packing": packing.query,
    "op5_simhash": simhash.query,
    "op6_quality_classifier": quality_classifier.query,
    "op7_lm_scoring": lm_scoring.query,
    "op8_sharding": sharding.query,
    "op9_exact_dedup": exact_dedup.query,
    "op10_pii": pii.query,
    "pipeline": pipeline.run,
}
SQL = {"op9_exact_dedup": exact_dedup.SQL}
