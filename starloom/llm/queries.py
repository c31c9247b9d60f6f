"""The operators' queries and their SQL, by name."""

from __future__ import annotations

import corpus_pipeline
from starloom.llm import (
    embedding_dedup,
    embedding_whitening,
    fingerprints,
    html_extract,
    license_scan,
    lm_score,
    minhash_dedup,
    mixing,
    packing,
    quality_rules,
    spelling_variants,
    token_output,
    url_filter,
)

QUERIES = {
    "op1_minhash_dedup": minhash_dedup.op1_query,
    "op2_html_blocks": html_extract.op2_query,
    "op3_exact_complement_packing": packing.op3_query,
    "op4_fingerprints": fingerprints.op4_query,
    "op5_url_cascade": url_filter.op5_query,
    "op7_systematic_mix": mixing.op7_query,
    "op6_class_maxent": lm_score.op6_query,
    "op8_training_order": token_output.op8_query,
    "op9_license_scan": license_scan.op9_query,
    "op10_quality_rules": quality_rules.op10_query,
    "op11_embedding_whitening": embedding_whitening.op11_query,
    "op12_spelling_variants": spelling_variants.op12_query,
    "op13_embedding_dedup": embedding_dedup.op13_query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_minhash_dedup": minhash_dedup.OP1_SQL,
    "op5_url_cascade": url_filter.OP5_SQL,
    "op7_systematic_mix": mixing.OP7_SQL,
    "op10_quality_rules": quality_rules.OP10_SQL,
    "op12_spelling_variants": spelling_variants.OP12_SQL,
    "op13_embedding_dedup": embedding_dedup.OP13_SQL,
}
