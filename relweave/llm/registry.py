"""The queries of the subpackage: name, function of (session, folder), SQL or None."""

from __future__ import annotations

import corpus_pipeline
from relweave.llm import byte_bpe, decontamination, exact_dedup, jaccard_join, katz_model, language_id, license_scan, merkle_manifest, personal_data, spelling_variants, substring_dedup, toxicity, url_filter

QUERIES = {
    "op1_language_id": (language_id.query, None),
    "op2_byte_bpe": (byte_bpe.query, None),
    "op3_url_filter": (url_filter.query, url_filter.SQL),
    "op4_jaccard_join": (jaccard_join.query, jaccard_join.SQL),
    "op5_license_scan": (license_scan.query, None),
    "op6_decontamination": (decontamination.query, decontamination.SQL),
    "op10_toxicity": (toxicity.query, None),
    "op7_personal_data": (personal_data.query, None),
    "op8_substring_dedup": (substring_dedup.query, None),
    "op9_exact_dedup": (exact_dedup.query, exact_dedup.SQL),
    "op11_merkle_manifest": (merkle_manifest.query, merkle_manifest.SQL),
    "op12_katz_model": (katz_model.query, None),
    "op13_spelling_variants": (spelling_variants.query, spelling_variants.SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
