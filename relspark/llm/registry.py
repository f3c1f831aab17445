"""Registered queries of this package: ``opN_<name>`` over whole tables, and SQL where SQL can state the rows."""

from __future__ import annotations

from . import codes, divergence, embeddings, language, licenses, minhash, oracles, packing, pieces, pii, quality, substrings, toxicity, treepack

QUERIES = {
    f.__name__: f
    for f in (
        embeddings.op1_embedding_neardup,
        toxicity.op2_toxicity,
        packing.op3_best_fit_packing,
        pii.op4_pii,
        language.op5_language_id,
        quality.op6_quality_rules,
        substrings.op7_suffix_dedup,
        minhash.op8_minhash_neardup,
        licenses.op9_license_scan,
        pieces.op10_sentencepiece,
        divergence.op11_source_divergence,
        treepack.op12_tree_packing,
        codes.op13_vector_codes,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_neardup": oracles.EMBEDDINGS,
    "op7_suffix_dedup": oracles.SUFFIXES,
    "op8_minhash_neardup": oracles.MINHASH,
    "op9_license_scan": licenses.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
    "op13_vector_codes": codes.oracle_sql(),
}
