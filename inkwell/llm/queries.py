"""The queries of the training-data operators and their DuckDB equivalents."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, fingerprints, language, lines, mixing, ngrams, passages, quality, secrets, similar


def queries():
    return {
        "op1_mix_sources": mixing.op1_mix_sources,
        "op2_substring_dedup": passages.op2_substring_dedup,
        "op3_byte_bpe": bpe.op3_byte_bpe,
        "op4_secret_scan": secrets.op4_secret_scan,
        "op5_language_id": language.op5_language_id,
        "op6_lm_scoring": ngrams.op6_lm_scoring,
        "op7_fingerprints": fingerprints.op7_fingerprints,
        "op8_line_dedup": lines.op8_line_dedup,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_ngram_jaccard": similar.op10_ngram_jaccard,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql():
    out = {"op9_quality_rules": quality.op9_sql()}
    if corpus_pipeline.ORACLE_SQL is not None:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
