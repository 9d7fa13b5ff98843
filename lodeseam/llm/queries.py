"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from functools import cache

from . import audio, language_id, line_dedup, lm_score, mixing, ngram_join, packing, quality, sharding, url_filter

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_audio_fingerprint": audio.op4_audio_fingerprint,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_vector_shards": sharding.op6_vector_shards,
    "op7_ngram_jaccard": ngram_join.op7_ngram_jaccard,
    "op8_best_fit_pack": packing.op8_best_fit_pack,
    "op9_language_id": language_id.op9_language_id,
    "op10_lm_score": lm_score.op10_lm_score,
}


@cache
def oracle() -> dict[str, str]:
    """SQL by query; made when asked for, since that of the URL filter has its weights written out."""
    return {
        "op1_line_dedup": line_dedup.SQL,
        "op2_url_filter": url_filter.oracle(),
        "op3_mix_sources": mixing.SQL,
        "op5_quality_rules": quality.SQL,
    }
