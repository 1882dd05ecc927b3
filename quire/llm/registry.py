"""The queries of this folder by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from quire.llm import collocations, curriculum, interval_overlap, language_gru, licence_scan, media_chunks, nra_topk, piece_sampling, quality_ftrl, simhash_dedup, suffix_repeats, token_counts, url_cascade

QUERIES = {
    "op1_media_chunks": media_chunks.op1_media_chunks,
    "op2_language_id": language_gru.op2_language_id,
    "op3_mix_sources": curriculum.op3_mix_sources,
    "op4_simhash_dedup": simhash_dedup.op4_simhash_dedup,
    "op5_sentencepiece": piece_sampling.op5_sentencepiece,
    "op6_url_filter": url_cascade.op6_url_filter,
    "op7_licence_scan": licence_scan.op7_licence_scan,
    "op8_quality": quality_ftrl.op8_quality,
    "op9_topk": nra_topk.op9_topk,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_collocations": collocations.op11_collocations,
    "op12_interval_overlap": interval_overlap.op12_interval_overlap,
    "op13_suffix_repeats": suffix_repeats.op13_suffix_repeats,
}
SQL = {
    "op3_mix_sources": curriculum.SQL,
    "op6_url_filter": url_cascade.SQL,
    "op9_topk": nra_topk.SQL,
    "op11_collocations": collocations.SQL,
    "op12_interval_overlap": interval_overlap.SQL,
}
