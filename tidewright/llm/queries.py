"""The corpus operators' queries and their SQL where SQL can express them."""

from __future__ import annotations

from tidewright.llm import bpe, clusters, exact_dedup, fingerprints, matroska, mixing, pii, quality, simhash, substring_dedup, toxicity, warc, whitening

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_simhash": simhash.op3_simhash,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_warc_fixity": warc.op5_warc_fixity,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_pii": pii.op7_pii,
    "op8_mixing": mixing.op8_mixing,
    "op9_matroska": matroska.op9_matroska,
    "op10_bpe": bpe.op10_bpe,
    "op11_clusters": clusters.op11_clusters,
    "op12_whitening": whitening.op12_whitening,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}

SQL = {"op4_exact_dedup": exact_dedup.SQL, "op5_warc_fixity": warc.SQL, "op11_clusters": clusters.SQL}
