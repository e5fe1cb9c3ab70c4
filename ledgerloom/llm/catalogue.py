"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from ledgerloom.llm import clustering, decontaminate, html_text, language, licenses, line_dedup, ngram_join, packing, quality, sale_enrichment, secrets, token_counts, toxicity

QUERIES = {
    "op1_line_dedup": line_dedup.cleaned,
    "op2_decontaminate": decontaminate.digest,
    "op3_html_text": html_text.visible,
    "op4_secret_scan": secrets.findings,
    "op5_quality_rules": quality.verdicts,
    "op6_ngram_jaccard_join": ngram_join.classes_of,
    "op7_toxicity": toxicity.scores,
    "op8_license_scan": licenses.detections,
    "op9_language_id": language.predictions,
    "op10_best_fit_packing": packing.placements,
    "op11_centroid_clusters": clustering.clusters,
    "op12_sale_enrichment": sale_enrichment.enriched,
    "op13_token_counts": token_counts.counts,
}
#: Where SQL can express the query.
ORACLES = {
    "op2_decontaminate": decontaminate.SQL,
    "op5_quality_rules": quality.SQL,
    "op6_ngram_jaccard_join": ngram_join.SQL,
    "op8_license_scan": licenses.SQL,
    "op11_centroid_clusters": clustering.SQL,
    "op12_sale_enrichment": sale_enrichment.SQL,
}
