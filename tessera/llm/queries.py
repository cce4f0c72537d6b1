"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from tessera.llm import htmltext, infill, interaction, jaccard, lines, mixing, packing, pii, quality, simhash, suffix, toxicity, webp

QUERIES = {
    "op1_document_fingerprints": simhash.op1_document_fingerprints,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_webp_media": webp.op3_webp_media,
    "op4_suffix_array_dedup": suffix.op4_suffix_array_dedup,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_mixing": mixing.op6_mixing,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_html_extraction": htmltext.op9_html_extraction,
    "op10_quality_classifier": quality.op10_quality_classifier,
    "op11_filter_interactions": interaction.op11_filter_interactions,
    "op12_fill_in_middle": infill.op12_fill_in_middle,
    "op13_pii": pii.op13_pii,
}
SQL = {"op5_jaccard_join": jaccard.OP5_SQL, "op8_line_dedup": lines.OP8_SQL, "op9_html_extraction": htmltext.OP9_SQL, "op11_filter_interactions": interaction.OP11_SQL, "op12_fill_in_middle": infill.OP12_SQL}
