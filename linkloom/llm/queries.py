"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from linkloom.llm import covertree, dialogs, html, langid, lines, minhash, mixing, packing, secrets, sharding, substrings, topk, variants

QUERIES = {
    "op1_language_id": langid.query,
    "op2_html_text": html.query,
    "op3_secret_scan": secrets.query,
    "op4_minhash_dedup": minhash.query,
    "op5_cover_tree_dedup": covertree.query,
    "op6_source_mix": mixing.query,
    "op7_maxscore_topk": topk.query,
    "op8_best_fit_packing": packing.query,
    "op9_extendible_sharding": sharding.query,
    "op10_line_dedup": lines.query,
    "op11_substring_dedup": substrings.query,
    "op12_spelling_variants": variants.query,
    "op13_dialog_repair": dialogs.query,
}

ORACLES = {
    "op4_minhash_dedup": minhash.SQL,
    "op5_cover_tree_dedup": covertree.SQL,
    "op7_maxscore_topk": topk.SQL,
    "op9_extendible_sharding": sharding.SQL,
    "op10_line_dedup": lines.SQL,
    "op11_substring_dedup": substrings.SQL,
}
