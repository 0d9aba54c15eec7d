"""The queries of this subpackage and the SQL some of them are checked against."""

from __future__ import annotations

from dropforge.llm import (
    chat_format, decontaminate, embedding_dedup, html_extract, katz, line_dedup, minhash, periodic_runs, quality, ranked_search, source_mix,
    suffix_dedup, toxicity,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_html_extract": html_extract.op3_html_extract,
    "op4_minhash": minhash.op4_minhash,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_source_mix": source_mix.op6_source_mix,
    "op7_quality": quality.op7_quality,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_katz": katz.op9_katz,
    "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_chat_format": chat_format.op13_chat_format,
}
SQL = {
    "op1_line_dedup": line_dedup.SQL,
    "op6_source_mix": source_mix.SQL,
    "op11_ranked_search": ranked_search.SQL,
    "op13_chat_format": chat_format.SQL,
}
