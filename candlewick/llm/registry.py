"""Queries of the training-data operators, and their DuckDB SQL."""

from candlewick.llm import (
    bpe,
    chat,
    decontaminate,
    divergence,
    html_text,
    jaccard_join,
    lang_id,
    license_scan,
    line_dedup,
    quality,
    url_filter,
    warc,
    whitening,
)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_language_id": lang_id.op3_language_id,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_warc": warc.op9_warc,
    "op10_html_text": html_text.op10_html_text,
    "op11_whiten": whitening.op11_whiten,
    "op12_chat_format": chat.op12_chat_format,
    "op13_source_divergence": divergence.op13_source_divergence,
}

# Language ID, decontamination, BPE, HTML extraction and whitening are tested
# in tests/llm by held-out accuracy, brute force and exact round trips.
ORACLE = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op2_license_scan": license_scan.OP2_SQL,
    "op4_jaccard_join": jaccard_join.OP4_SQL,
    "op5_quality_rules": quality.OP5_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op9_warc": warc.OP9_SQL,
    "op12_chat_format": chat.OP12_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
