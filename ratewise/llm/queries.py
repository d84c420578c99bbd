"""Registered queries of the training-data operators and their DuckDB SQL."""

from ratewise.llm import (alignment, chat, filter_audit, fuzzy_lines, language, line_rules, pii, quality, sentencepiece_bpe,
                          simhash, token_counts, topk, winnow)

QUERIES = {
    "op1_language": language.op1_language,
    "op2_quality": quality.op2_quality,
    "op3_simhash": simhash.op3_simhash,
    "op4_chat": chat.op4_chat,
    "op5_sentencepiece": sentencepiece_bpe.op5_sentencepiece,
    "op6_fuzzy_lines": fuzzy_lines.op6_fuzzy_lines,
    "op7_line_rules": line_rules.op7_line_rules,
    "op8_winnow": winnow.op8_winnow,
    "op9_pii": pii.op9_pii,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_topk": topk.op11_topk,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_alignment": alignment.op13_alignment,
}

SQL: dict[str, str] = {
    "op4_chat": chat.SQL,
    "op7_line_rules": line_rules.SQL,
    "op8_winnow": winnow.SQL,
    "op11_topk": topk.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
