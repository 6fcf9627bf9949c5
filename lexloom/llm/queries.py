"""Registered queries and SQL checks of the training-data operators."""

from lexloom.llm import chat, decontaminate, fim, hardneg, idcodec, langid, linededup, packing, simhash, suffixdedup, topk, urlfilter, wrappers

QUERIES = {
    "op1_exact_topk": topk.op1_exact_topk,
    "op2_suffix_dedup": suffixdedup.op2_suffix_dedup,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_simhash": simhash.op4_simhash,
    "op5_token_binary": idcodec.op5_token_binary,
    "op6_url_filters": urlfilter.op6_url_filters,
    "op7_line_dedup": linededup.op7_line_dedup,
    "op8_packing": packing.op8_packing,
    "op9_language_id": langid.op9_language_id,
    "op10_chat_format": chat.op10_chat_format,
    "op11_hard_negatives": hardneg.op11_hard_negatives,
    "op12_html_extraction": wrappers.op12_html_extraction,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}
ORACLES = {
    "op1_exact_topk": topk.ORACLE,
    "op6_url_filters": urlfilter.ORACLE,
    "op7_line_dedup": linededup.ORACLE,
    "op10_chat_format": chat.ORACLE,
    "op11_hard_negatives": hardneg.ORACLE,
    "op12_html_extraction": wrappers.ORACLE,
    "op13_fill_in_middle": fim.ORACLE,
}
