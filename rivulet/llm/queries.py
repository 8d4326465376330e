"""The queries of this subpackage and, where SQL can express them, their SQL."""

from rivulet.llm import chat, contamination, fingerprints, language, lines, mixing, pii, quality, runs, scoring, search, simhash, substrings

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_language": language.op3_language,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_mixing": mixing.op5_mixing,
    "op6_pii": pii.op6_pii,
    "op7_decontamination": contamination.op7_decontamination,
    "op8_simhash": simhash.op8_simhash,
    "op9_chat_format": chat.op9_chat_format,
    "op10_scoring": scoring.op10_scoring,
    "op11_runs": runs.op11_runs,
    "op12_ranked_search": search.op12_ranked_search,
    "op13_quality": quality.op13_quality,
}

SQL = {
    "op2_substring_dedup": substrings.OP2_SQL,
    "op4_line_dedup": lines.OP4_SQL,
    "op7_decontamination": contamination.OP7_SQL,
    "op9_chat_format": chat.OP9_SQL,
    "op12_ranked_search": search.OP12_SQL,
}
