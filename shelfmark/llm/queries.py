"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from shelfmark.llm import (
    bm25,
    langid,
    language_model,
    mixing,
    neighbours,
    nra,
    packing,
    phrases,
    repeats,
    simhash,
    substring,
    token_counts,
    token_files,
)

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_token_files": token_files.op2_token_files,
    "op3_neighbours": neighbours.op3_neighbours,
    "op4_language_model": language_model.op4_language_model,
    "op5_bm25": bm25.op5_bm25,
    "op6_simhash": simhash.op6_simhash,
    "op7_packing": packing.op7_packing,
    "op8_substring": substring.op8_substring,
    "op9_mixing": mixing.op9_mixing,
    "op10_langid": langid.op10_langid,
    "op11_phrases": phrases.op11_phrases,
    "op12_repeats": repeats.op12_repeats,
    "op13_nra": nra.op13_nra,
}
ORACLE = {
    "op5_bm25": bm25.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_phrases": phrases.ORACLE,
    "op13_nra": nra.ORACLE,
}
