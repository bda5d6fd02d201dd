"""The registered queries of this package and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from wxspark.llm import bloom, chat, language, lines, mixing, neighbours, packing, quality, rans, search, simhash, spelling, toxicity

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_simhash": simhash.op2_simhash,
    "op3_language": language.op3_language,
    "op4_chat": chat.op4_chat,
    "op5_quality": quality.op5_quality,
    "op6_rans": rans.op6_rans,
    "op7_packing": packing.op7_packing,
    "op8_bloom": bloom.op8_bloom,
    "op9_neighbours": neighbours.op9_neighbours,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_lines": lines.op11_lines,
    "op12_search": search.op12_search,
    "op13_spelling": spelling.op13_spelling,
}

ORACLE = {
    "op1_mixing": mixing.ORACLE,
    "op4_chat": chat.ORACLE,
    "op11_lines": lines.ORACLE,
    "op12_search": search.ORACLE,
    "op13_spelling": spelling.ORACLE,
}
