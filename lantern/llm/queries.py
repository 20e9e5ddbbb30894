"""The subpackage's registered queries: name -> (query, SQL counterpart or None)."""

from lantern.llm import bpe, decontaminate, extract, imatch, importance, likelihood, negatives, pii, quality, simhash, suffixes, toolcalls, warc

QUERIES = {
    "op1_pseudonyms": (pii.op1_pseudonyms, None),
    "op2_tool_calls": (toolcalls.op2_tool_calls, toolcalls.OP2_SQL),
    "op3_simhash": (simhash.op3_simhash, None),
    "op4_imatch": (imatch.op4_imatch, None),
    "op5_decontaminate": (decontaminate.op5_decontaminate, None),
    "op6_extract": (extract.op6_extract, None),
    "op7_byte_bpe": (bpe.op7_byte_bpe, None),
    "op8_suffix_dedup": (suffixes.op8_suffix_dedup, None),
    "op9_warc": (warc.op9_warc, warc.OP9_SQL),
    "op10_quality": (quality.op10_quality, None),
    "op11_rules": (likelihood.op11_rules, likelihood.OP11_SQL),
    "op12_importance": (importance.op12_importance, importance.OP12_SQL),
    "op13_negatives": (negatives.op13_negatives, negatives.OP13_SQL),
}
