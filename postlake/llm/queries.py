"""The operators of this package as queries over the test tables, and the SQL that checks them."""

from __future__ import annotations

from postlake.llm import bpe, collocations, contamination, licenses, neardup, passages, pii, prefixjoin, quality, repair, sitelines, tokenfiles, unigram

QUERIES = {
    "op1_licenses": licenses.query,
    "op2_token_files": tokenfiles.query,
    "op3_personal_data": pii.query,
    "op4_passages": passages.query,
    "op5_site_lines": sitelines.query,
    "op6_bpe": bpe.query,
    "op7_quality": quality.query,
    "op8_token_counts": unigram.query,
    "op9_leaks": contamination.query,
    "op10_near_duplicates": neardup.query,
    "op11_conversations": repair.query,
    "op12_collocations": collocations.query,
    "op13_jaccard_join": prefixjoin.query,
}
SQL = {
    "op1_licenses": licenses.SQL,
    "op5_site_lines": sitelines.SQL,
    "op9_leaks": contamination.SQL,
    "op11_conversations": repair.SQL,
    "op12_collocations": collocations.SQL,
}
