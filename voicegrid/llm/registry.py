"""Queries of the operators, and SQL where it can express them."""

from voicegrid.llm import alignment, language, line_dedup, mixing, near_duplicates, neighbours, pieces, pii, quality_classifier, quality_rules, repeats, token_files, warc

QUERIES = {
    "op1_language": language.op1,
    "op10_pii": pii.op10,
    "op11_runs": repeats.op11,
    "op12_alignment": alignment.op12,
    "op13_token_files": token_files.op13,
    "op2_quality_rules": quality_rules.op2,
    "op3_warc": warc.op3,
    "op4_quality_classifier": quality_classifier.op4,
    "op5_pieces": pieces.op5,
    "op6_near_duplicates": near_duplicates.op6,
    "op7_mixing": mixing.op7,
    "op8_line_dedup": line_dedup.op8,
    "op9_neighbours": neighbours.op9,
}

SQL = {
    "op2_quality_rules": quality_rules.SQL,
    "op3_warc": warc.SQL,
    "op7_mixing": mixing.SQL,
    "op9_neighbours": neighbours.SQL,
}
