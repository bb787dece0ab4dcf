"""The registered queries of the training-data operators."""

from . import codes, decontaminate, fim, lang_id, licenses, line_dedup, lm_score, near_dup, pieces, quality, token_files, url_filter, warc

QUERIES = {f.__name__: f for f in (licenses.op1_license_scan, url_filter.op2_url_filter, token_files.op3_token_files, pieces.op4_sentencepiece, lang_id.op5_language_id, quality.op6_quality, lm_score.op7_lm_score, near_dup.op8_near_duplicates, line_dedup.op9_line_dedup, decontaminate.op10_decontaminate, codes.op11_vector_codes, warc.op12_web_archive, fim.op13_fill_in_middle)}
ORACLES = {"op6_quality": quality.OP6_SQL, "op8_near_duplicates": near_dup.OP8_SQL, "op9_line_dedup": line_dedup.OP9_SQL, "op10_decontaminate": decontaminate.OP10_SQL, "op11_vector_codes": codes.OP11_SQL, "op12_web_archive": warc.OP12_SQL, "op13_fill_in_middle": fim.OP13_SQL}
