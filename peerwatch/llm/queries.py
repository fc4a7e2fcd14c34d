"""The queries of this subpackage and their SQL."""

import corpus_pipeline
from peerwatch.llm import bpe, decontaminate, exact_dedup, html_text, language, lattice, line_dedup, merkle, ngram_join, pii, quality, vector_codes, warc

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_quality": quality.op3_quality,
    "op4_language": language.op4_language,
    "op5_bpe": bpe.op5_bpe,
    "op6_pii": pii.op6_pii,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_html_text": html_text.op8_html_text,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_warc": warc.op10_warc,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_lattice": lattice.op12_lattice,
    "op13_merkle": merkle.op13_merkle,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op9_ngram_join": ngram_join.SQL,
    "op10_warc": warc.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op13_merkle": merkle.SQL,
}
