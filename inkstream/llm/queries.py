"""One query per operator: ``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds
the DuckDB text of those that SQL can express."""

from __future__ import annotations

from inkstream.llm import (bpe, decontaminate, hard_negatives, html_density, pii, quality, sentencepieces, simhash, spelling,
                           toxicity, url_filter, vafile, warc)

QUERIES = {
    "op1_warc": warc.op1,
    "op2_simhash": simhash.op2,
    "op3_vafile": vafile.op3,
    "op4_pii": pii.op4,
    "op5_toxicity": toxicity.op5,
    "op6_html_density": html_density.op6,
    "op7_bpe": bpe.op7,
    "op8_url_filter": url_filter.op8,
    "op9_quality": quality.op9,
    "op10_decontaminate": decontaminate.op10,
    "op11_sentencepiece": sentencepieces.op11,
    "op12_spelling": spelling.op12,
    "op13_hard_negatives": hard_negatives.op13,
}

SQL: dict[str, str] = {
    "op1_warc": warc.SQL,
    "op3_vafile": vafile.SQL,
    "op10_decontaminate": decontaminate.SQL,
    "op12_spelling": spelling.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
