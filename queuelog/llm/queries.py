"""Queries of this package and the SQL they must agree with."""

from __future__ import annotations

import corpus_pipeline
from queuelog.llm import (
    boilerplate,
    covertree,
    exact,
    language,
    lexical,
    mixing,
    passages,
    quality,
    simhash,
    topk,
    transducer,
    warc,
    whitening,
)

QUERIES = {
    "op1_passages": passages.op1_passages,
    "op2_simhash": simhash.op2_simhash,
    "op3_lines": boilerplate.op3_lines,
    "op4_mixing": mixing.op4_mixing,
    "op5_topk": topk.op5_topk,
    "op6_warc": warc.op6_warc,
    "op7_language": language.op7_language,
    "op8_quality": quality.op8_quality,
    "op9_sentencepiece": transducer.op9_sentencepiece,
    "op10_embeddings": covertree.op10_embeddings,
    "op11_whitening": whitening.op11_whitening,
    "op12_exact": exact.op12_exact,
    "op13_lexical": lexical.op13_lexical,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_passages": passages.OP1_SQL,
    "op3_lines": boilerplate.OP3_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op5_topk": topk.OP5_SQL,
    "op6_warc": warc.OP6_SQL,
    "op10_embeddings": covertree.OP10_SQL,
    "op12_exact": exact.OP12_SQL,
    "op13_lexical": lexical.OP13_SQL,
}
