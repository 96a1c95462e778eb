"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import ann, bpe, chat, langid, lines, minhash, mixing, quality, simhash, spelling, substrings, suffixes, whitening

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_chat_format": chat.op2_chat_format,
    "op3_suffix_dedup": suffixes.op3_suffix_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_minhash": minhash.op5_minhash,
    "op6_ann": ann.op6_ann,
    "op7_bpe": bpe.op7_bpe,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_langid": langid.op9_langid,
    "op10_simhash": simhash.op10_simhash,
    "op11_spelling": spelling.op11_spelling,
    "op12_whitening": whitening.op12_whitening,
    "op13_substrings": substrings.op13_substrings,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op2_chat_format": chat.OP2_SQL,
    "op5_minhash": minhash.OP5_SQL,
    "op8_line_dedup": lines.OP8_SQL,
    "op13_substrings": substrings.OP13_SQL,
}
