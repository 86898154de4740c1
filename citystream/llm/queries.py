"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from citystream.llm.chat import CHAT_SQL, op5_chat_format
from citystream.llm.decontam import op8_decontamination
from citystream.llm.divergence import DIVERGENCE_SQL, op12_source_divergence
from citystream.llm.hardneg import HARD_NEGATIVE_SQL, op11_hard_negatives
from citystream.llm.htmlmain import op7_html_text
from citystream.llm.langid import op9_language_id
from citystream.llm.neardup import NEAR_DUPLICATE_SQL, op1_near_duplicates
from citystream.llm.ngramjoin import NGRAM_JOIN_SQL, op13_ngram_join
from citystream.llm.tokens import op2_token_binary
from citystream.llm.topk import TOP_K_SQL, op4_exact_top_k
from citystream.llm.toxicity import op10_toxicity
from citystream.llm.warc import WARC_SQL, op3_warc
from citystream.llm.wordbpe import op6_word_bpe

QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_token_binary": op2_token_binary,
    "op3_warc": op3_warc,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_chat_format": op5_chat_format,
    "op6_word_bpe": op6_word_bpe,
    "op7_html_text": op7_html_text,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_source_divergence": op12_source_divergence,
    "op13_ngram_join": op13_ngram_join,
}

#: Queries that SQL can express on whole tables; the others are tested against
#: brute force, exact round trips or held-out accuracy in tests/llm.
ORACLE = {
    "op1_near_duplicates": NEAR_DUPLICATE_SQL,
    "op3_warc": WARC_SQL,
    "op5_chat_format": CHAT_SQL,
    "op4_exact_top_k": TOP_K_SQL,
    "op11_hard_negatives": HARD_NEGATIVE_SQL,
    "op12_source_divergence": DIVERGENCE_SQL,
    "op13_ngram_join": NGRAM_JOIN_SQL,
}
