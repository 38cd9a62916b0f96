"""The operators of this package as named queries over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from flowspark.llm import (
    alignment,
    chat_format,
    decontaminate,
    exact_dedup,
    hard_negatives,
    language,
    ngram_join,
    packing,
    personal_data,
    quality,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

QUERIES = {
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op6_language": language.op6_language,
    "op2_quality": quality.op2_quality,
    "op3_toxicity": toxicity.op3_toxicity,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op4_packing": packing.op4_packing,
    "op8_chat_format": chat_format.op8_chat_format,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op11_alignment": alignment.op11_alignment,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_personal_data": personal_data.op13_personal_data,
}
ORACLES = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op7_ngram_join": ngram_join.ORACLE,
    "op8_chat_format": chat_format.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
