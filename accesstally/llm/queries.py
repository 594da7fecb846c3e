"""The operators as registered queries."""

from __future__ import annotations

from accesstally.llm import (
    bpe,
    decontaminate,
    language,
    license,
    near_duplicates,
    neighbours,
    pages,
    passages,
    resampling,
    secrets,
    sharding,
    toxicity,
    vector_codes,
)


def queries():
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_bpe": bpe.op3_bpe,
        "op4_neighbours": neighbours.op4_neighbours,
        "op5_pages": pages.op5_pages,
        "op6_repeats": passages.op6_repeats,
        "op7_secrets": secrets.op7_secrets,
        "op8_license": license.op8_license,
        "op9_near_duplicates": near_duplicates.op9_near_duplicates,
        "op10_language": language.op10_language,
        "op11_sharding": sharding.op11_sharding,
        "op12_codes": vector_codes.op12_codes,
        "op13_resampling": resampling.op13_resampling,
    }


def oracle_sql():
    return {
        "op1_decontaminate": decontaminate.OP1_SQL,
        "op6_repeats": passages.OP6_SQL,
        "op8_license": license.OP8_SQL,
        "op9_near_duplicates": near_duplicates.OP9_SQL,
        "op11_sharding": sharding.OP11_SQL,
        "op12_codes": vector_codes.OP12_SQL,
        "op13_resampling": resampling.OP13_SQL,
    }
