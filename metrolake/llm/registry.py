"""Queries of the training-data operators and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from metrolake.llm import (
    alignment,
    bpe,
    content_sort,
    decontaminate,
    fim,
    htmltext,
    langid,
    line_dedup,
    lm,
    pivots,
    quality,
    sharding,
    simhash,
)


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_embeddings": pivots.op1_embeddings,
        "op2_decontaminate": decontaminate.op2_decontaminate,
        "op3_html": htmltext.op3_html,
        "op4_sharding": sharding.op4_sharding,
        "op5_quality": quality.op5_quality,
        "op6_bpe": bpe.op6_bpe,
        "op7_langid": langid.op7_langid,
        "op8_simhash": simhash.op8_simhash,
        "op9_line_dedup": line_dedup.op9_line_dedup,
        "op10_lm": lm.op10_lm,
        "op11_fim": fim.op11_fim,
        "op12_alignment": alignment.op12_alignment,
        "op13_exact_dedup": content_sort.op13_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_embeddings": pivots.ORACLE_SQL,
            "op2_decontaminate": decontaminate.ORACLE_SQL,
            "op9_line_dedup": line_dedup.ORACLE_SQL,
            "op11_fim": fim.ORACLE_SQL,
            "op13_exact_dedup": content_sort.ORACLE_SQL}
