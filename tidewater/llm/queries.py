"""Queries of the corpus operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidewater.llm import bpe, chat, decontaminate, exact, html, jaccard, langid, quality, secrets, tokencount


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate, "op2_chat": chat.op2_chat, "op3_html": html.op3_html, "op4_bpe": bpe.op4_bpe, "op5_langid": langid.op5_langid, "op6_tokens": tokencount.op6_tokens,
        "op7_quality": quality.op7_quality, "op8_secrets": secrets.op8_secrets, "op9_jaccard": jaccard.op9_jaccard, "op10_exact": exact.op10_exact, "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": chat.OP2_SQL, "op9_jaccard": jaccard.OP9_SQL, "op10_exact": exact.OP10_SQL} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
