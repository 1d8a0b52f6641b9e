"""The queries of the text operators and, where DuckDB can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from kinspark.llm import sql
from kinspark.llm.chat_format import op6_chat_format
from kinspark.llm.importance import op12_importance
from kinspark.llm.language_id import op8_language_id
from kinspark.llm.line_dedup import op9_line_dedup
from kinspark.llm.nbest_pieces import op7_sentencepiece
from kinspark.llm.order_minhash import op2_order_minhash
from kinspark.llm.packing import op1_packing
from kinspark.llm.page_text import op11_page_text
from kinspark.llm.pivot_clusters import op13_pivot_clusters
from kinspark.llm.quality_model import op10_quality_model
from kinspark.llm.quality_rules import op3_quality_rules
from kinspark.llm.secret_scan import op5_secret_scan
from kinspark.llm.simhash import op4_simhash


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_order_minhash": op2_order_minhash,
        "op3_quality_rules": op3_quality_rules,
        "op4_simhash": op4_simhash,
        "op5_secret_scan": op5_secret_scan,
        "op6_chat_format": op6_chat_format,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_language_id": op8_language_id,
        "op9_line_dedup": op9_line_dedup,
        "op10_quality_model": op10_quality_model,
        "op11_page_text": op11_page_text,
        "op12_importance": op12_importance,
        "op13_pivot_clusters": op13_pivot_clusters,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op3_quality_rules": sql.QUALITY_RULES,
        "op9_line_dedup": sql.LINE_DEDUP,
        "op12_importance": sql.IMPORTANCE,
        "op13_pivot_clusters": sql.PIVOT_CLUSTERS,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: text for name, text in found.items() if text}
