"""The queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import sql
from riskloom.llm.centroid_clustering import op11_centroid_clustering
from riskloom.llm.filter_audit import op12_filter_audit
from riskloom.llm.fingerprints import op7_fingerprints
from riskloom.llm.jaccard_join import op3_jaccard_join
from riskloom.llm.language_id import op13_language_id
from riskloom.llm.line_dedup import op5_line_dedup
from riskloom.llm.packing import op4_packing
from riskloom.llm.pii import op9_pii
from riskloom.llm.quality_rules import op2_quality_rules
from riskloom.llm.sentencepiece_sampling import op6_sentencepiece
from riskloom.llm.sharding import op10_sharding
from riskloom.llm.suffix_dedup import op1_suffix_dedup
from riskloom.llm.toxicity import op8_toxicity

_QUERIES = [
    op1_suffix_dedup, op2_quality_rules, op3_jaccard_join, op4_packing, op5_line_dedup, op6_sentencepiece, op7_fingerprints,
    op8_toxicity, op9_pii, op10_sharding, op11_centroid_clustering, op12_filter_audit, op13_language_id,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
