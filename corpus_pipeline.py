"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the
columns of ``documents``; ``n_chars``, where there is one, follows the text. An empty input passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import jaccard_join, line_dedup, packing, pii, quality_rules
from riskloom.llm.common import documents, saved


def _with_text(rows: DataFrame, text: Column, names: list[str]) -> DataFrame:
    """The columns of ``rec``, with another text."""
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return rows.select(*[new.get(c, F.col("rec")[c]).alias(c) for c in names])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the fixed limits or that a learned rule takes go; null and empty texts fail the limits.

    Repeated rows are judged alike. Labels without an id or a value teach nothing; without labels only the limits count.
    """
    rules = quality_rules.learn_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judge(docs, rules).where("kept").select("rec.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go everywhere; documents stay, if need be empty. Each row counts as a
    document, repeated ones too; null texts become empty ones."""
    return _with_text(line_dedup.drop_common_lines(docs), F.col("kept_text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, Jaccard 0.8): that with the smallest id, null ids
    last. Documents without words are nobody's copies; of rows equal in id and text one stays."""
    return jaccard_join.one_per_group(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become <KIND>. Null texts become empty ones; repeated rows each stay."""
    found = pii.detect(docs)
    return _with_text(found, pii.redact(F.coalesce(F.col("rec.text"), F.lit("")), F.col("spans")), docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it; a null or empty text is one id. Repeated rows are each packed."""
    return packing.pack_documents(docs, with_ids=True).drop("text_key")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("packing", sequences),
]

#: A learned rule list and a tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = saved(docs)
    return docs
