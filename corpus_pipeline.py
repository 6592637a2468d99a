"""A corpus pipeline of five training-data operators.

``STAGES`` lists (name, function) in order. Each function takes
(spark, docs, sf_dir) and returns a frame; it is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of
``documents``; ``n_chars`` follows a changed text. The last returns doc_id,
lang, source, n_tokens, token_ids and round_trip (the ids decode to the text).

Null ids, null or empty texts, repeated rows, empty tables and extra columns
are handled as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm import bpe, decontaminate, line_dedup, quality, simhash
from metrolake.llm.common import Scratch, table


def _recount(out: DataFrame, before: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, in the columns' old order."""
    if "n_chars" not in before.columns:
        return out
    n = F.length("text").cast(before.schema["n_chars"].dataType)
    return out.select(*[n.alias(c) if c == "n_chars" else F.col(c) for c in before.columns])


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(line_dedup.drop_lines(docs), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs, shingle=4, max_bits=4)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text")))
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                      same.alias("round_trip"))


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_text),
    ("byte_bpe", tokenize),
]

#: The classifier, SimHash and BPE can't be written in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    old = None
    for name, stage in STAGES:
        docs, path = scratch.save(stage(spark, docs, sf_dir), name)
        if old:
            scratch.drop(old)
        old = path
    return docs
