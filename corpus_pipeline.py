"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Every stage but the last returns the columns of its input, works on all that the stage
before it kept, and makes its decisions on whole texts:

1. ``language_id`` drops what has no language: a null text or one without a letter.
2. ``line_dedup`` takes repeated lines out of all but the first document that holds them.
3. ``ngram_jaccard`` keeps one document, that of the smallest id, of each group of similar ones.
4. ``decontamination`` drops documents that hold benchmark passages.
5. ``packing`` cuts the rest into pieces and packs these into sequences.

Nulls in other columns, repeated rows, empty tables and more columns pass through; the
operators' docstrings say what each does with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.llm import decontaminate, jaccard, langid, line_dedup, queries
from meterlens.llm.store import fresh, ship, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. The network learns from the labelled ones among ``docs``; without any, what has a letter stays."""
    ship(spark)
    net = langid.fit(docs)
    if net is None:
        return docs.where(langid.has_letter("text"))
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    named = langid.identify(docs, net, keep_text=True, lang_out=lang, score_out=score)
    return named.where(F.col(lang) != langid.UNKNOWN).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the lines that stay; ``n_chars`` follows the text."""
    ship(spark)
    lines, dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    left = line_dedup.drop_repeated_lines(docs, lines_out=lines, dropped_out=dropped)
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    ship(spark)
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated."""
    ship(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    ship(spark)
    return queries.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("packing", packing_stage),
]

#: Training and applying a network and token ids are beyond SQL: tests hold the result against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
