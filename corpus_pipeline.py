"""The corpus pipeline: five stages over documents, each written and read again by the next.

Stages, in order: language ID, line dedup, n-gram Jaccard join, benchmark
decontamination, best-fit packing. All but the last return the columns of
``documents``; packing returns a row per piece.

Nulls, empty texts and repeated rows are handled as the operators say. Every stage knows
a row by its id and its text: another text under the id of a row that goes stays, and
rows without an id are judged like others.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from eventlake.llm.store import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the others (null, or without a letter) go."""
    samples = language_id.learn(docs, modulus=4, remainder=2)
    found = language_id.identify(docs, samples, tuple(docs.columns), ("_lang_pred", "_score", "_entropy"))
    return found.where(F.col("_lang_pred") != language_id.UNDETERMINED).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur, or nearly occur, earlier; a document left without any line goes."""
    found = line_dedup.dedup_lines(docs, names=("_n_lines", "_n_dropped"))
    left = found.where("_n_lines > _n_dropped or text is null")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast("long"))
    return left.select(*docs.columns)


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    return ngram_join.without_copies(docs, width=5, percent=80, route="rare")


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row per piece."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, path, capacity=2048, spaces=False, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_ngrams),
    ("benchmark decontamination", decontaminate_benchmark),
    ("best-fit packing", pack),
]

# SQL has no suffix automata, subwords or packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
