"""A corpus from documents to token files, in five written stages.

Each stage gets the documents that its predecessor kept, as a reread Parquet
table, and returns the columns of ``documents``; the last one returns a row
per document of the token files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.llm import decontamination, language, mixing, ngram_join, token_files
from propensa.llm.catalog import TOKENIZER
from propensa.llm.tables import read
from propensa.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.30  # below it no language fits: with four languages, chance alone gives 0.25
LEAST_LEAD = 1 / 15  # with more languages: the part of the way from chance to certainty, the same 0.30 with four


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows. Without a letter, or with no language ahead, they go."""
    network = language.fit(docs)
    scored = language.predict(docs.select(COLUMNS), network)
    chance = 1 / max(1, len(network.languages))
    least = min(LEAST_SCORE, round(chance + (1 - chance) * LEAST_LEAD, 5))  # the more languages, the lower
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least)
    return scored.where(known).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id."""
    return ngram_join.one_of_each(docs.select(COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, by training position."""
    return mixing.curriculum(mixing.assign(mixing.sized(docs.select(COLUMNS)))).select(COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32, shard, segment."""
    return token_files.read_back(spark, token_files.write(docs, TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# A trained network, connected components and a vocabulary are not SQL; the tests hold each stage
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
