"""The corpus pipeline: five stages, each one operator over all that the stage before kept.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` writes each stage's rows as Parquet in the shared
folder and reads them back as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableworks.llm.common import table, written
from tableworks.llm.line_dedup import dedup_lines
from tableworks.llm.near_dedup import drop_near_duplicates
from tableworks.llm.packing import pack_documents
from tableworks.llm.pii import pseudonymize
from tableworks.llm.quality_rules import quality_filter
from tableworks.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the cascade rejects go."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go from every document, but for their first place; exact copies stay alike."""
    return dedup_lines(docs, copies_alike=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become format-preserving pseudonyms."""
    return pseudonymize(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is tokenized and packed; one row per piece."""
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizing, keyed permutation and packing have no SQL form; tests compare
#: every stage with a brute-force version.
ORACLE_SQL: str | None = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
