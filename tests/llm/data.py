"""Inputs that the tests of this folder share."""

from __future__ import annotations

import pyarrow.parquet as pq

from tests.conftest import SF_SMALL

LONG = " ".join(f"word{i % 977}x{i}" for i in range(20000))

#: Nulls in every column, empty and blank and long texts, ties, repeated rows,
#: and columns whose names operators use inside.
EDGE_ROWS = [
    (1, "", "en", "a", 0, "x", True, 1.0, 7),
    (2, None, "en", "a", None, "x", True, 1.0, 7),
    (3, " \t\n ", None, None, 4, None, None, None, None),
    (4, "one two", "en", "b", 7, "x", True, 1.0, 7),
    (5, "one two", "en", "b", 7, "x", True, 1.0, 7),
    (5, "one two", "en", "b", 7, "x", True, 1.0, 7),
    (None, "one two", "en", "b", 7, "x", True, 1.0, 7),
    (None, None, None, None, None, None, None, None, None),
    (6, LONG, "en", "c", len(LONG), "x", True, 1.0, 7),
    (7, LONG + " tail", "en", "c", len(LONG) + 5, "x", True, 1.0, 7),
    (-8, "é ß 日本 ▁ \U0001f600  x", "zz", "d", 9, "x", False, 0.0, -1),
]
EDGE_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id string, kept boolean, score double, n_words long"
)


def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def small(name: str) -> list[dict]:
    return pq.read_table(f"{SF_SMALL}/{name}.parquet").to_pylist()


def words(text: str | None) -> list[bytes]:
    """Lower-cased words by the contract's pattern."""
    import re

    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
