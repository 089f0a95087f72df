"""Quality rules as a short-circuit cascade.

Every document first gets a few base counts.  Then named rules, each a cheap
test on the text's words, run one after the other; a document leaves at the
first rule that rejects it.  Because a document is kept only if no rule rejects
it, the order of the rules changes the cost but never the verdict.  The order
comes from a sample: each rule's seconds and rejections are measured there, and
rules run by rejections per second, highest first.

Defined results: a null text counts as empty (no words, rejected by the base
rule); white space alone is empty as well; repeated rows are judged alike; an
empty table gives an empty result; other columns are ignored or, in
``quality_filter``, carried unchanged whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tableworks.llm.common import slices, workers_find_package

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SAMPLE_DOCUMENTS = 2000  # documented bound of the sample that sets the order

# Characters that count as symbols; white space between words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"

BASE_SCHEMA = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("word_chars", T.LongType(), False),
        T.StructField("n_symbols", T.LongType(), False),
        T.StructField("n_dup_lines", T.LongType(), False),
        T.StructField("n_repeat_words", T.LongType(), False),
    ]
)


class Page:
    """One text with the counts that rules share, each computed at most once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.words = self.text.encode("utf-8", "surrogatepass").split()
        self._keys: np.ndarray | None = None

    @property
    def keys(self) -> np.ndarray:
        """One 64-bit key per word; equal words have equal keys."""
        if self._keys is None:
            self._keys = np.fromiter(map(hash, self.words), np.int64, len(self.words)).astype(np.uint64)
        return self._keys

    def base(self) -> tuple[int, int, int, int, int]:
        text = self.text
        n_chars = len(text) - sum(map(text.count, SPACES))
        return len(self.words), n_chars, sum(map(text.count, SYMBOLS)), self.dup_lines(), self.repeat_words()

    def dup_lines(self) -> int:
        lines = [x for x in self.text.split("\n") if x.strip(SPACES)]
        return len(lines) - len(set(lines))

    def repeat_words(self) -> int:
        """Words inside a 3-word window that occurs at least twice in the text."""
        n = len(self.words)
        if n < 4:
            return 0
        k = self.keys
        a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        window = ((k[:-2] * a) ^ (k[1:-1] >> np.uint64(29))) * b + k[1:-1] * a
        window = (window ^ (window >> np.uint64(31))) * b + k[2:]
        order = np.argsort(window, kind="stable")
        ranked = window[order]
        same = ranked[1:] == ranked[:-1]
        if not same.any():
            return 0
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.zeros(n, bool)
        hit[:-2] |= twice
        hit[1:-1] |= twice
        hit[2:] |= twice
        return int(hit.sum())


def _symbol_heavy(p: Page) -> bool:
    return sum(map(p.text.count, SYMBOLS)) * 10 > 3 * len(p.words)


def _shouting(p: Page) -> bool:
    raw = p.text.encode("utf-8", "surrogatepass")
    upper = len(raw) - len(raw.translate(None, UPPER))
    letters = upper + len(raw) - len(raw.translate(None, LOWER))
    return letters >= 40 and upper * 10 > 6 * letters


def _marked_words(p: Page) -> bool:
    return 10 * sum(w.endswith((b"!!", b"??", b"...")) for w in p.words) > 3 * len(p.words)


def _few_letters(p: Page) -> bool:
    return 10 * sum(any(c >= 128 or 65 <= c <= 90 or 97 <= c <= 122 for c in w) for w in p.words) < 6 * len(p.words)


def _odd_word_length(p: Page) -> bool:
    chars = len(p.text) - sum(map(p.text.count, SPACES))
    return not 2 * len(p.words) <= chars <= 14 * len(p.words)


def _dup_lines(p: Page) -> bool:
    lines = [x for x in p.text.split("\n") if x.strip(SPACES)]
    return len(lines) >= 4 and 2 * (len(lines) - len(set(lines))) > len(lines)


def _one_word(p: Page) -> bool:
    if len(p.words) < 20:
        return False
    _, n = np.unique(p.keys, return_counts=True)
    return 10 * int(n.max()) > 4 * len(p.words)


RULES: dict[str, Callable[[Page], bool]] = {
    "symbol_heavy": _symbol_heavy,
    "shouting": _shouting,
    "marked_words": _marked_words,
    "few_letters": _few_letters,
    "odd_word_length": _odd_word_length,
    "dup_lines": _dup_lines,
    "one_word": _one_word,
}


def _measure(batches: Iterator[pa.RecordBatch], rules: dict[str, Callable[[Page], bool]]) -> Iterator[pa.RecordBatch]:
    """Seconds and rejections of every rule, each on a page of its own."""
    spent, rejected, seen = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
    for batch in slices(batches):
        for text in batch.column(0).to_pylist():
            seen += 1
            for name, rule in rules.items():
                page = Page(text)
                t0 = time.perf_counter()
                rejected[name] += bool(rule(page))
                spent[name] += time.perf_counter() - t0
    yield pa.RecordBatch.from_pydict(
        {"rule": list(rules), "seconds": list(spent.values()), "rejected": list(rejected.values()), "seen": [seen] * len(rules)},
        pa.schema([("rule", pa.string()), ("seconds", pa.float64()), ("rejected", pa.int64()), ("seen", pa.int64())]),
    )


def rule_order(
    docs: DataFrame, text_col: str = "text", rules: dict[str, Callable[[Page], bool]] | None = None, sample: int = SAMPLE_DOCUMENTS
) -> list[str]:
    """Rule names by rejections per second on a sample of about ``sample`` rows.

    The sample is drawn row by row in every partition, so no task gathers it.
    Ties, and rules that reject nothing, fall back to the lower cost, then the name.
    """
    rules = rules or RULES
    workers_find_package(docs.sparkSession)
    share = min(1.0, sample / max(docs.count(), 1))
    few = docs.select(F.col(text_col).alias("text")).sample(share, seed=8)
    rows = (
        few.mapInArrow(partial(_measure, rules=rules), "rule string, seconds double, rejected long, seen long")
        .groupBy("rule")
        .agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
        .collect()
    )
    cost = {r["rule"]: (r["seconds"], r["rejected"]) for r in rows}

    def rank(name: str) -> tuple[float, float, str]:
        seconds, rejected = cost.get(name, (0.0, 0))
        return -rejected / max(seconds, 1e-9), seconds, name

    return sorted(rules, key=rank)


def _judge(batches: Iterator[pa.RecordBatch], cascade: list[tuple[str, Callable[[Page], bool]]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        bases, failed, first = [], [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            page = Page(text)
            base = page.base()
            bases.append(base)
            failed.append(base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEATED_PERCENT * base[0])
            first.append(None if failed[-1] else next((name for name, rule in cascade if rule(page)), None))
        counts = np.array(bases, np.int64).reshape(len(bases), 5)
        columns = [*batch.columns[:-1], *(pa.array(counts[:, i]) for i in range(5))]
        kept = [not f and r is None for f, r in zip(failed, first)]
        columns += [pa.array(failed, pa.bool_()), pa.array(first, pa.string()), pa.array(kept, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, Callable[[Page], bool]] | None = None
) -> DataFrame:
    """Base counts and verdict of every document, one scan without a shuffle.

    Returns the id, the counts of ``BASE_SCHEMA``, ``base_failed``,
    ``rejected_by`` (the first rule of the cascade that rejected it; null if
    none or if the base rule did) and ``kept``.
    """
    rules = rules or RULES
    workers_find_package(docs.sparkSession)
    order = rule_order(docs, text_col, rules)
    one = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    out = T.StructType(
        [one.schema.fields[0], *BASE_SCHEMA.fields]
        + [T.StructField("base_failed", T.BooleanType(), False), T.StructField("rejected_by", T.StringType()), T.StructField("kept", T.BooleanType(), False)]
    )
    arrow = to_arrow_schema(out)
    return one.mapInArrow(partial(_judge, cascade=[(n, rules[n]) for n in order], schema=arrow), out)


def quality_filter(docs: DataFrame, text_col: str = "text", rules: dict[str, Callable[[Page], bool]] | None = None) -> DataFrame:
    """The documents that the base rule and the cascade keep, all columns unchanged."""
    rules = rules or RULES
    workers_find_package(docs.sparkSession)
    order = rule_order(docs, text_col, rules)
    return docs.mapInArrow(partial(_keep, cascade=[(n, rules[n]) for n in order], at=docs.columns.index(text_col)), docs.schema)


def _keep(batches: Iterator[pa.RecordBatch], cascade: list[tuple[str, Callable[[Page], bool]]], at: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        keep = []
        for text in batch.column(at).to_pylist():
            page = Page(text)
            n = len(page.words)
            # cheapest first: length, then the cascade, then repeated windows
            keep.append(n >= MIN_WORDS and not any(rule(page) for _, rule in cascade) and 100 * page.repeat_words() <= MAX_REPEATED_PERCENT * n)
        yield batch.filter(pa.array(keep, pa.bool_()))
