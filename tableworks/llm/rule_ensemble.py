"""Quality classifier: a sparse ensemble of rules.

1. One pass gives every text a row of statistics (``FEATURES``).
2. A random forest of shallow trees is grown on labelled rows; every path from a
   root to a node becomes a conjunctive rule over the statistics.
3. A lasso logistic regression over the rules' truth values keeps a few of them.
4. The surviving rules and weights are compiled into one Spark column
   expression, which scores all rows without Python.

Trees and weights are fitted by Spark over all labelled rows of the training
folds; nothing is collected but the model itself, whose size is bounded by
``TREES`` and ``DEPTH``.

Defined results: null and empty texts have statistics of 0 and get a score like
any other; equal texts get equal scores; without labels of both classes the
score is the share of label 1 among the labels (0.5 without any); a null id is
never held out and never trained on; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableworks.llm.common import workers_find_package, written
from tableworks.llm.quality_rules import Page

TREES, DEPTH = 16, 3
LASSO = 0.002
FOLDS, HELD_OUT_FOLD = 3, 1

FEATURES = (
    "log_words", "mean_word", "spread_word", "symbols", "bars", "exclamations", "upper", "digits",
    "punctuation", "other_bytes", "line_feeds", "repeated_lines", "repeated_words", "distinct_words", "top_word",
)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _bytes(chars: str) -> list[int]:
    return list(chars.encode())


def statistics(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for one whole text; shares are of bytes, words or lines."""
    page = Page(text)
    n = len(page.words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(page.text.encode("utf-8", "surrogatepass"), np.uint8)
    of = np.bincount(raw, minlength=256)
    solid = float(len(raw) - of[_SPACE].sum())
    edges = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8))
    length = np.flatnonzero(edges == 1) - np.flatnonzero(edges == -1)
    upper, lower = of[65:91].sum(), of[97:123].sum()
    _, times = np.unique(page.keys, return_counts=True)
    lines = of[10] + 1
    return [
        float(np.log1p(n)), float(length.mean()), float(length.std()),
        of[_bytes("#*$%&<>")].sum() / solid, of[124] / solid, of[33] / solid,
        upper / max(1.0, float(upper + lower)), of[48:58].sum() / solid, of[_bytes(".,;:?")].sum() / solid,
        of[128:].sum() / solid, float(lines) / n, page.dup_lines() / float(lines), page.repeat_words() / n,
        len(times) / n, float(times.max()) / n,
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([statistics(t) for t in batch.column(1).to_pylist()], float).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T)], ["id", *FEATURES])


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one double per feature) for every row."""
    workers_find_package(docs.sparkSession)
    one = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return one.mapInArrow(_statistics, "id long, " + ", ".join(f"{f} double" for f in FEATURES))


def held_out(id_col: Column) -> Column:
    """True for ids whose checksum falls into the fold that is never trained on."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


@dataclass(frozen=True)
class Test:
    """feature <= bound, or its opposite."""

    feature: str
    at_most: bool
    bound: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c <= self.bound if self.at_most else c > self.bound


Rule = tuple[Test, ...]


def tree_rules(description: str) -> list[Rule]:
    """The path to every node below the root, read from a fitted tree's own description.

    Its lines are ``If (feature k <= bound)`` and ``Else (feature k > bound)``,
    indented one step per level.
    """
    path: list[tuple[int, Test]] = []
    rules: list[Rule] = []
    for line in description.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        indent = len(m[1])
        path = [p for p in path if p[0] < indent]
        path.append((indent, Test(FEATURES[int(m[2])], m[3] == "<=", float(m[4]))))
        rules.append(_tightest([t for _, t in path]))
    return rules


def _tightest(tests: list[Test]) -> Rule:
    """At most one lower and one upper bound per feature, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for t in tests:
        key, choose = (t.feature, t.at_most), min if t.at_most else max
        bounds[key] = choose(bounds.get(key, t.bound), t.bound)
    return tuple(Test(f, low, b) for (f, low), b in sorted(bounds.items()))


def rule_column(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (t.column() for t in rule))


@dataclass
class RuleEnsemble:
    """Weighted rules; ``score`` is the compiled column expression."""

    intercept: float
    weights: dict[Rule, float]

    def score(self) -> Column:
        margin = F.lit(float(self.intercept))
        for rule, w in self.weights.items():
            margin = margin + F.when(rule_column(rule), float(w)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-margin))


def fit_rules(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleEnsemble:
    """Fit on rows with the features and a 0/1 ``label``."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1:
        share = 0.5 if not n0 + n1 else min(max(n1 / (n0 + n1), 1e-6), 1 - 1e-6)
        return RuleEnsemble(float(np.log(share / (1 - share))), {})
    rows = labelled.select(
        F.col("label").cast("double").alias("label"), array_to_vector(F.array(*FEATURES)).alias("features"), *FEATURES
    )
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=10, subsamplingRate=0.7, featureSubsetStrategy="sqrt")
    fitted = forest.fit(rows.select("label", "features"))
    rules = list(dict.fromkeys(r for tree in fitted.trees for r in tree_rules(tree.toDebugString)))
    truth = written(
        labelled.select(F.col("label").cast("double").alias("label"), F.array(*[rule_column(r).cast("double") for r in rules]).alias("truth")),
        "rule-truth",
    ).select("label", array_to_vector("truth").alias("features"))
    logit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(truth)
    return RuleEnsemble(float(logit.intercept), {r: float(w) for r, w in zip(rules, logit.coefficients) if w})


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    Learns from labelled rows outside the held-out fold; the label, id and all
    columns but the text never enter a score.
    """
    features = written(feature_table(docs, id_col, text_col), "statistics")
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    labelled = written(features.join(known.dropDuplicates(["id", "label"]), "id"), "labelled")
    model = fit_rules(labelled)
    score = model.score()
    return features.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )
