"""Fill-in-middle: against plain Python, exact round trips, long runs, edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tableworks.llm import fill_middle as M
from tableworks.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import edge_docs, no_docs, small

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42, fim=50, spm=80):
    """(output, form, n, prefix characters, middle characters)."""
    text = text or ""
    units = UNIT.findall(text)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return text, "plain", n, None, None
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return f"<S>{s}<P>{p}<M>{m}", "spm", n, len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", n, len(p), len(m)


def made(df, **options):
    out = M.fill_in_middle(df, **options)
    return out.withColumn("restored", M.restore_text(F.col("fim_text"), F.col("form")))


def check(rows, **options):
    for r in rows:
        got = (r["fim_text"], r["form"], r["n"], r["prefix_chars"], r["middle_chars"])
        assert got == brute(r["doc_id"], r["text"], **options)
        assert r["restored"] == (r["text"] or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_matches_brute_force(spark):
    got = {r["doc_id"]: r for r in QUERIES["op11_fill_middle"](spark, SF_SMALL).collect()}
    docs = small("documents")
    assert len(got) == len(docs)
    forms = set()
    for d in docs:
        out, form, n, pre, mid = brute(d["doc_id"], d["text"])
        r = got[d["doc_id"]]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, pre, mid)
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(out), sha(d["text"] or ""))
        forms.add(form)
    assert forms == {"plain", "spm", "psm"}


def test_signs_spaces_and_markers(spark):
    texts = [
        "a", " ", "a ", " a", "\n\n\x0b", "x  y z", "\U0001f600 \U0001f601\U0001f602 é", "a\\b $1 ${x} \\1 $", "<", "<P", "<S <M >",
        "P><S >", "a <P> b", "<M>", "<S>x", "\x1c \x85 \x00 q", "{3}+ (?s) \\E",
    ]
    rows = [(i, t) for i, t in enumerate(t for t in texts for _ in range(12))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(made(df, fim_percent=100).collect(), fim=100)
    check(made(df, seed=7, fim_percent=100, spm_percent=0).collect(), seed=7, fim=100, spm=0)
    assert {r["form"] for r in made(df, fim_percent=0).collect()} == {"plain"}


def test_long_runs_need_no_stack(spark):
    texts = ["a b\n" * 200_000, " " * 300_000, "x" * 300_000, "- " * 100_000 + " " * 50_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    check(made(df, fim_percent=100).collect(), fim=100)


def test_edges(spark):
    rows = made(edge_docs(spark).drop("n_words")).collect()
    assert len(rows) == 11
    check(rows)
    assert M.fill_in_middle(no_docs(spark)).count() == 0
    with pytest.raises(ValueError, match="already"):
        M.fill_in_middle(edge_docs(spark).withColumn("form", F.lit("x")))


def test_plan_has_no_shuffle_and_no_python(spark):
    from tests.plans import final_plan_text

    plan = final_plan_text(QUERIES["op11_fill_middle"](spark, SF_SMALL))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
