"""The corpus pipeline against plain Python, stage by stage; the entry without it."""

import re
import subprocess
import sys
import textwrap

import public_tokenizers

import __spark_entry__ as entry
import corpus_pipeline as C
from tableworks.llm import near_dedup, quality_rules
from tableworks.llm.pii import DEFAULT_KEY
from tests.conftest import SF_SMALL
from tests.llm import test_line_dedup, test_near_dedup, test_packing, test_pii
from tests.llm.data import edge_docs, no_docs, small

ROOT = entry.__file__.rpartition("/")[0]


def test_run_matches_brute_force(spark, monkeypatch):
    docs = [d for d in small("documents")]
    page = {d["doc_id"]: quality_rules.Page(d["text"]) for d in docs}
    docs = [
        d for d in docs
        if page[d["doc_id"]].base()[0] >= 50 and 2 * page[d["doc_id"]].base()[4] <= page[d["doc_id"]].base()[0]
        and not any(rule(page[d["doc_id"]]) for rule in quality_rules.RULES.values())
    ]
    text = test_line_dedup.brute([(d["doc_id"], d["text"], d["source"]) for d in docs], copies_alike=True)
    text = {i: text[i] for i, (_, c) in test_near_dedup.brute(list(text.items())).items() if i == c}
    monkeypatch.setattr(test_pii, "KEY", DEFAULT_KEY)
    text = {i: test_pii.replaced(t) for i, t in text.items()}
    ids = {i: [*x, 0] for i, x in zip(text, test_packing.reference()(list(text.values())))}
    test_packing.check([r.asDict() for r in C.run(spark, SF_SMALL).collect()], ids)


def test_stages_keep_the_columns_and_handle_odd_rows(spark):
    docs = edge_docs(spark)
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, docs, SF_SMALL)
        assert got.schema == docs.schema, name
        assert {str(r) for r in got.collect()} <= {str(r) for r in docs.collect()}
        assert stage(spark, no_docs(spark), SF_SMALL).count() == 0
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "pii", "packing"]


def test_clean_documents_pass_the_filters(spark):
    quality = {r["doc_id"]: r["quality"] for r in small("labels")}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {r["doc_id"] for r in C.quality_rules(spark, docs, SF_SMALL).collect()}
    for d in small("documents"):
        if quality.get(d["doc_id"]) == 1 and len(re.findall(r"\S+", d["text"])) >= 60:
            assert d["doc_id"] in kept


def test_registered_once_each():
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and near_dedup.THRESHOLD_PERCENT == 85
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_entry_works_without_this_subpackage():
    code = """
        import sys
        class Hidden:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name == "tableworks.llm" or name.startswith("tableworks.llm."):
                    raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        sys.meta_path.insert(0, Hidden())
        import __spark_entry__ as e
        q, o = e.queries(), e.oracle_sql()
        assert q and not [k for k in q if k.startswith("op") or k == "pipeline"], q
        assert set(o) <= set(q)
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, check=True, timeout=120)


def test_line_dedup_stage_cleans_short_pages(spark):
    head, foot = "the header line of all the pages here", "the footer line of all the pages here"
    pages = [(i, f"{head}\na paragraph that only page {i} has\n{foot}", f"s{i}") for i in range(8)]
    copies = [(20 + i, f"{head}\none paragraph of all these copies and {'more ' * 9}\n{foot}", f"c{i}") for i in range(7)]
    docs = spark.createDataFrame(pages + copies, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in C.line_dedup(spark, docs, SF_SMALL).collect()}
    assert got[0] == pages[0][1]
    assert all(got[i] == f"a paragraph that only page {i} has" for i in range(1, 8))
    assert {got[20 + i] for i in range(7)} == {copies[0][1].split("\n")[1]}
    assert C.near_dedup(spark, C.line_dedup(spark, docs, SF_SMALL), SF_SMALL).filter("doc_id >= 20").count() == 1
