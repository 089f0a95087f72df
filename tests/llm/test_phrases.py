"""Collocations: against plain counting, compacted paths, exact arithmetic, edge cases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tableworks.llm import phrases as P
from tableworks.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import EDGE_ROWS, edge_docs, no_docs, small

LOWER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        if words := re.findall(r"[^\x20\x09]+", piece):
            yield words


def counts(docs):
    """Occurrences of every phrase of one to three words, by language."""
    f = defaultdict(Counter)
    for lang, text in docs:
        for ws in pieces(text):
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    return f


def brute(docs, least=10, top=2000, contained=50):
    out = []
    for lang, f in counts(docs).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        gone = {part for p, c in often.items() if len(p) == 3 for part in (p[:2], p[1:]) if 100 * c >= contained * f[part]}
        found = []
        for p, a in often.items():
            if p in gone:
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, docs):
    return spark.createDataFrame(docs, "lang string, text string")


def random_docs(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "c", "Ä", "日", "B", "x1", "a"]
    passage = "one two three four five six seven eight"
    docs = []
    for _ in range(n):
        some = [rng.choice([rng.choice(words), passage, passage[4:23], "q r", ". ", ",\n", "\t", "  "]) for _ in range(rng.randrange(25))]
        docs.append((rng.choice(["en", "de", None, "und", ""]), " ".join(some) or None))
    return docs


def test_query_matches_brute_force(spark):
    got = QUERIES["op12_phrase_graph"](spark, SF_SMALL)
    assert rows(got) == brute([(d["lang"], d["text"]) for d in small("documents")])
    assert all(t == "bigint" for c, t in got.dtypes if c not in ("lang", "phrase"))


@pytest.mark.parametrize("least, contained, top", [(10, 50, 2000), (2, 80, 2000), (3, 100, 7)])
def test_random_texts(spark, least, contained, top):
    docs = random_docs(least, 150)
    got = P.collocations(frame(spark, docs), min_count=least, contained_percent=contained, top=top)
    assert rows(got) == brute(docs, least, top, contained)


def test_segments_and_blocks_change_nothing(spark, monkeypatch):
    docs = random_docs(9, 120)
    data = b"\n".join("\n".join(" ".join(ws) for ws in pieces(t)).encode() for _, t in docs)
    want = Counter()
    for part in data.decode().split("\n"):
        ws = part.split()
        want.update(" ".join(ws[i : i + 3]) for i in range(len(ws)))
    for segment in (1, 2, 7, 1 << 19):
        monkeypatch.setattr(P, "_SEGMENT", segment)
        got = Counter()
        for phrases, c, hashes in P.count_grams(data):
            assert len(phrases) == len(c) == len(hashes)
            for x, y in zip(phrases.to_pylist(), c.tolist()):
                got[x.decode()] += y
        assert got == want


def test_many_buckets_and_small_blocks(spark, monkeypatch):
    docs = random_docs(12, 150)
    for name in ("PARTITION_BYTES", "_HELD_BYTES", "_MERGE_ROWS"):
        monkeypatch.setattr(P, name, 500)
    assert rows(P.collocations(frame(spark, docs), min_count=4)) == brute(docs, 4)


def test_paths_carry_every_frequent_edge_once(spark):
    passage = " ".join(f"w{i}" for i in range(70))
    docs = [("en", f"{passage}. begin w3 w4 w5 end. w60 w61 w62")] * 12 + [("en", "a a a a a"), ("en", "x y x y x y")] * 11
    flows = P.phrase_flows(frame(spark, docs))
    paths = P.compact_paths(flows).collect()
    f = counts(docs)["en"]
    want = {p: c for p, c in f.items() if len(p) == 3 and c >= 10}
    got = Counter()
    for p in paths:
        ws = p["words"]
        assert (p["first_flow"], p["last_flow"]) == (f[tuple(ws[:2])], f[tuple(ws[-2:])])
        got.update({tuple(ws[i : i + 3]): p["weight"] for i in range(len(ws) - 2)})
        assert all(f[tuple(ws[i : i + 2])] == p["weight"] for i in range(1, len(ws) - 2))
    assert got == want and sum(len(p["words"]) - 2 for p in paths) == len(want)
    longest = max(paths, key=lambda p: len(p["words"]))["words"]
    assert longest[0] == "w4" and longest[-1] == "w61"  # between the places where other pieces join and leave
    assert rows(P.collocations(frame(spark, docs))) == brute(docs)


def test_exact_shares_beyond_64_bits(spark):
    rng = random.Random(4)
    cases = [(7, 7, 7), (1, 3, 10**18 - 1), (10**14, 10**14, 10**14), (10**14 - 1, 10**14, 10**14 + 7), (33_333_333_333, 99_999_999_999, 33_333_333_334)]
    cases += [(a, a + rng.randrange(9), a + rng.randrange(10**6)) for a in (rng.randrange(1, 10 ** rng.randrange(1, 15)) for _ in range(300))]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    got = df.select("a", "l", "r", P._share(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert len(got) == len(cases) and all(r["s"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"]) for r in got)


def test_edges(spark):
    docs = [(r[2], r[1]) for r in EDGE_ROWS]
    for least in (1, 2):
        assert rows(P.collocations(edge_docs(spark), min_count=least)) == brute(docs, least)
    assert P.collocations(no_docs(spark)).count() == 0
    odd = [("en", t) for t in (".", " \t", "a", "a.", "-" * 100_000, "- " * 50_000, "\x1c \x00 \x85 é")] * 2
    assert rows(P.collocations(frame(spark, odd), min_count=1)) == brute(odd, 1)
