"""Context-tree weighting: against the direct recursion, base counts, proper distributions, edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tableworks.llm import context_trees as T
from tableworks.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import edge_docs, no_docs, small, words


def kt(a, b):
    """Krichevsky-Trofimov probability of a zeros and b ones, one symbol at a time."""
    p = 1.0
    for i in range(a):
        p *= (i + 0.5) / (i + 1)
    for j in range(b):
        p *= (j + 0.5) / (a + j + 1)
    return p


def direct(train, text, depth):
    """The probability of ``text`` by the definition: weighted blocks at every node."""
    data = []
    for t in train:
        padded = [255] * depth + list(t)
        data += [(tuple(padded[i - depth : i]), padded[i]) for i in range(depth, len(padded))]

    def block(items, place):
        ones = zeros = 0
        for _, byte in items:
            bits = f"{byte:08b}"
            if bits.startswith(place):
                ones += bits[len(place)] == "1"
                zeros += bits[len(place)] == "0"
        return zeros, ones

    def weighted(items, place, d):
        """(block probability, per context path prediction of a one)"""
        z, o = block(items, place)
        own, est = kt(z, o), (o + 0.5) / (z + o + 1)
        if d == depth:
            return own, lambda ctx: est
        groups = {}
        for it in items:
            groups.setdefault(it[0][-1 - d], []).append(it)
        kids = {c: weighted(g, place, d + 1) for c, g in groups.items()}
        children = math.prod(k[0] for k in kids.values())
        total = 0.5 * own + 0.5 * children
        share = 0.5 * own / total

        def predict(ctx):
            kid = kids.get(ctx[-1 - d])
            return share * est + (1 - share) * (kid[1](ctx) if kid else 0.5)

        return total, predict

    out = 0.0
    padded = [255] * depth + list(text)
    cache = {}
    for i in range(depth, len(padded)):
        bits = f"{padded[i]:08b}"
        for k in range(8):
            place = bits[:k]
            if place not in cache:
                cache[place] = weighted(data, place, 0)[1]
            p1 = cache[place](tuple(padded[i - depth : i]))
            out += math.log10(p1 if bits[k] == "1" else 1 - p1)
    return out


def model(train, depth, most=10**9):
    codes, n = T.gram_counts(train, depth)
    rows = []
    for d in range(depth + 1):
        found = Counter()
        for c, m in zip(codes.tolist(), n.tolist()):
            found[c & ((1 << (8 * (d + 1))) - 1)] += m
        totals = Counter()
        for c, m in found.items():
            totals[c >> 8] += m
        rows += [(d, c >> 8, c & 255, m) for c, m in found.items() if totals[c >> 8] * most >= n.sum()]
    return T.build_trees(rows, depth)


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_matches_the_direct_recursion(depth):
    train = [T.coded(t.split()) for t in (b"abra cadabra", b"abracad abra", b"banana")]
    m = model(train, depth)
    for text in (b"abra", b"cadabra banana", b"bra bra", b""):
        coded = T.coded(text.split())
        if set(coded.tolist()) <= {b for t in train for b in t.tolist()}:
            assert m.score([coded])[0] == pytest.approx(direct(train, coded, depth), rel=1e-5)


def test_every_node_predicts_a_distribution():
    train = [T.coded(words(d["text"])) for d in small("documents")[:60]]
    for most in (200, 5000):
        m = model(train, 3, most)
        unseen = int((m.symbol_of == m.step.shape[1] - 1).sum())
        p = 10.0 ** m.log10p.astype(float)
        total = p[:, :-1].sum(axis=1) + unseen * p[:, -1]
        assert np.allclose(total, 1, atol=1e-4)


def test_deeper_contexts_help():
    docs = [T.coded(words(d["text"])) for d in small("documents") if d["lang"] == "en"]
    held, train = docs[:20], docs[20:]
    size = sum(map(len, held))
    bits = [-model(train, d, 5000).score(held).sum() / size / math.log10(2) for d in (0, 1, 2, 4)]
    assert bits == sorted(bits, reverse=True) and bits[-1] < 3.0


def test_query_against_plain_counts(spark):
    docs = {d["doc_id"]: [*words(d["text"]), None] for d in small("documents")}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    count = Counter(w for i, ws in docs.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    rows = QUERIES["op5_context_tree_weighting"](spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = docs[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), n)
        assert r["n_known"] == sum(count[w] > 0 for w in ws)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0 and 0 < r["bits_per_byte"] < 9


def test_rare_words_meet_their_counts_in_the_join(spark, monkeypatch):
    whole = {r["doc_id"]: r for r in QUERIES["op5_context_tree_weighting"](spark, SF_SMALL).collect()}
    monkeypatch.setattr(T, "MAX_COMMON_WORDS", 20)
    for r in QUERIES["op5_context_tree_weighting"](spark, SF_SMALL).collect():
        assert (r["n_known"], r["n_tokens"]) == (whole[r["doc_id"]]["n_known"], whole[r["doc_id"]]["n_tokens"])
        assert r["base_score"] == pytest.approx(whole[r["doc_id"]]["base_score"], rel=1e-9)


def test_edges(spark):
    rows = T.score_texts(edge_docs(spark)).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["score"] == by[2][0]["score"] == by[3][0]["score"] and by[1][0]["n_tokens"] == 1
    assert len({(r["score"], r["base_score"], r["n_known"]) for i in (4, 5) for r in by[i]}) == 1
    assert by[6][0]["n_tokens"] == 20001 and by[6][0]["n_known"] in (20001, 20000, 1)
    assert T.score_texts(no_docs(spark)).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    only = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    r = T.score_texts(only).collect()[0]
    assert (r["train_tokens"], r["n_known"], r["n_tokens"]) == (0, 0, 3)
    assert r["base_score"] == pytest.approx(3 * math.log10(0.5 / 0.5))
    assert r["score"] == pytest.approx(-4 * 8 * math.log10(2), rel=1e-6)


def test_every_context_counts(spark, monkeypatch):
    """More contexts than the old 40,000; all predictions as the trees of the whole corpus give them."""
    import random

    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzäß語"
    docs = [(i, " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(60))) for i in range(400)]
    docs += [(900, None), (901, docs[3][1]), (901, docs[3][1])]
    train = [T.coded(words(t)) for i, t in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    whole = model(train, 5)
    assert len(whole.step) > 80_000
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(T, "_SUBTREE_GRAMS", 100)
    for common in (T.MAX_COMMON_GRAMS, 500, 0):
        monkeypatch.setattr(T, "MAX_COMMON_GRAMS", common)
        rows = T.score_texts(df).collect()
        assert len(rows) == len(docs)
        for r in rows:
            text = next(t for i, t in docs if i == r["doc_id"])
            assert r["score"] == pytest.approx(whole.score([T.coded(words(text))])[0], rel=1e-5)
        assert len({r["score"] for r in rows if r["doc_id"] in (3, 901)}) == 1


@pytest.mark.parametrize("depth", [0, 1, 2, 4])
def test_distributed_trees_match_the_direct_recursion(spark, depth):
    texts = ["abra cadabra", "abracad abra", "banana", None]
    held = ["zebra abra", "aé"]
    df = spark.createDataFrame([(t, False) for t in texts] + [(t, True) for t in held], "text string, held_out boolean")
    digits = {r["gram"]: r["digits"] for r in T.gram_digits(df, depth).collect()}
    train = [T.coded(words(t)) for t in texts]
    for t in texts + held:
        one = T.coded(words(t))
        assert sum(digits[g] for g in T._codes([one], depth).tolist()) == pytest.approx(direct(train, one, depth), rel=1e-5)
