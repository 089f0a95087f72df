"""Near duplicates against all pairs, planted groups, estimates, edge cases."""

import random
import tracemalloc
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa

from tableworks.llm import near_dedup as N
from tableworks.llm.common import slices
from tableworks.llm.graph import components
from tableworks.llm.quality_rules import RULES, _keep
from tableworks.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import edge_docs, no_docs, small, words


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    """{id: (set size, smallest id reachable)} by all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    holders, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def check(rows, docs):
    want = brute(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == want[r["id"]]
        assert r["kept"] == (r["id"] == r["component_id"])


def test_query_matches_all_pairs(spark):
    docs = [(d["doc_id"], d["text"]) for d in small("documents")]
    check(QUERIES["op6_hyperminhash_near_dedup"](spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect(), docs)


def planted(seed):
    """Chains, stars, copies and documents that share a passage only."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    docs, passage = [], fresh(120)
    for _ in range(6):  # chains: neighbours are near, the ends are not
        text = fresh(rng.choice([12, 40, 200]))
        for _ in range(6):
            docs.append(list(text))
            text[rng.randrange(len(text))] = fresh(1)[0]
    base = fresh(150)
    for _ in range(90):  # a group larger than LARGE_BUCKET
        copy = list(base)
        copy[rng.randrange(150)] = fresh(1)[0]
        docs.append(copy)
    docs += [passage + fresh(60) for _ in range(80)]
    docs += [docs[0]] * 5 + [["a", "b"], ["a", "b"], ["a", "b", "c"], []]
    rng.shuffle(docs)
    return [(i * 7 + 1, " ".join(w)) for i, w in enumerate(docs)]


def test_planted_groups(spark):
    docs = planted(3)
    check(N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_filter_keeps_one_of_each_group(spark):
    docs = planted(4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r["doc_id"] for r in N.drop_near_duplicates(df).collect()}
    assert kept == {i for i, (_, c) in brute(docs).items() if i == c}


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        errors = []
        for _ in range(60):
            n = 400
            x = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            common = int(n * 2 * share / (1 + share))
            a, b = x[:n], np.concatenate([x[:common], x[n : 2 * n - common]])
            true = common / (2 * n - common)
            ra, rb = N.registers(np.unique(a))[None], N.registers(np.unique(b))[None]
            errors.append(N.estimated_jaccard(ra, rb, np.array([n]), np.array([n]))[0] - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_accidental_matches_are_rare_but_not_never():
    rng = np.random.default_rng(2)
    n, hits = 1000, []
    for _ in range(300):
        a, b = (N.registers(np.unique(rng.integers(0, 2**63, n).astype(np.uint64))) for _ in range(2))
        hits.append((a == b).mean())
    expected = N.accidental_match(np.array([n]), np.array([n]))[0]
    assert abs(np.mean(hits) - expected) < 3e-4


def test_components_on_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (601, 600), (600, 601)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 600: 600, 601: 600}


def test_edges(spark):
    rows = N.near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == 11
    by = defaultdict(list)
    for r in rows:
        by[r["id"]].append(r)
    assert [by[i][0]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0] and all(by[i][0]["kept"] for i in (1, 2, 3))
    assert by[4][0]["component_id"] == by[5][0]["component_id"] == by[5][1]["component_id"] == 4
    assert all(r["kept"] and r["component_id"] is None for r in by[None])
    assert by[7][0]["component_id"] == 6 and not by[7][0]["kept"]
    kept = N.drop_near_duplicates(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, -8), (False, 1), (False, 2), (False, 3), (False, 4), (False, 6), (True, 0), (True, 0),
    ]
    assert N.near_duplicates(no_docs(spark)).count() == 0


def test_an_id_with_two_texts_links_both(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, "x y z")], "doc_id long, text string")
    got = {(r["id"], r["component_id"]) for r in N.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_threshold_is_a_parameter(spark):
    rng, base, docs = random.Random(8), [f"v{i}" for i in range(104)], []
    for i in range(60):  # 100 shingles; the last words of each copy are its own
        own = rng.choice([9, 10, 11, 12, 13, 14])  # similarity of copies and base 0.75 to 0.83
        docs.append((i + 1, " ".join(base[: 104 - own] + [f"o{i}x{k}" for k in range(own)])))
    docs.append((99, " ".join(base)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (75, 80, 85):
        sets = [(i, shingles(t)) for i, t in docs]
        want = {i: i for i, _ in docs}
        for _ in docs:  # labels spread until nothing changes
            before = dict(want)
            for i, s in sets:
                for j, t in sets:
                    if 100 * len(s & t) >= percent * len(s | t):
                        want[i] = want[j] = min(want[i], want[j])
            if want == before:
                break
        got = N.near_duplicates(df, threshold_percent=percent).collect()
        assert {r["id"]: r["component_id"] for r in got} == want
        assert {r["doc_id"] for r in N.drop_near_duplicates(df, threshold_percent=percent).collect()} == set(want.values())
        assert (1 - (percent / 100) ** N.band_rows(percent)) ** (N.BUCKETS // N.band_rows(percent)) <= N.MAX_MISS
    assert (N.band_rows(85), N.estimate_floor(85), N.band_rows(80), N.estimate_floor(80)) == (5, 0.66, 4, 0.58)


def _peak(work, batch) -> int:
    """Bytes of Python objects held at most while ``work`` goes through one Arrow batch, its results not kept."""
    for _ in work(iter([batch.slice(0, 10)])):
        pass
    tracemalloc.start()
    try:
        for _ in work(iter([batch])):
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_worker_memory_does_not_grow_with_the_batch():
    rng = random.Random(3)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(rng.choices(words, k=250)) for _ in range(4000)]
    docs = pa.record_batch({"doc_id": list(range(4000)), "text": texts})
    signed = pa.Table.from_batches(N._sign(iter([docs]))).combine_chunks().to_batches()[0]
    n, regs = signed.column("n_shingles"), signed.column("regs")
    pairs = pa.record_batch({"a": signed.column("id"), "b": signed.column("id"), "na": n, "nb": n, "ra": regs, "rb": regs})
    keep = partial(_keep, cascade=list(RULES.items()), at=1)
    for work, batch in ((N._sign, docs), (partial(N._bands, rows=5), signed), (N._sets, docs), (partial(N._likely, percent=85), pairs), (keep, docs)):
        few, many = _peak(work, batch.slice(0, 1000)), _peak(work, batch)
        assert many < 1.3 * few + 100_000, (work, few, many)


def test_slices_give_the_rows_of_the_batch():
    batch = pa.record_batch({"id": list(range(1100))})
    got = list(slices(iter([batch.slice(0, 0), batch, batch.slice(0, 3)])))
    assert [b.num_rows for b in got] == [512, 512, 76, 3]
    assert pa.Table.from_batches(got[:3]).column(0).to_pylist() == list(range(1100))
