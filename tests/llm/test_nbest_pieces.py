"""N-best segmentation against all segmentations, exact round trips, edge cases."""

import random
import time

import numpy as np
import public_tokenizers
import pytest

from tableworks.llm import nbest_pieces as S
from tableworks.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import edge_docs, no_docs, small

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return S.NBestEncoder(FILE, 4)


def marked(text):
    return S.SPACE_MARK + text.replace(S.SPACE_MARK, S._LITERAL_MARK).replace(" ", S.SPACE_MARK)


def every(pieces, s):
    """All segmentations of a whole marked text as (score, ids), best first."""
    out = []

    def go(i, score, ids):
        if i == len(s):
            out.append((score, ids))
            return
        for j in range(i + 1, min(len(s), i + 16) + 1):
            p = pieces.ids.get(s[i:j])
            if p is not None:
                go(j, score + pieces.scores[p], ids + (p,))
        if s[i] not in pieces.ids:
            go(i + 1, score + pieces.unknown, ids + pieces.fallback(s[i]))

    go(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


def test_matches_all_segmentations(encoder):
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("the an\n▁é日\U0001f600") for _ in range(rng.randrange(1, 10)))
        got, all_of_them = encoder.encode(text), every(encoder.pieces, marked(text))
        assert [s for s, _ in got] == [s for s, _ in all_of_them[:4]]
        known = {ids: s for s, ids in all_of_them}
        assert len({tuple(i.tolist()) for _, i in got}) == len(got)
        assert all(known[tuple(i.tolist())] == s for s, i in got)


def test_runs_of_one_sign_end_soon(encoder):
    """Runs are all ties; each must yield whole paths before ties are followed."""
    for sign in "- =a.é":
        for n in (1, 2, 3, 7, 12):
            got, all_of_them = encoder.encode(sign * n), every(encoder.pieces, marked(sign * n))
            assert [s for s, _ in got] == [s for s, _ in all_of_them[:4]]
        for n in (300, 1000, 1001, 3000, 20_000):
            begun = time.process_time()
            got = encoder.encode(sign * n)
            assert time.process_time() - begun < 20
            assert len({tuple(i.tolist()) for _, i in got}) == len(got) == (2 if sign == "é" else 4)  # é has one piece only
            assert all(encoder.pieces.decode(ids) == sign * n for _, ids in got)
            assert [s for s, _ in got] == sorted((s for s, _ in got), reverse=True)


def test_decoding_restores_every_segmentation(encoder):
    texts = [d["text"] for d in small("documents")[:80]] + ["  a  b ", "\n\n", " \n ", "▁▁ x", "\ta\r\nb", "é 　", "x" * 700]
    for t in texts:
        assert all(encoder.pieces.decode(ids) == t for _, ids in encoder.encode(t))


def test_chunk_search_is_best_first(encoder):
    paths = encoder.pieces.nbest("▁thereafter", 30)
    assert [s for s, _ in paths] == sorted((s for s, _ in paths), reverse=True)
    assert [s for s, _ in paths] == [s for s, _ in every(encoder.pieces, "▁thereafter")[:30]]


def test_a_small_memory_changes_nothing(encoder):
    tight = S.NBestEncoder(FILE, 4, max_chunks=10)
    for d in small("documents")[:25]:
        assert [(s, i.tolist()) for s, i in tight.encode(d["text"])] == [(s, i.tolist()) for s, i in encoder.encode(d["text"])]


def test_query(spark, encoder):
    rows = {(r["doc_id"], r["rank"]): r for r in QUERIES["op3_sentencepiece_nbest"](spark, SF_SMALL).collect()}
    import zlib

    for d in small("documents"):
        for rank, (score, ids) in enumerate(encoder.encode(d["text"]), 1):
            r = rows.pop((d["doc_id"], rank))
            assert (r["score"], r["n_pieces"], r["ids_crc32"], r["round_trip"]) == (score, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), True)
    assert not rows


def test_encode_then_decode_in_spark(spark):
    docs = edge_docs(spark)
    enc = S.encode_nbest(docs, FILE, n=2)
    back = S.decode_pieces(enc, FILE)
    want = {}
    for d in docs.collect():
        want.setdefault(d["doc_id"], set()).add(d["text"] or "")
    rows = back.collect()
    assert all(r["text"] in want[r["doc_id"]] and r["round_trip"] for r in rows)
    assert sum(r["rank"] == 1 for r in rows) == 11
    assert S.encode_nbest(no_docs(spark), FILE).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in S.decode_pieces(none, FILE).collect()} == {1: None, 2: ""}
    with pytest.raises(ValueError):
        S.decode_pieces(back, FILE)


def test_best_two_against_all_segmentations(encoder):
    rng = random.Random(5)
    for _ in range(300):
        chunk = S.SPACE_MARK + "".join(rng.choice("thean=é日\U0001f600") for _ in range(rng.randrange(1, 9)))
        score, ids, gap = encoder.pieces.best_two(chunk)
        found = every(encoder.pieces, chunk)
        assert (score, ids) in found and score == found[0][0]
        assert gap == (found[0][0] - found[1][0] if len(found) > 1 else float("inf"))
