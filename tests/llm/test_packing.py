"""Packing: ids against the tokenizer itself, every id once, little padding, limits."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tableworks.llm import packing as K
from tableworks.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import edge_docs, no_docs, small

FILE = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    t = Tokenizer.from_file(FILE)
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def check(pieces, ids_of, limits=K.Limits()):
    """Each id lies in one piece, sequences have no gaps, limits hold; returns the padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids_of)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids_of[d])
            part = np.array(ids_of[d][at : at + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += p["length"]
        assert at == len(ids_of[d])
    padding = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limits.tokens and len(ps) <= limits.segments
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding


def test_query_packs_every_id_once(spark):
    docs = small("documents")
    ids = {d["doc_id"]: [*i, 0] for d, i in zip(docs, reference()([d["text"] for d in docs]))}
    padding = check([r.asDict() for r in QUERIES["op9_packing"](spark, SF_SMALL).collect()], ids)
    assert padding <= 0.01 * sum(map(len, ids.values()))


def test_chunked_ids_equal_the_tokenizer():
    rng = random.Random(5)
    alphabet = "ab \n\t'sé1.! \x85　日ￄ<|endoftext|>\r\x0b\U0001f600"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(16))) for _ in range(8000)]
    texts += ["", " ", "\n", "  a", "a  ", "a \n b", "\n\na", "it's we'll", "x" * 5000]
    tok = K.ChunkTokenizer(FILE, max_chunks=300)  # the memory starts anew many times
    for lo in range(0, len(texts), 100):
        assert [x.tolist() for x in tok.encode(texts[lo : lo + 100])] == reference()(texts[lo : lo + 100])


def test_special_strings_and_long_runs():
    tok, ids = K.ChunkTokenizer(FILE), reference()
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext|", "<|ENDOFTEXT|>", " <|endoftext|>  c"]
    texts += ["a" + c * n + end for c in " \n\t" for n in (4999, 5000, 5001, 20_000) for end in ("", "b", ".", "<|endoftext|>")]
    texts += [" \n" * 6000 + "é", "x" + "\x0b\u3000" * 5000 + "日", "-" * 50_000, "a" * 50_000, "1" * 50_000]
    assert [x.tolist() for x in tok.encode(texts)] == ids(texts)


def test_million_spaces_come_back(spark):
    texts = [" " * 1_000_000, "a" + "\n" * 1_000_000 + "b", "\t" * 999_999 + " c"]
    pieces = K.pack_documents(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), FILE).collect()
    total = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert len(total) == 3 and all(sum(p["length"] for p in pieces if p["doc_id"] == i) == n for i, n in total.items())
    bpe = K.byte_level_bpe(FILE)
    assert all(bpe.decode(K.ChunkTokenizer(FILE).encode([t])[0].tolist()) == t for t in texts)


def test_loss_bearing_limit_holds():
    """Ids of white space and the end id bear no loss; a tight limit on the others cuts pieces by it."""
    white = K.white_ids(FILE)
    tok = K.ChunkTokenizer(FILE)
    assert white[tok.encode([" "])[0][0]] and white[tok.line_feed] and not white[tok.encode(["a"])[0][0]]
    rng = random.Random(3)
    limits = K.Limits(tokens=128, segments=6, loss_tokens=40)
    packer = K.DocumentPacker(0, limits, 32, white)
    ids_of = {i: np.append(tok.encode([" ".join(rng.choice(["a\n\n\n", "word", "\n", "\t\t b"]) for _ in range(rng.randrange(300)))])[0], 0).astype("<u4") for i in range(200)}
    for i, ids in ids_of.items():
        packer.add(i, ids)
    packer.finish()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = [dict(zip(names, r)) for r in packer.flush()]
    check(pieces, {i: x.tolist() for i, x in ids_of.items()}, limits)
    held = defaultdict(int)
    for p in pieces:
        part = ids_of[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        ends = p["start"] + p["length"] == p["doc_tokens"]
        held[p["sequence_id"]] += int((~white[part]).sum()) - int(ends)
    assert max(held.values()) <= 40 and sum(v == 40 for v in held.values()) > 20


def test_examples_wait_across_batches(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(50, 700), rng.randrange(0, 50), f"n{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "conv long, tokens int, loss int, note string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = K.pack_examples(df, "tokens", "loss").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["conv"], r["tokens"], r["loss"], r["note"]) for r in got) == rows
    held = defaultdict(int)
    for r in got:
        held[r["sequence_id"]] += r["tokens"]
    assert max(held.values()) <= 1024 and len(held) <= 1.03 * sum(r[1] for r in rows) / 1024


def test_segment_limit_holds(spark):
    limits = K.Limits(tokens=64, segments=4, loss_tokens=64)
    rows = [(i, "a b" if i % 3 else "word " * (i % 90)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    ids = {i: [*x, 0] for (i, _), x in zip(rows, reference()([t for _, t in rows]))}
    check([r.asDict() for r in K.pack_documents(docs, FILE, limits=limits, pool_slots=64).collect()], ids, limits)


def test_whole_examples_under_three_limits():
    rng = random.Random(1)
    tokens = [rng.choice([rng.randrange(1, 60), rng.randrange(100, 900)]) for _ in range(3000)]
    loss = [rng.randrange(min(t, 600) + 1) for t in tokens]
    limits = K.Limits(1024, 8, 600)
    bins = K.pack_vectors(tokens, loss, limits)
    held = defaultdict(lambda: [0, 0, 0])
    for b, t, l in zip(bins, tokens, loss):
        held[b] = [held[b][0] + t, held[b][1] + 1, held[b][2] + l]
    assert all(t <= 1024 and n <= 8 and l <= 600 for t, n, l in held.values())
    least = max(sum(tokens) / 1024, len(tokens) / 8, sum(loss) / 600)
    assert len(held) <= 1.12 * least
    # too large alone: a bin of its own
    big = K.pack_vectors([5000, 10, 10], [0, 700, 1], limits)
    assert len(set(big)) == 3


def test_examples_keep_their_columns(spark):
    df = spark.createDataFrame([(1, 600, 100, "x"), (2, 500, 100, "y"), (3, 400, None, None)], "conv long, tokens long, loss long, note string")
    got = {r["conv"]: r["sequence_id"] for r in K.pack_examples(df.coalesce(1), "tokens", "loss").collect()}
    assert got[1] == got[3] != got[2]
    assert K.pack_examples(df.limit(0), "tokens", "loss").count() == 0


def test_edges(spark):
    rows = [r.asDict() for r in K.pack_documents(edge_docs(spark), FILE).collect()]
    assert sum(p["length"] for p in rows if p["doc_id"] in (1, 2)) == 2  # the end id alone
    assert sum(p["doc_id"] is None and p["start"] == 0 for p in rows) == 2
    assert sum(p["doc_id"] == 5 and p["start"] == 0 for p in rows) == 2
    six = [p for p in rows if p["doc_id"] == 6]
    assert sum(p["length"] for p in six) == six[0]["doc_tokens"] > 40000
    assert K.pack_documents(no_docs(spark), FILE).count() == 0
