"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut into pieces at punctuation and line ends.  Of all phrases only the
longest grams are counted: every word of a piece opens one gram of three words,
or a shorter one at the piece's end.  Three words are an edge from the node of the
first two to the node of the last two; what is shorter is a piece-end correction.

* The count of a node (two words) is the flow that leaves it plus the pieces that
  end there; the count of a word is that of the nodes it opens plus the pieces
  that end in it.  No shorter gram is ever counted in a text.
* A node is passed through if one edge brings its whole flow and one edge takes it
  on.  Such unary paths are compacted, by pointer jumping, to one row of words
  with a single weight.  All of a path's edges, and its inner nodes, count the
  same, so their counts need no look-up, and no inner node can be a candidate.

A unary path follows one occurrence of its first edge, so it is never longer than
a piece, and it can't be a ring: the pieces it is made of begin somewhere.

Counting runs level by level, from edges to nodes to words.  Every level is summed
where Spark's shuffle brings equal phrases together; what it passes to the level
below is summed before it is shuffled, so a frequent phrase, word or language is
one entry per task, whatever its share.  Entries travel sorted and compressed, many
to a row, as most grams occur once.  The number of partitions follows the bytes of
the texts, so that a partition's phrases fit a task.

Defined results: a null or empty text has no words; a null language is ``und``;
equal rows count each; ties in score go to the larger count, then to the smaller
phrase in UTF-8 byte order; an empty table gives no rows; other columns are
ignored.  A very long text or piece is counted whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableworks.llm.common import discard, workers_find_package, written

MIN_COUNT = 10
TOP = 2000
CONTAINED_PERCENT = 50
NO_LANGUAGE = "und"
#: A score of 1, for phrases whose parts occur nowhere else.
SCALE = 1_000_000

#: Copies of a word's or node's count in look-ups, for keys that many rows ask for.
SALTS = 8
#: Groups in which a language's phrases are ranked before the last ranking.
RANK_GROUPS = 64

# Signs and line ends between pieces; a tab is a space.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_SIGNS = bytes.maketrans(_BREAKS + b"\t", b"\n" * len(_BREAKS) + b" ")

#: Text that one partition of the counting stages stands for, and that a task gathers before it counts.
PARTITION_BYTES = 12 << 20
_HELD_BYTES = 5 << 20
_SEGMENT = 1 << 19
_MERGE_ROWS = 1 << 19

LONGEST = 3

#: Phrases of one language, line by line, with their counts; ``done`` ones are only passed on.
BLOCKS = "bucket int, done boolean, lang string, entries long, size long, phrases binary, counts binary"
_BLOCK_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("done", pa.bool_()), ("lang", pa.string()), ("entries", pa.int64()), ("size", pa.int64())]
    + [("phrases", pa.binary()), ("counts", pa.binary())]
)


# -- counting ---------------------------------------------------------------


def _coded_words(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Codes of the words in order, 0 at a break, and the words in byte order.

    Word ``i`` has code ``i + 1``.  Every token ends in a space, so the tokens
    are slices of the data with nothing between them.
    """
    data = data.replace(b"\n", b" \n ") + b" "
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = tokens.dictionary_encode()
    entries = [t[:-1] for t in _listed(coded.dictionary)]
    words = sorted(t for t in entries if t not in (b"", b"\n"))
    code_of = {w: i + 1 for i, w in enumerate(words)} | {b"\n": 0, b"": -1}
    codes = np.fromiter(map(code_of.__getitem__, entries), np.int64, len(entries))[coded.indices.to_numpy()]
    return codes[codes >= 0], words


def count_grams(data: bytes) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(phrases, counts, hashes) of the grams that each word of the pieces opens.

    ``data`` holds lower-case pieces with line feeds between them.  Phrases are
    in byte order of their words; one of fewer than three words ends a piece.
    """
    codes, words = _coded_words(data)
    if not words:
        return
    codes = np.concatenate([codes, [0, 0]])
    opens = np.flatnonzero(codes)
    text = pa.array([b"", *words], pa.binary())
    hashes = np.fromiter(map(zlib.crc32, [b"", *words]), np.uint64, len(words) + 1)
    for lo in range(0, len(opens), _SEGMENT):
        at = opens[lo : lo + _SEGMENT]
        grams = np.stack([codes[at], codes[at + 1], np.where(codes[at + 1] > 0, codes[at + 2], 0)])
        base = len(words) + 1
        dense = None
        if base >= 1 << 21:  # a segment's codes are made dense, so that three of them fit 63 bits
            dense, grams = np.unique(grams, return_inverse=True)
            grams, base = grams.reshape(3, -1), len(dense) + 1
        keys, counts = np.unique((grams[0] * base + grams[1]) * base + grams[2], return_counts=True)
        parts = [keys // base // base, keys // base % base, keys % base]
        if dense is not None:
            parts = [dense[k] for k in parts]
        hashed = (hashes[parts[0]] * np.uint64(31) + hashes[parts[1]]) * np.uint64(31) + hashes[parts[2]]
        phrase = pc.binary_join_element_wise(*[text.take(pa.array(k, mask=k == 0)) for k in parts], b" ", null_handling="skip")
        yield phrase, counts, hashed


def _listed(a: pa.Array) -> list:
    """An array's values, by way of numpy, which is many times as fast as ``to_pylist``."""
    return a.to_numpy(zero_copy_only=False).tolist()


def _blocks(lang: str, done: bool, phrases: pa.Array, counts: np.ndarray, buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases and counts as one row per bucket."""
    order = np.argsort(buckets, kind="stable")
    sorted_buckets = buckets[order]
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(sorted_buckets)) + 1, [len(order)]])
    in_order, counts = phrases.to_numpy(zero_copy_only=False)[order], counts[order].astype("<i8")
    columns: list[list] = [[] for _ in _BLOCK_SCHEMA]
    held = 0
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        joined = b"\n".join(in_order[lo:hi].tolist())
        row = (int(sorted_buckets[lo]), done, lang, hi - lo, len(joined), pa.compress(joined, "zstd", asbytes=True))
        for column, value in zip(columns, (*row, pa.compress(counts[lo:hi].tobytes(), "zstd", asbytes=True))):
            column.append(value)
        held += len(row[-1])
        if held > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA)
            columns, held = [[] for _ in _BLOCK_SCHEMA], 0
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA)


def _entries(row: dict) -> pa.Table:
    phrases = pa.decompress(row["phrases"], decompressed_size=row["size"], codec="zstd", asbytes=True).split(b"\n")
    counts = pa.decompress(row["counts"], decompressed_size=8 * row["entries"], codec="zstd", asbytes=True)
    return pa.table({"phrase": pa.array(phrases, pa.binary()), "c": np.frombuffer(counts, "<i8")})


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("phrase").aggregate([("c", "sum")]).rename_columns(["phrase", "c"])


def _grams(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the texts' grams, counted over many texts of a language at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            for phrases, counts, hashes in count_grams(b"\n".join(texts)):
                yield from _blocks(lang, False, phrases, counts, ((hashes + np.uint64(zlib.crc32(lang.encode()))) % np.uint64(buckets)).astype(np.int64))
        held.clear()
        pa.default_memory_pool().release_unused()

    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            some = batch.slice(first, 256)
            for lang, text in zip(_listed(some.column(0)), _listed(some.column(1).cast(pa.binary()))):
                if text:
                    held.setdefault(lang, []).append(text.lower().translate(_SIGNS))
                    size += len(text)
            if size >= _HELD_BYTES:
                yield from out()
                size = 0
    yield from out()


def _level(batches: Iterator[pa.RecordBatch], words: int, least: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Sum the phrases of a partition; pass each one's count to the phrase without its last word.

    Phrases of ``words`` words with ``least`` or more are done and stay; shorter
    ones ended a piece and go to the level below as they are.
    """
    new: dict[str, list[pa.Table]] = {}
    rows: dict[str, int] = {}
    here = 0  # a partition is one bucket
    for batch in batches:
        here = batch.column(0)[0].as_py() if batch.num_rows else here
        done = batch.filter(batch.column(1))
        if done.num_rows:
            yield done
        for row in batch.filter(pc.invert(batch.column(1))).to_pylist():
            lang = row["lang"]
            new.setdefault(lang, []).append(_entries(row))
            rows[lang] = rows.get(lang, 0) + row["entries"]
            if rows[lang] > _MERGE_ROWS + 2 * new[lang][0].num_rows:
                new[lang], rows[lang] = [_summed(new[lang])], 0
    for lang in list(new):
        pa.default_memory_pool().release_unused()
        table = _summed(new.pop(lang))
        below: list[pa.Table] = []
        for some in table.to_batches(max_chunksize=1 << 18):
            phrase, c = some.column(0), some.column(1)
            full = pc.equal(pc.count_substring(phrase, b" "), words - 1)
            stays = pc.and_(full, pc.greater_equal(c, least))
            if pc.any(stays).as_py():
                kept = phrase.filter(stays)
                yield from _blocks(lang, True, kept, c.filter(stays).to_numpy(), np.full(len(kept), here))
            if words > 1:
                parents = pa.array([p.rpartition(b" ")[0] if f else p for p, f in zip(_listed(phrase), _listed(full))], pa.binary())
                below.append(pa.table({"phrase": parents, "c": c}))
        if below:
            passed = _summed(below).combine_chunks()
            phrases = passed.column(0).chunk(0) if passed.num_rows else pa.array([], pa.binary())
            at = (np.fromiter(map(zlib.crc32, _listed(phrases)), np.int64, len(phrases)) + zlib.crc32(lang.encode())) % buckets
            yield from _blocks(lang, False, phrases, passed.column(1).to_numpy(), at)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks as rows of (lang, k, phrase, c)."""
    for batch in batches:
        for row in batch.to_pylist():
            entries = _entries(row).combine_chunks()
            phrase = entries.column(0).chunk(0)
            k = pc.add(pc.count_substring(phrase, b" "), 1).cast(pa.int8())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * len(phrase), pa.string()), k, phrase.cast(pa.string()), entries.column(1).chunk(0)], ["lang", "k", "phrase", "c"]
            )


# -- the graph --------------------------------------------------------------


def phrase_flows(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """Counts of all words (``k`` 1), and of the nodes (2) and edges (3) with ``min_count`` or more.

    Columns ``lang``, ``k``, ``phrase``, ``c``; written once.
    """
    workers_find_package(docs.sparkSession)
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE))
    texts = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").alias("text")).where(F.col("text").isNotNull())
    text_bytes = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-text_bytes // PARTITION_BYTES))
    blocks = texts.mapInArrow(partial(_grams, buckets=buckets), BLOCKS)
    for words in range(LONGEST, 0, -1):
        least = min_count if words > 1 else 0
        dealt = blocks.repartitionById(buckets, "bucket")
        blocks = dealt.mapInArrow(partial(_level, words=words, least=least, buckets=buckets), BLOCKS)
    flows = blocks.mapInArrow(_rows, "lang string, k byte, phrase string, c long")
    return written(flows, "phrase-flows")


def _with_count(rows: DataFrame, flows: DataFrame, k: int, phrase: str, name: str) -> DataFrame:
    """``rows`` with the count of their column ``phrase``; salted, as many rows may ask for one count."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("__salt")
    counts = flows.where(F.col("k") == k).select("lang", F.col("phrase").alias(phrase), F.col("c").alias(name), salts)
    return salted.join(counts, ["lang", phrase, "__salt"]).drop("__salt")


def _places(links: DataFrame) -> DataFrame:
    """For every edge that follows another on a unary path: the path's first edge and the steps from it.

    ``links`` has (lang, edge, root): an edge and the one before it.  Each round
    doubles the steps that a pointer covers; rounds are written to the shared
    folder, and their number is the logarithm of the longest path's length.
    """
    places = written(links.withColumns({"steps": F.lit(1), "open": F.lit(True)}), "phrase-places")
    while not places.where("open").isEmpty():
        ahead = places.select("lang", F.col("edge").alias("root"), F.col("root").alias("further"), F.col("steps").alias("more"))
        moved = places.where("open").join(ahead, ["lang", "root"], "left").select(
            "lang",
            "edge",
            F.coalesce("further", "root").alias("root"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("further").isNotNull().alias("open"),
        )
        before, places = places, written(moved.unionByName(places.where(~F.col("open"))), "phrase-places")
        discard(before)
    return places.drop("open")


def compact_paths(flows: DataFrame) -> DataFrame:
    """Frequent edges as unary paths: ``lang``, ``words``, ``weight``, and the flow of the first and last node."""
    edges = flows.where(F.col("k") == 3).select(
        "lang",
        "phrase",
        "c",
        F.substring_index("phrase", " ", 2).alias("tail"),
        F.substring_index("phrase", " ", -2).alias("head"),
        F.substring_index("phrase", " ", -1).alias("last"),
    )
    edges = _with_count(_with_count(edges, flows, 2, "tail", "tail_flow"), flows, 2, "head", "head_flow")
    edges = written(edges, "phrase-edges")
    into = edges.where(F.col("c") == F.col("head_flow")).select("lang", F.col("head").alias("node"), F.col("phrase").alias("root"))
    out = edges.where(F.col("c") == F.col("tail_flow")).select("lang", F.col("tail").alias("node"), F.col("phrase").alias("edge"))
    places = _places(out.join(into, ["lang", "node"]).select("lang", "edge", "root"))
    placed = edges.join(places.withColumnRenamed("edge", "phrase"), ["lang", "phrase"], "left").select(
        "lang",
        F.coalesce("root", "phrase").alias("root"),
        F.struct(F.coalesce("steps", F.lit(0)).alias("steps"), "last", "head_flow", "tail_flow", "c").alias("e"),
    )
    paths = placed.groupBy("lang", "root").agg(F.sort_array(F.collect_list("e")).alias("es"))  # at most a piece long
    return paths.select(
        "lang",
        F.concat(F.slice(F.split("root", " "), 1, 2), F.col("es.last")).alias("words"),
        F.col("es")[0]["c"].alias("weight"),
        F.col("es")[0]["tail_flow"].alias("first_flow"),
        F.element_at("es", -1)["head_flow"].alias("last_flow"),
    )


def _windows(paths: DataFrame, size: int) -> DataFrame:
    """The phrases of ``size`` words along each path, with their place ``at`` and the last place ``top``."""
    at = F.posexplode(F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: F.concat_ws(" ", F.slice("words", i, size))))
    return paths.withColumn("top", F.size("words") - size).select("*", at.alias("at", "phrase"))


def _candidates(flows: DataFrame, paths: DataFrame, min_count: int, contained_percent: int) -> DataFrame:
    """Phrases with the counts of their two-word parts (null in phrases of two words)."""
    weight = F.col("weight")
    three = _windows(paths, 3).select(
        "lang",
        "phrase",
        weight.alias("a"),
        F.when(F.col("at") == 0, F.col("first_flow")).otherwise(weight).alias("left_two"),
        F.when(F.col("at") == F.col("top"), F.col("last_flow")).otherwise(weight).alias("right_two"),
    )
    # a path carries all the flow of its inner nodes, so only its ends can be more than a part of it
    ends = _windows(paths, 2).groupBy("lang", "phrase").agg(F.max(weight).alias("longer"))
    two = flows.where((F.col("k") == 2) & (F.col("c") >= min_count)).join(ends, ["lang", "phrase"], "left")
    two = two.where(F.col("longer").isNull() | (100 * F.col("longer") < contained_percent * F.col("c")))
    none = F.lit(None).cast("long")
    return three.unionByName(two.select("lang", "phrase", F.col("c").alias("a"), none.alias("left_two"), none.alias("right_two")))


def _share(a: Column, l: Column, r: Column) -> Column:
    """floor(SCALE * a * a / (l * r)), exactly: the products have up to 38 digits, the result at most seven."""
    wide = [F.expr(f"CAST({SCALE} AS DECIMAL(7,0))"), a.cast("decimal(15,0)"), a.cast("decimal(15,0)")]
    up = wide[0] * wide[1] * wide[2]
    down = l.cast("decimal(18,0)") * r.cast("decimal(18,0)")
    return F.call_function("div", up, down)


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    contained_percent: int = CONTAINED_PERCENT,
) -> DataFrame:
    """Each language's ``top`` phrases of two or three words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut,
    ``n`` the language's words; ``score`` is ``floor(SCALE * a * a / (l * r))``.
    Phrases with fewer than ``min_count`` occurrences are left out, and those of
    which a longer phrase holds ``contained_percent`` or more.
    """
    flows = phrase_flows(docs, lang_col, text_col, min_count)
    paths = written(compact_paths(flows), "phrase-paths")
    found = _candidates(flows, paths, min_count, contained_percent)
    ends = {"first": F.substring_index("phrase", " ", 1), "last": F.substring_index("phrase", " ", -1)}
    often = flows.where(F.col("c") >= min_count)  # a phrase's words occur as often as it does
    found = _with_count(_with_count(found.withColumns(ends), often, 1, "first", "left_one"), often, 1, "last", "right_one")
    after_one = _share(F.col("a"), F.col("left_one"), F.coalesce("right_two", "right_one"))
    after_two = _share(F.col("a"), F.col("left_two"), F.col("right_one"))
    scored = found.withColumns({"after_one": after_one, "after_two": after_two})
    second = F.coalesce(F.col("after_two") < F.col("after_one"), F.lit(False))
    scored = scored.select(
        "lang",
        "phrase",
        "a",
        F.when(second, F.col("left_two")).otherwise(F.col("left_one")).alias("l"),
        F.when(second, F.col("right_one")).otherwise(F.coalesce("right_two", "right_one")).alias("r"),
        F.least("after_one", "after_two").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", group).orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    sizes = flows.where(F.col("k") == 1).groupBy("lang").agg(F.sum("c").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
