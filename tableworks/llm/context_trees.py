"""Language-model scoring by context-tree weighting over bytes.

Every byte is eight binary decisions; each of the 255 places in that decision
tree has a context tree of its own over the bytes before.  A node of a context
tree predicts with the Krichevsky-Trofimov estimate of its counts and mixes it
half and half with what its deeper contexts predict, so all depths take part
with weights that the training data set.  The code length of a text is minus the
logarithm of its probability.

The counts come from all training texts, and every context of up to ``DEPTH``
bytes is a node.  No task holds the trees: what is predicted depends on a context
and a byte alone, so each distinct gram (context and byte) of the texts gets its
probability once, and texts meet the probabilities of their grams.

1. Grams are counted, combined per task before the shuffle.
2. Grams that share their last ``_LOCAL`` context bytes lie in one partition and
   hold whole subtrees of the context trees: weights go up and predictions come
   down inside them.  What is above has at most 65,536 contexts, whatever the
   corpus; it is summed up, weighted on the driver and broadcast.
3. The up to ``MAX_COMMON_GRAMS`` most frequent grams are broadcast with their
   probabilities and looked up where texts lie; all others meet theirs in a join,
   at most one row per text and distinct gram.

A text is its words, lower-cased in A-Z, joined by single spaces, then one end
byte; the byte 0xFF, which UTF-8 never holds, stands for the end and for what
precedes a text.

Defined results: null, empty and blank texts are an end alone; equal texts get
equal scores, whatever their ids; a null id belongs to the training part; with
no training text every byte has probability 1/256 and base counts are 0 (with
base_score 0 for the end alone where N and V are 0); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableworks.llm.common import byte_words, workers_find_package, written

DEPTH = 5
MAX_COMMON_WORDS = 1 << 17
MAX_COMMON_GRAMS = 1 << 19
END = 0xFF
_MERGE_AT = 1 << 21  # grams a task holds before it merges them
_LOCAL = 3  # context bytes that name a subtree
_SUBTREE_GRAMS = 1 << 18  # grams of whole subtrees worked on at once; more only where one subtree has more
_DIGITS = 10**9  # joined digits are summed as whole numbers of this unit: equal texts, equal scores
_TEXTS = 64  # texts whose words are held at once


def held_out(id_col: Column) -> Column:
    """True for ids whose checksum modulo 5 is 1: never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def coded(words: list[bytes]) -> np.ndarray:
    """The bytes to be coded: words, single spaces, end."""
    return np.frombuffer(b" ".join(words) + b"\xff", np.uint8)


def _with_history(texts: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each after ``depth`` end bytes; where coded bytes stand."""
    pad = np.full(depth, END, np.uint8)
    flat = np.concatenate([x for t in texts for x in (pad, t)])
    coded_here = np.ones(len(flat), bool)
    starts = np.cumsum([0, *(len(t) + depth for t in texts[:-1])])
    coded_here[(starts[:, None] + np.arange(depth)).ravel()] = False
    return flat, np.flatnonzero(coded_here)


def _codes(texts: list[np.ndarray], depth: int) -> np.ndarray:
    """The (context, byte) code of every coded byte; the byte is the lowest."""
    flat, at = _with_history(texts, depth)
    code = np.zeros(len(flat) - depth, np.int64)
    for d in range(depth, -1, -1):
        code <<= 8
        code |= flat[depth - d : len(flat) - d]
    return code[at - depth]


def gram_counts(texts: list[np.ndarray], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, byte) codes with counts."""
    return np.unique(_codes(texts, depth), return_counts=True)


def _count_grams(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """(gram, n in training texts, seen in all texts) from (text, held_out)."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        n, seen = (np.bincount(at, np.concatenate([h[i] for h in held]), len(codes)).astype(np.int64) for i in (1, 2))
        return codes, n, seen

    def out() -> Iterator[pa.RecordBatch]:
        columns = merged()
        held.clear()
        for i in range(0, len(columns[0]), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 18)]) for c in columns], ["gram", "n", "seen"])

    for batch in batches:
        texts: dict[bool, list[np.ndarray]] = {False: [], True: []}
        size = 0

        def count() -> None:
            for is_held, some in texts.items():
                if some:
                    codes, n = gram_counts(some, depth)
                    held.append((codes, np.zeros_like(n) if is_held else n, n))
                    some.clear()

        for value, is_held in zip(batch.column(0), batch.column(1).to_pylist()):
            one = coded(byte_words(value.as_py()))
            texts[is_held].append(one)
            size += len(one)
            if size > 1 << 20:
                count()
                size = 0
                if sum(len(h[0]) for h in held) > _MERGE_AT:
                    held[:] = [merged()]
                    if len(held[0][0]) > _MERGE_AT // 2:
                        yield from out()
        count()
    if held:
        yield from out()


# -- the model ----------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5: Stirling's series after shifting x up by 8."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    shift = sum(np.log(x + i) for i in range(8))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)


@dataclass
class ContextTrees:
    """Trees of a small corpus in one process, as ``build_trees`` makes them.

    ``step[node, symbol]`` walks one byte deeper; ``log10p[node, symbol]`` predicts.

    ``symbol_of`` maps bytes to columns; all bytes that never occur in training
    share the last column and, evenly, its probability.
    """

    step: np.ndarray
    log10p: np.ndarray
    symbol_of: np.ndarray
    depth: int

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text."""
        flat, at = _with_history(texts, self.depth)
        flat = self.symbol_of[flat]
        walk, predict, width = self.step.ravel(), self.log10p.ravel(), self.step.shape[1]
        node = np.zeros(len(at), np.int64)
        for d in range(1, self.depth + 1):
            node = walk[node * width + flat[at - d]].astype(np.int64)
        digits = predict[node * width + flat[at]].astype(np.float64)
        return np.add.reduceat(digits, np.cumsum([0, *(len(t) for t in texts[:-1])]))


def build_trees(rows: list[tuple[int, int, int, int]], depth: int = DEPTH) -> ContextTrees:
    """From (depth d, context code of d bytes, byte, count) of all kept contexts.

    The last byte of a context stands lowest in its code, next to the byte it
    predicts.  A kept context's shorter endings are kept as well, because their
    counts are at least as large.
    """
    by_depth: list[dict[int, int]] = [{} for _ in range(depth + 1)]
    counts: list[np.ndarray] = [np.zeros((1, 256))]
    by_depth[0][0] = 0
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    first = np.zeros(depth + 2, np.int64)
    first[1] = 1
    for d in range(depth + 1):
        here = table[table[:, 0] == d]
        contexts, at = np.unique(here[:, 1], return_inverse=True)
        if d:
            by_depth[d] = {int(c): i + int(first[d]) for i, c in enumerate(contexts)}
            counts.append(np.zeros((len(contexts), 256)))
            first[d + 1] = first[d] + len(contexts)
        if len(here):
            np.add.at(counts[d], (at, here[:, 2]), here[:, 3])
    n = int(first[depth + 1])
    count = np.concatenate(counts)
    parent = np.full(n, -1, np.int64)
    level = np.zeros(n, np.int64)
    edge = np.zeros(n, np.int64)
    for d in range(1, depth + 1):
        for code, i in by_depth[d].items():
            parent[i] = by_depth[d - 1][code & ((1 << (8 * (d - 1))) - 1)]
            level[i], edge[i] = d, code >> (8 * (d - 1))
    inner = np.flatnonzero(np.bincount(parent[1:], minlength=n))
    # one leaf for all contexts under a node that are not nodes themselves
    place = np.full(n, -1, np.int64)
    place[inner] = np.arange(len(inner))
    others = count[inner]
    np.subtract.at(others, place[parent[1:]], count[1:])
    count = np.concatenate([count, others])
    parent, level = np.concatenate([parent, inner]), np.concatenate([level, level[inner] + 1])
    total = len(count)

    seen = np.flatnonzero(count[0])
    symbol_of = np.full(256, len(seen), np.int64)
    symbol_of[seen] = np.arange(len(seen))
    step = np.repeat(np.arange(total, dtype=np.int32)[:, None], len(seen) + 1, axis=1)
    step[inner] = (n + np.arange(len(inner), dtype=np.int32))[:, None]
    step[parent[1:n], symbol_of[edge[1:n]]] = np.arange(1, n)

    is_inner = np.zeros(total, bool)
    is_inner[inner] = True
    levels = [np.flatnonzero(level == d) for d in range(int(level.max()) + 1)]
    # The 255 places of the decision tree, a few at a time: place 2^k - 1 + p is
    # reached by the first k bits p, and splits its bytes into zeros and ones.
    mixed = np.empty((total, 255))
    for k in range(8):
        halves = count.reshape(total, 2**k, 2, -1)
        for first in range(0, 2**k, 16):
            split = halves[:, first : first + 16].sum(axis=3)
            place = 2**k - 1 + first
            mixed[:, place : place + split.shape[1]] = _mixed(split[:, :, 0], split[:, :, 1], parent, levels, is_inner)
    del count, others, halves
    table = np.empty((total, len(seen) + 1), np.float32)
    unseen = np.flatnonzero(symbol_of == len(seen))
    for first in range(0, total, 4096):
        part = mixed[first : first + 4096]
        digits = np.zeros((len(part), 1))
        for k in range(8):
            p1 = part[:, 2**k - 1 : 2 ** (k + 1) - 1]
            digits = np.stack([digits + np.log10(1 - p1), digits + np.log10(p1)], axis=2).reshape(len(part), -1)
        table[first : first + 4096, :-1] = digits[:, seen]
        even = (10.0 ** digits[:, unseen]).mean(axis=1) if len(unseen) else np.ones(len(part))
        table[first : first + 4096, -1] = np.log10(np.maximum(even, 1e-300))
    return ContextTrees(step, table, symbol_of, depth)


def _mixed(zeros: np.ndarray, ones: np.ndarray, parent: np.ndarray, levels: list[np.ndarray], is_inner: np.ndarray) -> np.ndarray:
    """Probability of a one at every node, all depths above it mixed in."""
    own = _log_kt(zeros, ones)
    weighted, children = own.copy(), np.zeros_like(own)
    share = np.ones_like(own)  # weight of a node's own estimate against its children's
    for d in range(len(levels) - 1, -1, -1):
        here = levels[d][is_inner[levels[d]]]
        weighted[here] = np.logaddexp(own[here], children[here]) - math.log(2)
        share[here] = np.exp(own[here] - math.log(2) - weighted[here])
        if d:
            np.add.at(children, parent[levels[d]], weighted[levels[d]])
    one = (ones + 0.5) / (zeros + ones + 1.0)
    mixed, left = share * one, 1 - share
    for at in levels[1:]:
        up = parent[at]
        mixed[at] = mixed[up] + left[up] * share[at] * one[at]
        left[at] = left[up] * (1 - share[at])
    return np.clip(mixed, 1e-12, 1 - 1e-12)


def _above(key: np.ndarray, d: int) -> np.ndarray:
    """(context of d bytes, byte prefix or place) keys of nodes from those of deeper ones."""
    return ((key >> 8) & ((1 << (8 * d)) - 1)) << 8 | key & 255


def _up(
    key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None, depth: int, base: int
) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Weights from level ``depth`` up to ``base``, for nodes with sorted distinct keys.

    Per level (share of the own estimate, estimate of a one, place of the parent);
    and (key, zeros, ones, weight) of level ``base``.  ``children`` is None for leaves.
    """
    levels = []
    for d in range(depth, base - 1, -1):
        seen = zeros + ones
        own = np.where(seen > 0, _log_kt(zeros, ones), 0.0)
        weighted = own if children is None else np.logaddexp(own, children) - math.log(2)
        share = np.ones(len(own)) if children is None else np.exp(own - math.log(2) - weighted)
        parents, up = np.unique(_above(key, d - 1), return_inverse=True) if d > base else (key, np.arange(len(key)))
        levels.append((share, (ones + 0.5) / (seen + 1.0), up))
        if d > base:
            key = parents
            zeros, ones, children = (np.bincount(up, x, len(key)) for x in (zeros, ones, weighted))
    return levels, (key, zeros, ones, weighted)


def predict_subtrees(gram: np.ndarray, n: np.ndarray, depth: int, base: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For sorted distinct grams of whole subtrees under contexts of ``base`` bytes.

    The probability of each of the 8 bits by the subtree alone, and what the level
    above sums up: (context and place, zeros, ones, weight).
    """
    byte = gram & 255
    bits = np.empty((len(gram), 8), np.float32)
    above: list[tuple[np.ndarray, ...]] = []
    for k in range(8):
        bit = (byte >> (7 - k)) & 1
        key = (gram >> 8) << 8 | byte >> (8 - k)
        new = np.append(True, key[1:] != key[:-1])
        at = np.cumsum(new) - 1
        ones, both = np.bincount(at, n * bit), np.bincount(at, n)
        levels, (top, *sums) = _up(key[new], both - ones, ones, None, depth, base)
        node, one = np.arange(len(ones)), np.zeros(len(ones))
        for share, estimate, up in levels:  # from the leaves: each level mixes its own in
            one = share[node] * estimate[node] + (1 - share[node]) * one
            node = up[node]
        one = one[at]
        bits[:, k] = np.where(bit, one, 1 - one)
        if base:
            parents, up = np.unique(_above(top, base - 1) + (2**k - 1), return_inverse=True)
            above.append((parents, *(np.bincount(up, x, len(parents)) for x in sums)))
    return bits, [np.concatenate(c) for c in zip(*above)]


def _predict(batches: Iterator[pa.RecordBatch], depth: int, base: int) -> Iterator[pa.RecordBatch]:
    """Rows of grams with their 8 bits, and rows of nodes for the level above, from rows sorted by subtree."""
    held: list[list[np.ndarray]] = []
    size = 0

    def out(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(columns[0])
        gram, n, seen = (c[order] for c in columns)
        bits, above = predict_subtrees(gram, n, depth, base)
        for i in range(0, len(gram), 1 << 16):
            part = bits[i : i + (1 << 16)]
            offsets = pa.py_buffer(np.arange(0, 32 * len(part) + 1, 32, dtype=np.int32))
            packed = pa.Array.from_buffers(pa.binary(), len(part), [None, offsets, pa.py_buffer(part.tobytes())])
            none = [pa.nulls(len(part), t) for t in (pa.int64(), pa.float64(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(gram[i : i + len(part)]), pa.array(seen[i : i + len(part)]), packed, *none], _PREDICTED)
        if above:
            rows = len(above[0])
            none = [pa.nulls(rows, t) for t in (pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *map(pa.array, above)], _PREDICTED)

    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size > _SUBTREE_GRAMS:
            columns = [np.concatenate(c) for c in zip(*held)]
            subtree = _above(columns[0], base) >> 8
            whole = int(np.flatnonzero(subtree != subtree[-1]).max(initial=-1)) + 1
            if whole:
                yield from out([c[:whole] for c in columns])
            # a single larger subtree is held until it ends
            held = [[c[whole:] for c in columns]]
            size = 0 if len(columns[0]) - whole > _SUBTREE_GRAMS // 2 else len(columns[0]) - whole
    if held and sum(len(h[0]) for h in held):
        yield from out([np.concatenate(c) for c in zip(*held)])


_PREDICTED = ["gram", "seen", "bits", "node", "zeros", "ones", "weight"]


def _top(rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, mixed, left) of the nodes of ``depth`` bytes: the prediction of all levels down to there, and the weight left below."""
    rows = rows[np.argsort(rows[:, 0])]
    key = rows[:, 0].astype(np.int64)
    levels, _ = _up(key, rows[:, 1], rows[:, 2], rows[:, 3], depth, 0)
    path = [np.arange(len(key))]
    for _, _, up in levels[:-1]:
        path.append(up[path[-1]])
    mixed, left = np.zeros(len(key)), np.ones(len(key))
    for (share, estimate, _), node in zip(reversed(levels), reversed(path)):
        mixed += left * share[node] * estimate[node]
        left *= 1 - share[node]
    return key, mixed, left


def _digits(batches: Iterator[pa.RecordBatch], base: int, top) -> Iterator[pa.RecordBatch]:
    """(gram, seen, log10 probability of its byte after its context)."""
    keys, mixed, left = top.value
    for batch in batches:
        gram = batch.column(0).to_numpy()
        column = batch.column(2)
        bits = np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, 8).astype(float)
        digits = np.zeros(len(gram))
        for k in range(8):
            p = bits[:, k]
            if base:
                place = (2**k - 1) + ((gram & 255) >> (8 - k))
                at = np.searchsorted(keys, _above(gram >> 8 << 8 | place, base - 1))
                upper = np.where((gram >> (7 - k)) & 1, mixed[at], 1 - left[at] - mixed[at])
                p = upper + left[at] * p
            digits += np.log10(np.clip(p, 1e-12, 1 - 1e-12))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digits)], ["gram", "seen", "digits"])


def gram_digits(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, seen, digits) of every gram of (text, held_out) rows, by the context trees of all texts not held out."""
    sc = texts.sparkSession.sparkContext
    base = min(_LOCAL, depth)
    subtree = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << (8 * base)) - 1))
    grams = texts.mapInArrow(partial(_count_grams, depth=depth), "gram long, n long, seen long").withColumn("subtree", subtree)
    grams = grams.repartition("subtree").groupBy("subtree", "gram").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    grams = grams.sortWithinPartitions("subtree").select("gram", "n", "seen")
    kinds = "gram long, seen long, bits binary, node long, zeros double, ones double, weight double"
    predicted = written(grams.mapInArrow(partial(_predict, depth=depth, base=base), kinds), "gram-bits")
    top = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    if base:
        nodes = predicted.filter(F.col("node").isNotNull()).groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weight"))
        # contexts of two bytes with 255 places at most, whatever the corpus
        rows = np.stack([c.to_numpy().astype(float) for c in nodes.toArrow().columns], axis=1)
        if len(rows):
            top = _top(rows, base - 1)
    found = predicted.filter(F.col("gram").isNotNull()).select("gram", "seen", "bits")
    return written(found.mapInArrow(partial(_digits, base=base, top=sc.broadcast(top)), "gram long, seen long, digits double"), "gram-digits")


def _most_seen(digits: DataFrame) -> Column:
    """True for grams seen often enough that at most ``MAX_COMMON_GRAMS`` are."""
    step = F.floor(F.log2("seen") * 16)
    steps = sorted(digits.groupBy(step.alias("step")).count().collect(), reverse=True)  # some hundred rows at most
    least, so_far = None, 0
    for r in steps:
        so_far += r["count"]
        if so_far > MAX_COMMON_GRAMS:
            break
        least = r["step"]
    return F.lit(False) if least is None else step >= least


# -- scoring, with the base of word counts -------------------------------------


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


END_HASH = int(_hashes([b"\xff end"])[0])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 4 * _TEXTS):
            some = batch.column(0).slice(first, 4 * _TEXTS).to_pylist()
            h = np.concatenate([_hashes(byte_words(t)) for t in some] + [np.full(len(some), END_HASH)])
            words, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64))], ["word", "n"])


def _split_common(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Where each hash stands among the sorted common ones; -1 if it doesn't."""
    if not len(common):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return np.where(common[at] == h, at, -1)


class _Lookup:
    """Values of 64-bit keys in an open-addressed table, asked for by the array."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = 64 - max(4, (4 * len(keys) - 1).bit_length())
        size = 1 << (64 - self.shift)
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size)  # no code is negative
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = keys[free]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (size - 1)
        self.values[slot] = values

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, 0 for an unknown key, and which keys are known."""
        slot = self._slots(keys)
        there = self.keys[slot]
        known = there == keys
        left = np.flatnonzero(~known & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[left]]
            known[left] = there == keys[left]
            left = left[~known[left] & (there >= 0)]
        return np.where(known, self.values[slot], 0.0), known


_SCORED = pa.struct(
    [("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("common_known", pa.int64()),
     ("common_base", pa.float64()), ("common_score", pa.float64()), ("n_bytes", pa.int64())]
)


def _score(batches: Iterator[pa.RecordBatch], common, grams, depth: int) -> Iterator[pa.RecordBatch]:
    """(row, is_gram, item, n, scored): a row per text with what the common words and grams give, and its others."""
    known, count, scale = common.value
    weight = np.log10((count + 0.5) / scale) if len(known) else np.zeros(0)
    table = _Lookup(*grams.value)
    for batch in batches:
        for first in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(first, _TEXTS)
            some = [byte_words(t) for t in part.column(1).to_pylist()]
            texts = [coded(words) for words in some]
            codes = _codes(texts, depth)
            digits, is_known = table.get(codes)
            starts = np.cumsum([0, *(len(t) for t in texts)])
            score = np.add.reduceat(digits, starts[:-1])
            out: list[tuple[np.ndarray, ...]] = []
            n_known, base, marks, rows = [], [], [], 0
            for k, (row, words) in enumerate(zip(part.column(0).to_pylist(), some)):
                hashes = np.append(_hashes(words), END_HASH)
                at = _split_common(hashes, known)
                base.append(float(weight[at[at >= 0]].sum()))
                n_known.append(int((at >= 0).sum()))
                w, n = np.unique(hashes[:-1][at[:-1] < 0], return_counts=True)
                mine = slice(starts[k], starts[k + 1])
                g, m = np.unique(codes[mine][~is_known[mine]], return_counts=True)
                size = len(w) + len(g) + 1
                # the text's own row goes where its key leads
                out.append((np.full(size, row, np.int64), np.arange(size) > len(w), np.concatenate([w, [row], g]), np.concatenate([n, [-1], m])))
                marks.append(rows + len(w))
                rows += size
            columns = [part.column(2), part.column(3), pa.array([len(w) + 1 for w in some], pa.int64()), pa.array(n_known, pa.int64()),
                       pa.array(base, pa.float64()), pa.array(score, pa.float64()), pa.array([len(t) for t in texts], pa.int64())]
            place = np.full(rows, -1)
            place[marks] = np.arange(len(some))
            scored = pa.StructArray.from_arrays(columns, fields=list(_SCORED)).take(pa.array(place, mask=place < 0))
            row, is_gram, item, n = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(is_gram), pa.array(item), pa.array(n.astype(np.int32)), scored], ["row", "is_gram", "item", "n", "scored"]
            )


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) per row.

    Words that hold at least ``1 / MAX_COMMON_WORDS`` of the training tokens are
    at most that many and are broadcast with their counts, the most frequent grams
    with their digits; all others meet their values in a join, at most one row per
    text and distinct word or gram.
    """
    workers_find_package(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    text = F.col(f"`{text_col}`")
    one = docs.select(
        F.xxhash64(F.col(f"`{id_col}`"), text).alias("row"), text.alias("text"), F.col(f"`{id_col}`").cast("long").alias("id"),
        held_out(F.col(f"`{id_col}`")).alias("held_out"),
    )
    training = one.filter(~F.col("held_out")).select("text")
    vocabulary = written(training.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    total, distinct = vocabulary.agg(F.sum("c"), F.count("*")).first()
    total = total or 0
    scale = total + 0.5 * (distinct + 1)
    is_common = (F.col("c") * MAX_COMMON_WORDS >= total) | (F.col("word") == END_HASH)
    common = sorted((r["word"], r["c"]) for r in vocabulary.filter(is_common).collect())
    shared = sc.broadcast((np.array([w for w, _ in common], np.int64), np.array([c for _, c in common], float), scale))
    digits = gram_digits(one.select("text", "held_out"), depth)
    often = _most_seen(digits)
    frequent = digits.filter(often).select("gram", "digits").toArrow()
    codes = frequent["gram"].to_numpy()
    order = np.argsort(codes)
    grams = sc.broadcast((codes[order], frequent["digits"].to_numpy()[order]))
    del frequent, codes, order

    schema = (
        "row long, is_gram boolean, item long, n int, scored struct<id: long, held_out: boolean, n_tokens: long, "
        "common_known: long, common_base: double, common_score: double, n_bytes: long>"
    )
    rows = one.select("row", "text", "id", "held_out").mapInArrow(partial(_score, common=shared, grams=grams, depth=depth), schema)
    values = vocabulary.filter(~is_common).select(F.lit(False).alias("is_gram"), F.col("word").alias("item"), "c", F.lit(None).cast("double").alias("digits"))
    values = values.unionByName(digits.filter(~often).select(F.lit(True).alias("is_gram"), F.col("gram").alias("item"), F.lit(None).cast("long").alias("c"), "digits"))
    counted = rows.join(values, ["is_gram", "item"], "left")
    marker = F.col("n") < 0
    word = ~F.col("is_gram") & ~marker
    value = F.log10((F.coalesce(F.col("c"), F.lit(0)) + 0.5) / F.lit(scale)) * F.col("n")
    # rows with equal id and text share a key: their sums are divided by how many they are, and each comes out
    by_row = counted.groupBy("row").agg(
        F.sum(F.when(marker, 1).otherwise(0)).alias("copies"),
        *[F.max(f"scored.{f.name}").alias(f.name) for f in _SCORED],
        F.sum(F.when(word, value).otherwise(0.0)).alias("rare_base"),
        F.sum(F.when(word & F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.when(F.col("is_gram"), F.round(F.col("digits") * _DIGITS).cast("long") * F.col("n")).otherwise(0)).alias("rare_digits"),
    )
    scored = by_row.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    scored = scored.withColumn("score", F.col("common_score") + F.col("rare_digits") / F.col("copies") / _DIGITS)
    end = 0.0 if common else math.log10(0.5 / scale)  # without training texts the end is unknown as well
    return scored.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("common_known") + (F.col("rare_known") / F.col("copies")).cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("common_base") + F.col("rare_base") / F.col("copies") + F.lit(end)).alias("base_score"),
        "score", "n_bytes", (-F.col("score") / F.col("n_bytes") / F.lit(math.log10(2))).alias("bits_per_byte"),
    )
