"""Packing by vector bin packing with the dot-product heuristic.

Items have a size in several dimensions at once (tokens, segments, loss-bearing
tokens) and a bin has a limit in each.  An open bin takes, again and again, the
fitting item with the largest dot product between its size and the room left,
both as shares of the limits and weighted by how scarce each dimension is in
the pool.  Whole items only: ``pack_examples`` (instruction data).  Texts may be
cut: ``pack_documents`` closes each bin by cutting an item to the exact gap, so
nearly all sequences are full, and breaks a partition's last tokens into
sequences whose lengths are powers of two, which need no padding.

Work stays inside each input partition: no shuffle, a bounded pool per task,
and rows come out the same when a lost task runs again, because a partition of
files is read again in the same order.

Defined results: a null or empty text is the end id alone; equal rows are packed
each on its own; an empty table gives no pieces; a null id stays null; other
columns are ignored.  A very long text is streamed out in full sequences.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tableworks.llm.common import workers_find_package

END_ID = 0

# Fixed value: how the byte-level tokenizers of this kind split a text first.
GPT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], float)


class Pool:
    """Items that wait for a bin: a fixed number of slots with their sizes.

    Every item is one segment, so tokens and loss-bearing tokens are all that
    is kept; a free slot holds infinities, which fit nowhere.
    """

    def __init__(self, slots: int, limits: Limits):
        self.limits, self.cap = limits, limits.vector()
        self.tokens, self.loss = np.full(slots, np.inf), np.full(slots, np.inf)
        self.items: list[object] = [None] * slots
        self.free = list(range(slots))[::-1]

    def __len__(self) -> int:
        return len(self.items) - len(self.free)

    def add(self, item: object, tokens: int, loss: int) -> None:
        slot = self.free.pop()
        self.items[slot] = item
        self.tokens[slot], self.loss[slot] = tokens, loss

    def take(self, slot: int) -> object:
        item, self.items[slot] = self.items[slot], None
        self.tokens[slot] = self.loss[slot] = np.inf
        self.free.append(slot)
        return item

    def best(self, room: tuple[float, float, float]) -> int | None:
        """The fitting item with the largest weighted dot product; ties: first slot."""
        if room[1] < 1:
            return None
        fits = ((self.tokens <= room[0]) & (self.loss <= room[2])).nonzero()[0]
        if not len(fits):
            return None
        tokens, loss = self.tokens[fits], self.loss[fits]
        cap = self.cap
        # average demand weighs each dimension; the segment's part is the same for all items
        weigh_tokens = tokens.sum() / len(fits) / cap[0] * room[0] / cap[0] / cap[0]
        weigh_loss = loss.sum() / len(fits) / cap[2] * room[2] / cap[2] / cap[2]
        return int(fits[np.argmax(tokens * weigh_tokens + loss * weigh_loss)])

    def longest(self) -> int | None:
        if not len(self):
            return None
        return int(np.argmax(np.where(np.isinf(self.tokens), -1, self.tokens)))

    def held(self) -> int:
        return int(self.tokens[np.isfinite(self.tokens)].sum())


# -- texts ------------------------------------------------------------------


def byte_level_bpe(path: str):
    """The byte-level BPE of a ``tokenizers`` JSON file, run by tiktoken.

    Both libraries give the same ids (a test compares them); tiktoken takes a
    quarter of the time.  In such a vocabulary a lower id is an earlier merge,
    and every byte is written as a printable character.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if not (token.startswith("<|") and token.endswith("|>"))}
    return tiktoken.Encoding("byte_level", pat_str=GPT_PATTERN, mergeable_ranks=ranks, special_tokens={})


def special_strings(path: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` JSON file, which stand for one id wherever a text holds them."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    odd = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens that take in or need what stands around them are not supported: {odd}")
    return {t["content"]: t["id"] for t in added}


class _Places(dict):
    """Places of chunks; a chunk seen for the first time gets the next one and is noted in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        place = self[chunk] = len(self)
        self.new.append(chunk)
        return place


class ChunkTokenizer:
    """Ids of a tokenizer file, with the ids of space-separated chunks remembered.

    In the byte-level pattern a single space opens the next token, so the ids of
    ``a b`` are those of ``a`` followed by those of `` b``; the same holds at a
    single line feed.  Texts with other runs of white space go to the tokenizer
    whole.  The memory is bounded: it starts anew after ``max_chunks`` chunks.
    """

    def __init__(self, path: str, max_chunks: int = 200_000):
        self.bpe = byte_level_bpe(path)
        self.special = special_strings(path)
        self.cut_special = re.compile("(" + ("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)") + ")")
        self.line_feed = self.bpe.encode_ordinary("\n")[0]
        self.max_chunks = max_chunks
        self.clear()

    def clear(self) -> None:
        self.at = _Places()
        self.flat = np.zeros(1 << 20, np.uint32)
        self.begin = np.zeros(self.max_chunks + 1, np.int64)
        self.length = np.zeros(self.max_chunks + 1, np.int64)
        self.used = 0

    def encode_plain(self, text: str) -> np.ndarray:
        """Ids of a text without special strings.

        The white space before a word is a token of its own but for its last
        character.  Very long runs are cut there: the pattern's engine gives up
        on a run of a million.
        """
        if not text:
            return np.zeros(0, np.uint32)
        ids: list[int] = []
        begin = 0
        for run in _LONG_RUN.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.bpe.encode_ordinary(text[begin : run.start()])
            ids += self.bpe._encode_single_piece(text[run.start() : end])
            begin = end
        return np.array(ids + self.bpe.encode_ordinary(text[begin:]), np.uint32)

    def encode_with_special(self, text: str) -> np.ndarray:
        parts = [
            np.array([self.special[part]], np.uint32) if part in self.special else self.encode_plain(part)
            for part in self.cut_special.split(text)
        ]
        return np.concatenate(parts)

    def _learn(self, new: list[str]) -> None:
        """Encode all new chunks, which have the last places, at once, one to a line.

        A chunk with white space inside has ids that depend on its neighbours;
        it is kept with length 0, which no other chunk has.
        """
        bodies = [c[1:] if c[0] == "\n" else " " + c for c in new]
        if len("\n".join(bodies).split()) != len(new):
            bodies = [b if len(b.split()) == 1 and b == " " * (b[0] == " ") + b.split()[0] else "" for b in bodies]
        ids = np.array(self.bpe.encode_ordinary("\n".join(b or "x" for b in bodies) + "\n"), np.uint32)
        ends = np.flatnonzero(ids == self.line_feed)
        begins = np.concatenate([[0], ends[:-1] + 1])
        odd = np.fromiter((not b for b in bodies), bool, len(bodies))
        opens_line = np.fromiter((c[0] == "\n" for c in new), bool, len(new))
        k = len(self.at) - len(new)
        while self.used + len(ids) + 1 > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        # a line feed stands in front of each line's ids, and belongs to chunks that open a line
        self.flat[self.used] = self.line_feed
        self.flat[self.used + 1 : self.used + 1 + len(ids)] = ids
        self.begin[k : k + len(new)] = self.used + 1 + begins - opens_line
        self.length[k : k + len(new)] = np.where(odd, 0, ends - begins + opens_line)
        self.used += len(ids) + 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as uint32."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group: list[tuple[int, list[str]]] = []
        held = 0
        for i, text in enumerate(texts):
            if any(t in text for t in self.special):
                out[i] = self.encode_with_special(text)
                continue
            # the line feed in front makes the first chunk like one that opens a line
            chunks = ("\n" + text.replace("\n", " \n")).split(" ")
            if "" in chunks or "\n" in chunks:
                out[i] = self.encode_plain(text)
                continue
            group.append((i, chunks))
            held += len(chunks)
            if held >= 50_000:
                self._encode_group(group, out)
                group, held = [], 0
        if group:
            self._encode_group(group, out)
        return out

    def _encode_group(self, group: list[tuple[int, list[str]]], out: list[np.ndarray | None]) -> None:
        chunks = [c for _, one in group for c in one]
        if len(self.at) + len(chunks) > self.max_chunks and len(self.at) + sum(c not in self.at for c in set(chunks)) > self.max_chunks:
            self.clear()
            if len(set(chunks)) > self.max_chunks:  # one text with more distinct chunks than are kept
                for i, one in group:
                    out[i] = self._whole(one)
                return
        at = np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))
        if self.at.new:
            new, self.at.new = self.at.new, []
            self._learn(new)
        length = self.length[at]
        ends = np.cumsum(length)
        ids = self.flat[np.repeat(self.begin[at] - (ends - length), length) + np.arange(ends[-1])]
        bounds = np.cumsum([len(one) for _, one in group])
        stops = ends[bounds - 1]
        odd = np.add.reduceat(length == 0, np.concatenate([[0], bounds[:-1]]))
        begin = 0
        for (i, one), stop, n in zip(group, stops.tolist(), odd.tolist()):
            out[i] = self._whole(one) if n else ids[begin + 1 : stop]  # without the line feed in front
            begin = stop

    def _whole(self, chunks: list[str]) -> np.ndarray:
        return self.encode_plain(" ".join(chunks)[1:].replace(" \n", "\n"))


#: Runs of white space that are cut off before the pattern sees them.
_LONG_RUN = re.compile(r"\s{5000,}")


def white_ids(path: str) -> np.ndarray:
    """For each id whether it is white space only."""
    tokenizer = _tokenizer(path)
    bpe = tokenizer.bpe
    flags = np.zeros(max(bpe.max_token_value, *tokenizer.special.values(), 0) + 1, bool)
    for token in bpe.token_byte_values():
        flags[bpe.encode_single_token(token)] = not token.strip()
    return flags


_TOKENIZERS: dict[str, ChunkTokenizer] = {}
_WHITE: dict[str, np.ndarray] = {}


def _tokenizer(path: str) -> ChunkTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


@dataclass
class Rest:
    """What is left of a document: ids from ``start`` to ``stop``.

    ``loss`` counts the loss-bearing ids before each place of the whole document.
    """

    doc: object
    ids: np.ndarray
    start: int
    loss: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def bears(self) -> int:
        return int(self.loss[self.start + len(self.ids)] - self.loss[self.start])

    def fitting(self, tokens: float, loss: float) -> int:
        """How many ids from the start have at most so many tokens and loss-bearing ones."""
        n = min(len(self.ids), int(tokens))
        if self.loss[self.start + n] - self.loss[self.start] > loss:
            n = int(np.searchsorted(self.loss, self.loss[self.start] + loss, "right")) - 1 - self.start
        return n

    def cut(self, n: int) -> tuple[Rest, Rest]:
        return Rest(self.doc, self.ids[:n], self.start, self.loss), Rest(self.doc, self.ids[n:], self.start + n, self.loss)


class DocumentPacker:
    """Packs the documents of one partition; pieces come out in sequence order.

    Loss-bearing are all ids but white space and the end id.
    """

    def __init__(self, first_sequence: int, limits: Limits, slots: int, white: np.ndarray | None = None):
        self.sequence = first_sequence
        self.limits = limits
        self.bearing = None if white is None else ~white
        self.pool = Pool(slots, limits)
        self.rows: list[tuple] = []

    def emit(self, pieces: list[Rest]) -> None:
        offset = 0
        for p in pieces:
            self.rows.append((p.doc, p.start, len(p), zlib.crc32(p.ids), len(p.loss) - 1, self.sequence, offset))
            offset += len(p)
        self.sequence += 1

    def add(self, doc: object, ids: np.ndarray) -> None:
        """``ids`` are little-endian unsigned 32-bit, the end id last."""
        loss = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(np.ones(len(ids), bool) if self.bearing is None else self.bearing[ids], out=loss[1:])
        loss[-1] = loss[-2] if self.bearing is not None else loss[-1]
        rest = Rest(doc, ids, 0, loss)
        while len(rest) >= self.limits.tokens or rest.bears() >= self.limits.loss_tokens:
            piece, rest = rest.cut(rest.fitting(self.limits.tokens, self.limits.loss_tokens))
            self.emit([piece])
        if len(rest):
            while not self.pool.free:
                self.fill()
            # what waits keeps its own ids only, not those of the texts encoded with it
            rest = Rest(doc, rest.ids.copy(), rest.start, rest.loss)
            self.pool.add(rest, len(rest), rest.bears())

    def fill(self, target: int | None = None) -> int:
        """One sequence of exactly ``target`` tokens, or as near as the limits allow; its tokens."""
        tokens, segments, loss = float(target or self.limits.tokens), float(self.limits.segments), float(self.limits.loss_tokens)
        whole, pieces = tokens, []
        while tokens >= 1 and segments >= 1 and len(self.pool):
            # the last segment has to fill the gap, so it is cut from the longest item
            slot = self.pool.best((tokens, segments, loss)) if segments > 1 else None
            if slot is None:
                item = self.pool.take(self.pool.longest())
                n = item.fitting(tokens, loss)
                if n < len(item):
                    item, rest = item.cut(n)
                    self.pool.add(rest, len(rest), rest.bears())
                if not n:
                    break
            else:
                item = self.pool.take(slot)
            pieces.append(item)
            tokens, segments, loss = tokens - len(item), segments - 1, loss - item.bears()
        self.emit(pieces)
        return int(whole - tokens)

    def finish(self) -> None:
        left = self.pool.held()
        while left:
            left -= self.fill(self.limits.tokens if left >= self.limits.tokens else 1 << (left.bit_length() - 1))

    def flush(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


PIECE_COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, limits: Limits, slots: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    tok = _tokenizer(path)
    if path not in _WHITE:
        _WHITE[path] = white_ids(path)
    packer = DocumentPacker(part << 40, limits, slots, _WHITE[path])

    def out() -> Iterator[pa.RecordBatch]:
        if rows := packer.flush():
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            some = batch.slice(first, 256)
            texts = [t or "" for t in some.column(1).to_pylist()]
            for doc, ids in zip(some.column(0).to_pylist(), tok.encode(texts)):
                packer.add(doc, np.append(ids, np.uint32(END_ID)).astype("<u4", copy=False))
            yield from out()
    packer.finish()
    yield from out()


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limits: Limits = Limits(),
    pool_slots: int = 256,
) -> DataFrame:
    """Cut and pack texts into sequences; one row per piece.

    A piece is ``length`` ids from the document's ``start``-th on, at ``offset``
    of sequence ``sequence_id``; ``ids_crc32`` is the checksum of its ids as
    little-endian 32-bit integers and ``doc_tokens`` counts the document's ids
    with the end id.  Special strings inside a text are one id each, as the
    library takes them by default.  Ids of white space and the end id bear no loss.
    """
    workers_find_package(docs.sparkSession)
    one = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    out = T.StructType([one.schema[id_col], *T.StructType.fromDDL(PIECE_COLUMNS).fields])
    return one.mapInArrow(partial(_pieces, path=tokenizer_path, limits=limits, slots=pool_slots, schema=to_arrow_schema(out)), out)


# -- whole examples ---------------------------------------------------------


class ExamplePacker:
    """Bins of whole examples, filled from a pool that lasts over all batches of a partition."""

    def __init__(self, first_bin: int, limits: Limits, slots: int):
        self.limits, self.pool, self.next = limits, Pool(slots, limits), first_bin

    def _fill(self) -> Iterator[tuple[object, int]]:
        room = self.limits.tokens, self.limits.segments, self.limits.loss_tokens
        while (slot := self.pool.best(room)) is not None:
            room = room[0] - self.pool.tokens[slot], room[1] - 1, room[2] - self.pool.loss[slot]
            yield self.pool.take(slot), self.next
        self.next += 1

    def add(self, example: object, tokens: int, loss: int) -> Iterator[tuple[object, int]]:
        """Take an example; yields (example, bin) of those that are placed now."""
        if tokens > self.limits.tokens or loss > self.limits.loss_tokens:
            yield example, self.next  # too large for any bin: one of its own
            self.next += 1
            return
        while not self.pool.free:
            yield from self._fill()
        self.pool.add(example, tokens, loss)

    def finish(self) -> Iterator[tuple[object, int]]:
        while len(self.pool):
            yield from self._fill()


def pack_vectors(tokens: list[int], loss: list[int], limits: Limits, slots: int = 2048) -> list[int]:
    """The bin of each example; one that exceeds a limit alone gets a bin of its own."""
    packer, bins = ExamplePacker(0, limits, slots), [-1] * len(tokens)
    for i, (t, l) in enumerate(zip(tokens, loss)):
        for k, b in packer.add(i, t, l):
            bins[k] = b
    for k, b in packer.finish():
        bins[k] = b
    return bins


def pack_examples(
    examples: DataFrame, tokens_col: str, loss_col: str, limits: Limits = Limits(), pool_slots: int = 2048
) -> DataFrame:
    """Whole examples (never cut) with a ``sequence_id`` each; null sizes count as 0.

    The pool of waiting examples is kept from batch to batch of a partition; it
    holds at most ``pool_slots`` rows.
    """
    workers_find_package(examples.sparkSession)
    name = "sequence_id"
    if name in examples.columns:
        raise ValueError("the examples already have a column sequence_id")
    places = [examples.columns.index(c) for c in (tokens_col, loss_col)]
    out = T.StructType([*examples.schema.fields, T.StructField(name, T.LongType())])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = ExamplePacker((TaskContext.get().partitionId() if TaskContext.get() else 0) << 40, limits, pool_slots)
        placed: list[tuple[pa.RecordBatch, int]] = []

        def some() -> Iterator[pa.RecordBatch]:
            rows, bins = [r for r, _ in placed], pa.array([b for _, b in placed], pa.int64())
            placed.clear()
            if rows:
                table = pa.Table.from_batches(rows).combine_chunks()
                columns = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns]
                yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(columns, schema)], bins], schema=schema)

        for batch in batches:
            sizes = [batch.column(i).to_pylist() for i in places]
            for i, (t, l) in enumerate(zip(*sizes)):
                placed += packer.add(batch.slice(i, 1), int(t or 0), int(l or 0))
            yield from some()
        placed += packer.finish()
        yield from some()

    return examples.mapInArrow(run, out)
