"""SentencePiece encoding and decoding with N-best segmentation.

A text becomes ``_`` (U+2581) for each space, one more in front, and is cut into
pieces of the model; a segmentation's score is the sum of its pieces' scores.
Characters without a piece fall back to byte pieces at a fixed penalty below the
lowest score.  The lattice of all pieces is searched twice: a forward Viterbi
pass finds the best score up to every position, and a backward A* search from
the end uses these scores as an exact estimate of what remains, so segmentations
come out best first and no other path is expanded.

No piece holds a space mark after another character, so the lattice falls into
independent chunks at spaces and at line feeds.  Chunks are searched once and
remembered (bounded); a text's N best segmentations differ from its best one
only in the ``N - 1`` chunks whose second best is nearest.  Equal scores: which
of them comes first is fixed by the order of the search.

Defined results: null and empty texts have one segmentation without pieces and
score 0; with fewer than N segmentations all are returned; equal rows give equal
rows; an empty table gives an empty result; other columns are ignored.
Decoding gives back exactly the encoded text, space marks in it included.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableworks.llm.common import workers_find_package

#: Decimals in which two totals are one and the same.
TIE_DIGITS = 9

# Fixed values of the format: the space mark, and by how much an unknown
# character scores below the lowest piece.
SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0
_LITERAL_MARK = "\ud800"  # stands for a space mark in the text itself; no valid text holds it

Path = tuple[float, tuple[int, ...]]


class Pieces:
    """The vocabulary of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.raw: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i))
            self.raw.append(b"")
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.raw[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.raw[i] = piece.replace(SPACE_MARK, " ").encode()
        self.raw_flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_length = np.array([len(r) for r in self.raw], np.int64)
        self.raw_begin = np.cumsum(self.raw_length) - self.raw_length
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), self.scores[i], (i,)))
        self.automaton.make_automaton()
        usable = [self.scores[i] for i in self.ids.values() if self.scores[i] > -1e8]
        self.unknown = min(usable, default=0.0) - UNKNOWN_PENALTY
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids):
            raise ValueError("pieces with a space mark after another character are not supported")

    def fallback(self, char: str) -> tuple[int, ...]:
        if char == _LITERAL_MARK:
            char = SPACE_MARK
        return tuple(self.byte_id[b] for b in char.encode())

    def nbest(self, chunk: str, n: int) -> list[Path]:
        """The ``n`` best segmentations of a chunk as (score, ids), best first.

        Equal totals (to ``TIE_DIGITS`` decimals) come in the order in which the
        search, which prefers to go on near the start, completes them.
        """
        size = len(chunk)
        best = [float("-inf")] * (size + 1)  # forward Viterbi
        best[0] = 0.0
        into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        done = 0
        for last, (length, s, piece) in self.automaton.iter(chunk):
            end = last + 1
            while done < last:  # characters without a piece of their own
                done += 1
                self._unknown_edge(chunk, done, best, into)
            into[end].append((end - length, s, piece))
            if best[end - length] + s > best[end]:
                best[end] = best[end - length] + s
            if length == 1:
                done = end
        while done < size:
            done += 1
            self._unknown_edge(chunk, done, best, into)
        found: list[Path] = []
        # among equal totals the one nearest to the text's start goes on, so a run of one
        # sign, which is all ties, yields a whole path before any other is followed
        queue: list[tuple] = [(0.0, size, 0, 0.0, None)]
        order = 0
        while queue and len(found) < n:
            _, at, _, behind, tail = heapq.heappop(queue)
            if at == 0:
                out: list[int] = []
                while tail is not None:
                    out += tail[0]
                    tail = tail[1]
                found.append((behind, tuple(out)))
                continue
            for i, s, piece in into[at]:
                order += 1
                total = round(best[size] - (best[i] + s + behind), TIE_DIGITS)
                heapq.heappush(queue, (total, i, order, s + behind, (piece, tail)))
        return found

    def best_two(self, chunk: str) -> tuple[float, tuple[int, ...], float]:
        """Score and ids of a best segmentation, and how far below the next one scores.

        The forward pass of ``nbest`` with the two best scores per position,
        which is all that is needed of the many chunks that stay as they are.
        """
        size, low = len(chunk), float("-inf")
        best, second = [low] * (size + 1), [low] * (size + 1)
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (size + 1)
        best[0] = 0.0
        done = 0
        # the step of an edge stands here as it is: a call for each costs more than the step
        for last, (length, s, piece) in self.automaton.iter(chunk):
            while done < last:
                done += 1
                self._unknown_step(chunk, done, best, second, back)
            end = last + 1
            start = end - length
            score, reached = best[start] + s, best[end]
            if score > reached:
                if reached > second[end]:
                    second[end] = reached
                best[end], back[end] = score, (start, piece)
            elif score > second[end]:
                second[end] = score
            score = second[start] + s
            if score > second[end]:
                second[end] = score
            if length == 1:
                done = end
        while done < size:
            done += 1
            self._unknown_step(chunk, done, best, second, back)
        parts, at = [], size
        while at:
            at, piece = back[at]
            parts.append(piece)
        ids: list[int] = []
        for piece in reversed(parts):
            ids += piece
        return best[size], tuple(ids), best[size] - second[size]

    def _unknown_step(self, chunk: str, end: int, best: list[float], second: list[float], back: list) -> None:
        """A character without a piece of its own, in ``best_two``."""
        if chunk[end - 1] not in self.ids:
            score = best[end - 1] + self.unknown
            if score > best[end]:
                second[end] = max(second[end], best[end])
                best[end], back[end] = score, (end - 1, self.fallback(chunk[end - 1]))
            elif score > second[end]:
                second[end] = score
            second[end] = max(second[end], second[end - 1] + self.unknown)

    def _unknown_edge(self, chunk: str, end: int, best: list[float], into: list[list]) -> None:
        if chunk[end - 1] not in self.ids:
            into[end].append((end - 1, self.unknown, self.fallback(chunk[end - 1])))
            best[end] = max(best[end], best[end - 1] + self.unknown)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a whole segmentation."""
        length = self.raw_length[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.raw_begin[ids] - (ends - length), length) + np.arange(total)
        return self.raw_flat[at].tobytes()[1:].decode()


def chunks_of(text: str) -> list[str]:
    """Independent chunks: space marks with what follows, and what a line feed opens."""
    if SPACE_MARK in text:
        text = text.replace(SPACE_MARK, _LITERAL_MARK)
    marks, out = 1, []
    for part in text.replace("\n", " \n").split(" "):
        if part and part[0] == "\n":
            # the space in front was put there only to split
            if marks > 1:
                out.append(SPACE_MARK * (marks - 1))
            out.append(part)
            marks = 1
        elif part:
            out.append(SPACE_MARK * marks + part)
            marks = 1
        else:
            marks += 1
    if marks > 1:
        out.append(SPACE_MARK * (marks - 1))
    return out


class NBestEncoder:
    """N-best encoding of texts with remembered chunks."""

    def __init__(self, path: str, n: int, max_chunks: int = 600_000, max_chars: int = 1 << 24):
        self.pieces, self.n = Pieces(path), n
        self.max_chunks, self.max_chars = max_chunks, max_chars
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.chars = 0
        self.names: list[str] = []
        self.ids: list[bytes] = []  # little-endian 32-bit ids of the best segmentation
        self.score = np.zeros(4096)
        self.gap = np.zeros(4096)
        self.more: dict[int, list[Path]] = {}

    def _learn(self, chunk: str) -> int:
        score, ids, gap = self.pieces.best_two(chunk)
        self.at[chunk] = k = len(self.names)
        self.chars += len(chunk)
        self.names.append(chunk)
        self.ids.append(_packed(ids))
        if k == len(self.score):
            self.score, self.gap = (np.concatenate([x, np.zeros(k)]) for x in (self.score, self.gap))
        self.score[k], self.gap[k] = score, gap
        return k

    def _alternatives(self, k: int) -> list[Path]:
        if k not in self.more:
            paths = self.pieces.nbest(self.names[k], self.n)
            # among equal scores the one in use stands first
            used = float(self.score[k]), tuple(struct.unpack(f"<{len(self.ids[k]) // 4}I", self.ids[k]))
            self.more[k] = [used, *(path for path in paths if path[1] != used[1])][: self.n]
        return self.more[k]

    def encode(self, text: str | None) -> list[tuple[float, np.ndarray]]:
        """The N best (score, ids) of a text, best first."""
        if not text:
            return [(0.0, np.zeros(0, "<u4"))]
        chunks = chunks_of(text)
        if len(self.at) > self.max_chunks or self.chars > self.max_chars:
            self.clear()
        get, learn = self.at.get, self._learn
        at = [learn(c) if (k := get(c)) is None else k for c in chunks]
        places = np.array(at)
        total, gaps = float(self.score[places].sum()), self.gap[places]
        few = min(self.n - 1, len(at))
        near = np.argpartition(gaps, few - 1)[:few] if few else np.zeros(0, int)
        # (loss, {place: alternative}) of the best combinations over the nearest chunks
        combos: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        for place in sorted(near[np.isfinite(gaps[near])].tolist()):
            paths = self._alternatives(at[place])
            grown = [
                (loss + paths[0][0] - s, chosen + (((place, a),) if a else ()))
                for loss, chosen in combos
                for a, (s, _) in enumerate(paths)
            ]
            combos = heapq.nsmallest(self.n, grown)
        parts = list(map(self.ids.__getitem__, at))
        out: list[tuple[float, np.ndarray]] = []
        for loss, chosen in combos:
            for place, a in chosen:
                parts[place] = _packed(self._alternatives(at[place])[a][1])
            out.append((total - loss, np.frombuffer(b"".join(parts), "<u4")))
            for place, _ in chosen:
                parts[place] = self.ids[at[place]]
        return out


def _packed(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[tuple[str, int], NBestEncoder] = {}


def _encoder(path: str, n: int) -> NBestEncoder:
    if (path, n) not in _ENCODERS:
        _ENCODERS[path, n] = NBestEncoder(path, n)
    return _ENCODERS[path, n]


OUT = "rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"


def _segment(batches: Iterator[pa.RecordBatch], path: str, n: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = _encoder(path, n)
    for batch in batches:
        for lo in range(0, batch.num_rows, 128):
            some = batch.slice(lo, 128)
            rows: dict[str, list] = {c: [] for c in ("at", "rank", "score", "n_pieces", "ids_crc32", "round_trip", "ids")}
            for at, text in enumerate(some.column(1).to_pylist()):
                for rank, (score, ids) in enumerate(enc.encode(text), 1):
                    rows["at"].append(at)
                    rows["rank"].append(rank)
                    rows["score"].append(score)
                    rows["n_pieces"].append(len(ids))
                    rows["ids_crc32"].append(zlib.crc32(ids))
                    rows["round_trip"].append(enc.pieces.decode(ids) == (text or ""))
                    if with_ids:
                        rows["ids"].append(ids)
            columns = [some.column(0).take(pa.array(rows.pop("at"), pa.int64()))]
            ids = rows.pop("ids")
            kinds = (pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_())
            columns += [pa.array(v, t) for v, t in zip(rows.values(), kinds)]
            names = ["id", *rows]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def encode_nbest(
    docs: DataFrame, model_path: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """(id, rank, score, n_pieces, ids_crc32, round_trip[, ids]): the ``n`` best segmentations of each text."""
    workers_find_package(docs.sparkSession)
    one = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = one.mapInArrow(partial(_segment, path=model_path, n=n, with_ids=with_ids), f"id long, {OUT}" + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of each row's ids; null ids give a null text."""
    workers_find_package(encoded.sparkSession)
    if text_col in encoded.columns:
        raise ValueError(f"the rows already have a column {text_col}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(model_path, 1).pieces
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([None if x is None else pieces.decode(np.array(x, np.int64)) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, `{text_col}` string")
