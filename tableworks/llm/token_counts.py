"""Token counts with a shortcut for words that are one token.

Many vocabulary strings stand for a whole word: the tokenizer gives such a word
back as one token.  ``alone_words`` proves offline, once on the driver and by
running every vocabulary string through the tokenizer, which ones do; the set is
no larger than the vocabulary and is broadcast.  In a text, white space ends
every pre-token, so the count of a text is the sum over its chunks between white
space.  A chunk of the proven set counts 1.  Any other chunk is cut into
pre-tokens; those of the proven set count 1 as well, and only the rest go through
the merges.  Counts of such chunks are remembered up to a bound.

Spark deals out the texts in Arrow batches; nothing is shuffled or collected.

Defined results: a null or empty text, and one of white space only, has 0 tokens
(``n_bytes`` counts the white space); a null id stays null; equal rows come out
equal; an empty table gives no rows; other columns are ignored.  A very long text
is counted whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tableworks.llm.common import workers_find_package

WORD_END = "</w>"
MAX_TOKENS = 2048
MAX_REMEMBERED = 400_000

#: What ``str.split`` takes for white space and the tokenizers do not.
_SEPARATOR_SIGNS = re.compile("[\x1c-\x1f]")
_TOKENIZER_SPACE = re.compile(r"[^\S\x1c-\x1f]+")


def load_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def alone_words(path: str) -> frozenset[str]:
    """Words that the tokenizer encodes as exactly their own vocabulary entry.

    A vocabulary string is written in the printable characters of the byte level
    with the word end after it.  Its word is proven if the whole tokenizer, from
    normalization to the last merge, gives that one id.
    """
    tokenizer = load_tokenizer(path)
    byte_of = {c: b for b, c in enumerate(_BYTE_LEVEL)}
    found: dict[str, int] = {}
    for entry, i in tokenizer.get_vocab(with_added_tokens=False).items():
        body = entry.removesuffix(WORD_END)
        if body == entry or any(c not in byte_of for c in body):
            continue
        try:
            word = bytes(byte_of[c] for c in body).decode()
        except UnicodeDecodeError:  # part of a character: no text gives it alone
            continue
        if word and chunks_of(word) == [word]:
            found[word] = i
    words = list(found)
    encoded = tokenizer.encode_batch(words, add_special_tokens=False)
    return frozenset(w for w, e in zip(words, encoded) if e.ids == [found[w]])


def _printable() -> list[str]:
    """The character that the byte level writes for each byte."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in same else chr(next(spare)) for b in range(256)]


_BYTE_LEVEL = _printable()


def written(word: str) -> str:
    """A word in the characters of the byte level."""
    if word.isascii() and word.isprintable():
        return word
    return "".join(map(_BYTE_LEVEL.__getitem__, word.encode("utf-8", "surrogatepass")))


def _latin_pieces() -> str:
    """The tokenizer's pre-token pattern on characters up to U+017F.

    These are in composed form already, and their lower case is what Unicode's
    simple rules give; general categories there are fixed.
    """
    latin = [chr(i) for i in range(0x180)]
    letters = re.escape("".join(c for c in latin if unicodedata.category(c)[0] == "L"))
    numbers = re.escape("".join(c for c in latin if unicodedata.category(c)[0] == "N"))
    return rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}]+"


_LATIN_PIECES = re.compile(_latin_pieces())
_BEYOND_LATIN = re.compile("[^\x00-\u017f]")


def chunks_of(text: str) -> list[str]:
    """What stands between white space, as the tokenizer knows it."""
    if _SEPARATOR_SIGNS.search(text):
        return [c for c in _TOKENIZER_SPACE.split(text) if c]
    return text.split()


class PieceCounts(dict):
    """Tokens of a pre-token in the byte level's characters: 1 if proven, else by merges."""

    def __init__(self, tokenizer: Tokenizer, alone: Iterable[str]):
        self.model = tokenizer.model
        self.proven = dict.fromkeys(map(written, alone), 1)
        super().__init__(self.proven)

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.proven) + MAX_REMEMBERED:
            self.clear()
            self.update(self.proven)
        n = self[piece] = len(self.model.tokenize(piece))
        return n


class ChunkCounts(dict):
    """Tokens of a chunk between white space: 1 for proven words, else by its pre-tokens.

    Chunks of Latin letters are cut by a pattern equal to the tokenizer's there,
    others by the tokenizer's own normalizer and pre-tokenizer.
    """

    def __init__(self, path: str, alone: frozenset[str]):
        self.proven = dict.fromkeys(alone, 1)
        super().__init__(self.proven)
        tokenizer = load_tokenizer(path)
        self.pieces = PieceCounts(tokenizer, alone)
        self.normalize, self.cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def __missing__(self, chunk: str) -> int:
        if len(self) >= len(self.proven) + MAX_REMEMBERED:
            self.clear()
            self.update(self.proven)
        if "<" in chunk:
            parts = self.special.split(chunk)
            n = len(parts) - 1 + sum(map(self._plain, parts))
        else:
            n = self._plain(chunk)
        self[chunk] = n
        return n

    def _plain(self, part: str) -> int:
        """Tokens of a part without white space and special strings."""
        if part.isascii() or not _BEYOND_LATIN.search(part):
            return sum(map(self.pieces.__getitem__, map(written, _LATIN_PIECES.findall(part.lower()))))
        return sum(self.pieces[p] for p, _ in self.cut(self.normalize(part)))

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, chunks_of(text)))


_COUNTERS: dict[str, ChunkCounts] = {}


def _counted(batches: Iterator[pa.RecordBatch], path: str, alone: Broadcast, limit: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if path not in _COUNTERS:
        _COUNTERS[path] = ChunkCounts(path, alone.value)
    counter = _COUNTERS[path]
    for batch in batches:
        n_bytes, n_tokens = [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
            n_tokens.append(counter.count(text))
        columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Per row the id, the text's UTF-8 bytes, its tokens, and whether they exceed ``max_tokens``.

    For word-level BPE files of ``tokenizers`` whose pre-tokens end at white
    space.  No begin, end or added tokens count; special strings inside a text
    are one token each, as the library takes them by default.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    alone = spark.sparkContext.broadcast(alone_words(tokenizer_path))
    one = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__text"))
    out = T.StructType([one.schema[id_col], *T.StructType.fromDDL("n_bytes long, n_tokens long, over_limit boolean").fields])
    run = partial(_counted, path=tokenizer_path, alone=alone, limit=max_tokens, schema=to_arrow_schema(out))
    return one.mapInArrow(run, out)
