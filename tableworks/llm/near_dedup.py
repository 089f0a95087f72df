"""Near-duplicate documents by HyperMinHash.

A document is the set of its 5-word shingles, each a 64-bit hash.  One pass per
text puts every shingle into one of ``BUCKETS`` buckets and keeps, per bucket,
the smallest hash as a 16-bit register: the count of its leading zeros and the
first mantissa bits after them.  An empty bucket borrows the register of the
next full bucket in a fixed random order of its own.

1. Documents with equal sets become one class.
2. Registers are cut into bands; classes that share a band are candidates.  In
   each bucket of a band every class is paired with the smallest one, its center.
   The registers estimate the Jaccard similarity, less the chance that
   different minima share a register; pairs far below the threshold go.
3. What remains is confirmed on the full shingle sets, and links merge classes.
4. Where the members of a center still are in several components, a link between
   two of them may have been missed.  Each member is then described by its
   difference to the center (shingles that only one of both has).  Two members
   can only be linked if their differences share a certain number of shingles, so
   they share one among the rarest few of each (a prefix); an equi-join on those
   finds all such pairs without pairing members that merely resemble the center.
   They are estimated and confirmed like the others.
5. Components come from the links; the smallest id of each stays.

Similarity 100 * |A and B| >= T * |A or B| with T = ``threshold_percent``, 85 by
default.  A band has as many registers as keep the chance that a pair at the
threshold misses all bands within ``MAX_MISS``: 5 (25 bands) for 85, where it is
(1 - 0.85^5)^25 = 4e-7, and 4 (32 bands) for 80, where it is 5e-8.

Defined results: a null, empty or blank text has no shingle and is linked with
nothing; fewer than five words make one shingle; rows that repeat an id are one
document, linked with whatever any of its texts is linked with; a row without an
id is linked with nothing and kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableworks.llm.common import byte_words, slices, workers_find_package, written
from tableworks.llm.graph import components

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 85
LG_BUCKETS, MANTISSA_BITS = 7, 10
BUCKETS = 1 << LG_BUCKETS
MAX_MISS = 1e-6


def band_rows(threshold_percent: int = THRESHOLD_PERCENT) -> int:
    """Most registers a band may have for a pair at the threshold to be missed with ``MAX_MISS`` at most."""
    if not 0 < threshold_percent <= 100:
        raise ValueError("threshold_percent must be above 0 and at most 100")
    t = threshold_percent / 100
    return max([r for r in range(1, BUCKETS + 1) if (1 - t**r) ** (BUCKETS // r) <= MAX_MISS], default=1)


def estimate_floor(threshold_percent: int = THRESHOLD_PERCENT) -> float:
    """The threshold less about six standard errors of the estimate, in whole percent."""
    t = threshold_percent / 100
    return math.floor(100 * (t - 6 * math.sqrt(t * (1 - t) / BUCKETS))) / 100


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = byte_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 5)], np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(w) - SHINGLE_WORDS + 1
    h = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for i in range(SHINGLE_WORDS):
        h = _mix(h ^ w[i : n + i]) + np.uint64(i + 1)
    return np.unique(h)


_BORROW = np.argsort(np.random.default_rng(6).random((BUCKETS, BUCKETS)), axis=1)


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers: 6 bits of leading zeros, then the mantissa."""
    x = _mix(shingles + np.uint64(0xD1B54A32D192ED03))
    x.sort()  # by bucket, then by the rest
    bucket = (x >> np.uint64(64 - LG_BUCKETS)).astype(np.int64)
    rest = x << np.uint64(LG_BUCKETS)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    least = rest[first]
    # leading zeros by the exponent of the number's upper half, exact in double precision
    high, low = (least >> np.uint64(32)).astype(np.float64), (least & np.uint64(0xFFFFFFFF)).astype(np.float64)
    bits = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1])
    zeros = np.minimum(64 - bits, 62).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    value = ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    full = np.zeros(BUCKETS, bool)
    full[bucket[first]] = True
    out = np.zeros(BUCKETS, np.uint16)
    out[bucket[first]] = value
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _BORROW[empty]
        out[empty] = out[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return out


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` compressed registers."""
    bands = BUCKETS // rows
    r = regs[: bands * rows].reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        h = _mix(h ^ r[:, i]) + np.uint64(i)
    return h


def accidental_match(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Chance, per pair of set sizes, that two different bucket minima share a register.

    A minimum over n shingles in ``BUCKETS`` buckets falls into [x, x + dx) with
    density k e^(-kx), k = n / BUCKETS.  On the level of z leading zeros a cell
    is 2^-(z+1) / 2^MANTISSA_BITS wide; summing both densities over the cells of
    all levels gives the chance.
    """
    a, b = (np.maximum(np.asarray(n, float) / BUCKETS, 1e-9)[:, None] for n in (n_a, n_b))
    level = np.arange(62)
    low, high = 2.0 ** -(level + 1), 2.0**-level
    cells = low / (1 << MANTISSA_BITS) * (np.exp(-(a + b) * low) - np.exp(-(a + b) * high))
    return (a * b / (a + b))[:, 0] * cells.sum(axis=1)


def estimated_jaccard(ra: np.ndarray, rb: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of register rows, corrected for accidental matches."""
    chance = accidental_match(n_a, n_b)
    return ((ra == rb).mean(axis=1) - chance) / (1 - chance)


SIGNATURE = "id long, n_shingles long, set_key binary, regs binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n, key, regs = [], [], []
        for text in batch.column(1).to_pylist():
            s = shingle_set(text)
            n.append(len(s))
            key.append(xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) if len(s) else None)
            regs.append(registers(s).astype("<u2").tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(regs, pa.binary())],
            ["id", "n_shingles", "set_key", "regs"],
        )


def _bands(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        regs = batch.column("regs").to_pylist()
        keys = np.concatenate([band_keys(np.frombuffer(r, "<u2"), rows) for r in regs]).view(np.int64)
        at = pa.array(np.repeat(np.arange(len(regs)), BUCKETS // rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), batch.column("id").take(at)], ["band", "id"]
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some in slices(batches):
        sets = [shingle_set(t).view(np.int64) for t in some.column(1).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [some.column(0).cast(pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets)))], ["id", "shingles"]
        )


def _likely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose corrected estimate reaches the floor and whose sizes allow the threshold."""
    floor = estimate_floor(percent)
    for batch in slices(batches):
        na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
        ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, BUCKETS) for c in ("ra", "rb"))
        estimate = estimated_jaccard(ra, rb, na, nb)
        # few shingles fill few buckets, and borrowed registers say less
        room = np.sqrt(BUCKETS / np.minimum(BUCKETS, np.minimum(na, nb)))
        keep = (estimate >= 1 - (1 - floor) * room) & (np.minimum(na, nb) * 100 >= percent * np.maximum(na, nb))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate allows the threshold and whose full sets reach it."""
    with_regs = (
        pairs.join(classes.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("regs").alias("ra")), "a")
        .join(classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("regs").alias("rb")), "b")
        .select("a", "b", "na", "nb", "ra", "rb")
    )
    likely = with_regs.mapInArrow(partial(_likely, percent=percent), "a long, b long").distinct()
    both = likely.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.filter(common * 100 >= union * percent).select("a", "b").distinct()


def _unseen_pairs(stars: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) in different components that may be linked although neither is the center.

    With the sizes n and the size d of a member's difference to its center, two
    members x and y differ in d_x + d_y - 2 * overlap shingles, and they are
    linked only if that is at most ``r`` times the sum of their sizes,
    r = (100 - T) / (100 + T).  The overlap so has to reach
    (d_x + d_y - r * (n_x + n_y)) / 2.  Since n_y is at most n_c + d_y and
    n_x / (T / 100), and one of both isn't linked to the center, each member has
    a least overlap with any partner of its own (``least``); by the prefix
    principle both hold a common shingle among their first d - least + 1 in any
    one order.  Rare shingles first makes such meetings few.
    """
    r = (100 - percent) / (100 + percent)
    part = found.select(F.col("node").alias("id"), F.col("component").alias("part"))
    labelled = (
        stars.join(part, "id", "left")
        .join(part.select(F.col("id").alias("center"), F.col("part").alias("center_part")), "center", "left")
        .select("id", "center", F.coalesce("part", "id").alias("part"), F.coalesce("center_part", "center").alias("center_part"))
    )
    mixed = labelled.groupBy("center").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    mixed = mixed.filter("lo <> hi").select("center")
    members = (
        labelled.join(mixed, "center", "left_semi")
        .join(sets.select("id", F.col("shingles").alias("mine")), "id")
        .join(sets.select(F.col("id").alias("center"), F.col("shingles").alias("theirs")), "center")
        .select(
            "center", "id", "part", (F.col("part") == F.col("center_part")).alias("linked"),
            F.size("mine").alias("n"), F.size("theirs").alias("nc"),
            F.concat(F.array_except("mine", "theirs"), F.array_except("theirs", "mine")).alias("difference"),
        )
    )
    d, n, nc = F.size("difference"), F.col("n"), F.col("nc")
    at_center = d - r * (n + nc)
    apart = F.greatest(at_center / (1 + r), d - n * (100 / percent - 1))
    least = F.greatest(F.lit(1.0), F.ceil(F.when(F.col("linked"), d * (1 - r) / 2).otherwise(apart) - 1e-6))
    members = members.withColumn("d", d).withColumn("prefix", d - least + 1).filter("prefix > 0")
    one = members.select("center", "id", "part", "n", "d", "prefix", F.explode("difference").alias("shingle"))
    one = written(one, "differences")
    often = one.groupBy("center", "shingle").agg(F.count("*").alias("holders"))
    order = Window.partitionBy("center", "id").orderBy("holders", "shingle")
    ranked = one.join(often, ["center", "shingle"]).withColumn("place", F.row_number().over(order))
    keys = written(ranked.filter("place <= prefix AND holders > 1").drop("prefix", "holders"), "prefixes")
    x = keys.select("center", "shingle", *[F.col(c).alias(f"{c}_x") for c in ("id", "part", "n", "d", "place")])
    y = keys.select("center", "shingle", *[F.col(c).alias(f"{c}_y") for c in ("id", "part", "n", "d", "place")])
    most = 1 + F.least(F.col("d_x") - F.col("place_x"), F.col("d_y") - F.col("place_y"))
    needed = (F.col("d_x") + F.col("d_y") - r * (F.col("n_x") + F.col("n_y"))) / 2
    allowed = F.abs(F.col("d_x") - F.col("d_y")) <= r * (F.col("n_x") + F.col("n_y")) + 1e-6
    meet = (
        (x["center"] == y["center"]) & (x["shingle"] == y["shingle"]) & (F.col("id_x") < F.col("id_y"))
        & (F.col("part_x") != F.col("part_y")) & allowed & (most >= needed - 1e-6)
    )
    return x.join(y, meet).select(F.col("id_x").alias("a"), F.col("id_y").alias("b")).distinct()


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold_percent: int = THRESHOLD_PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``docs`` with an id."""
    rows = band_rows(threshold_percent)
    workers_find_package(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = written(plain.mapInArrow(_sign, SIGNATURE), "signatures")

    # one class per distinct set, named by its smallest id
    classes = signed.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs")
    )
    classes = written(classes.filter("id IS NOT NULL"), "classes")

    bands = written(classes.select("id", "regs").mapInArrow(partial(_bands, rows=rows), "band long, id long"), "bands")
    shared = bands.groupBy("band").agg(F.count("*").alias("members"), F.min("id").alias("center")).filter("members > 1")
    stars = bands.join(shared, "band").filter("id <> center").select("id", "center").distinct()
    stars = written(stars, "stars")
    starred = written(stars.select("id").union(stars.select("center")).distinct(), "starred")
    texts = plain.join(starred, "id", "left_semi")
    sets = written(texts.mapInArrow(_sets, "id long, shingles array<long>"), "shingle-sets")

    links = _confirmed(stars.select(*_pair("id", "center")), classes, sets, threshold_percent)
    links = written(links, "links")
    more = _confirmed(_unseen_pairs(stars, components(links), sets, threshold_percent), classes, sets, threshold_percent)

    # an id that repeats with another text links its classes
    member = signed.filter("set_key IS NOT NULL AND id IS NOT NULL").join(
        classes.select("set_key", F.col("id").alias("class_id")), "set_key"
    )
    member = member.select("id", "n_shingles", "class_id")
    repeated = member.groupBy("id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z")).filter("a <> z").select("id", "a")
    by_id = member.join(repeated, "id").filter("class_id <> a").select("a", F.col("class_id").alias("b"))
    found = components(links.unionByName(more).unionByName(by_id))

    member = member.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    member = member.select("id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"))
    alone = signed.filter("set_key IS NULL OR id IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"))
    return member.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold_percent: int = THRESHOLD_PERCENT
) -> DataFrame:
    """``docs`` with one document (the smallest id) of each group, all columns unchanged.

    Rows that share the id of the document that stays all stay, and so do rows
    without an id or without words.
    """
    gone = near_duplicates(docs, id_col, text_col, threshold_percent).filter(~F.col("kept")).select(F.col("id").alias("__gone"))
    gone = written(gone.distinct(), "duplicates")
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col("__gone"), "left_anti")
