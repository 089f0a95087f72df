"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Distinct vectors are dealt to shards of bounded size and like norm.  In each shard a graph is
built by insertion: a greedy beam search over the graph so far proposes
neighbours, and relaxed pruning keeps an edge only if no kept neighbour is
closer to the proposal by the factor ``ALPHA``, so the edges that remain point
into different directions; a node that no walk from the start comes to gets one more
edge.  Queries run a beam search in every shard, and the shards' best are merged.
How wide the beam is, each shard measures: some of its queries are compared with
brute force, and the beam doubles until it finds ``RECALL`` of their nearest.  Where
vectors are so spread that a quarter of the shard wouldn't do, the shard is scanned.  Nearness is the inner product; vectors get one more
component that makes all norms equal, so the largest inner product is the
smallest distance (queries have 0 there).

Equal vectors are one node with the ``k + 1`` smallest of their ids, which is
all that a ranking with ties to the smaller id can show, so a vector that holds
a third of the rows is one node and one search.  Scores are inner products of
the original vectors in double precision.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and those whose length isn't the table's most frequent one, take no
part; a null id takes no part; rows that repeat an id with the same vector count
once, with another vector as another candidate of that id; with fewer than
``k`` candidates all are returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableworks.llm.common import workers_find_package, written

DEGREE, BEAM, ALPHA = 32, 64, 1.2
SEARCH_BEAM = 96
SHARD_ROWS, LEAST_SHARDS = 1 << 16, 12
QUERY_BLOCK = 1 << 15
_STEP = 256  # points searched or inserted at once
#: Share of the nearest that a shard's beam has to find, measured on so many queries against brute force.
RECALL, MEASURED = 0.95, 64


class VectorGraph:
    """Out-edges of one shard; ``-1`` pads a node's row."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None, start: int = 0):
        self.x, self.n = np.ascontiguousarray(x, np.float32), len(x)
        self.edges = np.full((self.n, DEGREE), -1, np.int32) if edges is None else edges
        self.start = start

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(similarities, nodes), best first, of the ``beam`` nodes each greedy search ends with.

        All queries step together: each expands its best node not yet expanded.
        """
        b = len(q)
        seen = np.zeros((b, self.n + 1), bool)
        sims = np.full((b, beam), -np.inf, np.float32)
        nodes = np.full((b, beam), -1, np.int32)
        done = np.ones((b, beam), bool)
        sims[:, 0], nodes[:, 0], done[:, 0] = q @ self.x[self.start], self.start, False
        seen[:, self.start] = True
        active = np.arange(b)
        while len(active):
            a = np.arange(len(active))
            first = np.argmin(done[active], axis=1)  # sorted by similarity: the first open one is the best
            done[active, first] = True
            near = self.edges[nodes[active, first]]
            fresh = (near >= 0) & ~seen[active[:, None], near]
            seen[active[:, None], np.where(fresh, near, self.n)] = True
            s = np.einsum("bd,brd->br", q[active], self.x[near], optimize=False)
            s = np.where(fresh, s, -np.inf)
            all_s = np.concatenate([sims[active], s], axis=1)
            best = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
            rows = a[:, None]
            sims[active] = all_s[rows, best]
            nodes[active] = np.concatenate([nodes[active], near], axis=1)[rows, best]
            done[active] = np.concatenate([done[active], ~fresh], axis=1)[rows, best] | np.isneginf(sims[active])
            active = active[~done[active].all(axis=1)]
        return sims, np.where(np.isneginf(sims), -1, nodes)

    def prune(self, points: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """At most ``DEGREE`` diverse neighbours per point out of ``cand`` (padded with -1)."""
        b, c = cand.shape
        cand = np.where(cand == points[:, None], -1, cand)
        v = self.x[cand]
        sim = np.where(cand >= 0, np.einsum("bd,bcd->bc", self.x[points], v), -np.inf)
        order = np.argsort(-sim, axis=1, kind="stable")
        cand, sim, v = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1), np.take_along_axis(v, order[:, :, None], 1)
        repeated = np.zeros((b, c), bool)
        by_id = np.argsort(cand, axis=1, kind="stable")
        ids = np.take_along_axis(cand, by_id, 1)
        np.put_along_axis(repeated, by_id[:, 1:], ids[:, 1:] == ids[:, :-1], 1)
        alive = (cand >= 0) & ~repeated
        square = float((self.x[0] ** 2).sum()) if self.n else 0.0  # all norms are equal
        to_point = np.where(alive, 2 * (square - sim), np.inf)
        out = np.full((b, DEGREE), -1, np.int32)
        rows = np.arange(b)
        for r in range(DEGREE):
            first = alive.argmax(axis=1)
            ok = alive[rows, first]
            if not ok.any():
                break
            out[ok, r] = cand[ok, first[ok]]
            between = 2 * (square - np.einsum("bd,bcd->bc", v[rows, first], v))
            covered = ALPHA * ALPHA * np.maximum(between, 0) <= to_point
            alive &= ~(covered & ok[:, None])
            alive[rows, first] = False
        return out

    def _link_back(self, points: np.ndarray) -> None:
        src = np.repeat(points, DEGREE)
        dst = self.edges[points].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        targets, first, many = np.unique(dst, return_index=True, return_counts=True)
        for lo in range(0, len(targets), _STEP):
            t, f, m = targets[lo : lo + _STEP], first[lo : lo + _STEP], many[lo : lo + _STEP]
            width = int(m.max())
            new = np.full((len(t), width), -1, np.int32)
            at = np.arange(width)[None, :]
            inside = at < m[:, None]
            new[inside] = src[(f[:, None] + at)[inside]]
            new[(new[:, :, None] == self.edges[t][:, None, :]).any(axis=2)] = -1  # linked already
            cand = np.concatenate([self.edges[t], new], axis=1)
            full = (cand >= 0).sum(axis=1) > DEGREE
            if (~full).any():  # room for all: kept to the left, padding to the right
                rows = cand[~full]
                put = np.take_along_axis(rows, np.argsort(rows < 0, axis=1, kind="stable"), 1)[:, :DEGREE]
                self.edges[t[~full]] = put
            if full.any():
                self.edges[t[full]] = self.prune(t[full], cand[full])

    def build(self) -> VectorGraph:
        if self.n < 2:
            return self
        order = np.random.default_rng(4).permutation(self.n)
        self.start = int(np.argmax(self.x @ self.x.mean(axis=0)))
        order = np.concatenate([[self.start], order[order != self.start]])
        done = min(_STEP, self.n)
        head = order[:done].astype(np.int32)  # the first points see each other
        self.edges[head] = self.prune(head, np.tile(head, (done, 1)))
        self._link_back(head)
        while done < self.n:
            batch = order[done : done + min(done, _STEP)].astype(np.int32)
            _, found = self.search(self.x[batch], BEAM)
            self.edges[batch] = self.prune(batch, found)
            self._link_back(batch)
            done += len(batch)
        self._reach_all()
        return self

    def reachable(self) -> np.ndarray:
        """Which nodes a walk along the edges from the start comes to."""
        known = np.zeros(self.n, bool)
        edge = np.array([self.start])
        while len(edge):
            known[edge] = True
            near = np.unique(self.edges[edge])
            near = near[near >= 0]
            edge = near[~known[near]]
        return known

    def _reach_all(self) -> None:
        """Give every node a way from the start: a node without one gets an edge from its nearest that has one.

        Back-links that pruning dropped can leave nodes without a way in.  The
        new edges are beside the ``DEGREE`` others; nothing else is dropped.
        """
        while len(lost := np.flatnonzero(~self.reachable())):
            lost = lost[:_STEP]
            _, found = self.search(self.x[lost], BEAM)  # a search comes to reachable nodes only
            order = np.argsort(found[:, 0], kind="stable")
            nearest, node = found[order, 0], lost[order]
            _, first, many = np.unique(nearest, return_index=True, return_counts=True)
            column = np.arange(len(node)) - np.repeat(first, many)
            free = (self.edges[nearest] >= 0).sum(axis=1) + column
            short = int(free.max()) + 1 - self.edges.shape[1]
            if short > 0:
                self.edges = np.concatenate([self.edges, np.full((self.n, short), -1, np.int32)], axis=1)
            self.edges[nearest, free] = node

    def beam_for(self, q: np.ndarray, k: int, share: float = RECALL) -> int | None:
        """The narrowest beam, doubled from ``SEARCH_BEAM``, that finds ``share`` of some queries' ``k`` nearest.

        Measured against brute force on at most ``MEASURED`` of the queries,
        spread over them.  ``None`` if even a beam of a quarter of the nodes
        doesn't, so that looking at every node costs no more.
        """
        some = q[np.linspace(0, len(q) - 1, min(len(q), MEASURED)).astype(int)]
        k = min(k, self.n)
        exact = some @ self.x.T
        least = -np.partition(-exact, k - 1, axis=1)[:, k - 1]
        beam = SEARCH_BEAM
        while beam < self.n:
            if beam > max(SEARCH_BEAM, self.n // 4):
                return None
            sims, at = self.search(some, beam)
            hit = (sims >= least[:, None] - 1e-5 * np.abs(least[:, None])) & (at >= 0)
            if np.minimum(hit.sum(axis=1), k).sum() >= share * k * len(some):
                return beam
            beam *= 2
        return self.n

    def scan(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Like ``search``, over every node."""
        sims = q @ self.x.T
        best = np.argpartition(-sims, min(beam, self.n) - 1, axis=1)[:, :beam]
        return np.take_along_axis(sims, best, 1), best


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 0), np.float32)


def _equal_norms(x: np.ndarray, largest: float | None = None) -> np.ndarray:
    """One more component, so that all rows have the norm ``largest`` (the longest row's)."""
    x = x.astype(np.float64)
    square = (x * x).sum(axis=1)
    extra = np.sqrt(np.maximum((square.max(initial=0.0) if largest is None else largest * largest) - square, 0))
    return np.concatenate([x, extra[:, None]], axis=1).astype(np.float32)


def participating(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec array<float>) of the rows that take part."""
    v = F.col(f"`{vector_col}`")
    rows = vectors.filter(v.isNotNull() & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vec"))
    rows = rows.filter(F.coalesce(F.forall("vec", lambda x: x.isNotNull()), F.lit(False))).filter(
        F.forall("vec", lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    )
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (size["n"] if size else 0)).dropDuplicates(["id", "vec"])


def _shard(nodes: DataFrame, shards: int) -> Column:
    """Shards as bands of like norm, cut at quantiles; nodes of one norm are dealt by hash.

    Where norms differ, the component that makes them equal would stand for most of
    a distance: long vectors, which answer most queries, would have few edges to
    them.  Within a band it is small.
    """
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    key = F.log(square) + F.xxhash64("node") / F.lit(2.0**63 * 1e5)
    cuts = nodes.agg(F.percentile_approx(key, [i / shards for i in range(1, shards)] or [1.0], max(10_000, 20 * shards))).first()[0]
    edges = F.array(*[F.lit(c) for c in cuts or [0.0]])
    return F.size(F.filter(edges, lambda c: c < key)).cast("int") if shards > 1 else F.lit(0)


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of every query row."""
    workers_find_package(vectors.sparkSession)
    rows = written(participating(vectors, id_col, vector_col), "vectors")
    # the k + 1 smallest ids of each distinct vector; the rank filter works before the shuffle too
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    nodes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("members"))
    nodes = written(nodes.select(F.col("members")[0].alias("node"), "vec", "members"), "nodes")

    asked = vectors.filter(is_query).select(F.col(f"`{id_col}`").cast("long").alias("query_id")).distinct()
    asked = asked.join(rows, asked.query_id == rows.id).select("query_id", "vec").join(nodes.select("vec", F.col("node").alias("q")), "vec")
    asked = written(asked.select("query_id", "q"), "queries")
    queries = nodes.join(asked.select(F.col("q").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("q"), F.col("vec").alias("qvec"))
    queries = written(queries, "query-vectors")

    n = nodes.count()
    shards = max(LEAST_SHARDS, -(-n // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        x = _equal_norms(_matrix(table.column("vec")))
        graph = VectorGraph(x).build()
        edges = pa.FixedSizeListArray.from_arrays(pa.array(graph.edges.ravel()), graph.edges.shape[1]).cast(pa.list_(pa.int32()))
        return pa.table(
            {"shard": table.column("shard"), "at": pa.array(np.arange(graph.n, dtype=np.int32)), "start": pa.array(np.full(graph.n, graph.start, np.int32)),
             "node": table.column("node"), "vec": table.column("vec"), "edges": edges}
        )

    index = nodes.select(_shard(nodes, shards).alias("shard"), "node", "vec")
    index = written(index.groupBy("shard").applyInArrow(build, "shard int, at int, start int, node long, vec array<float>, edges array<int>"), "vector-graph")

    def search(found: pa.Table, ask: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"q": [], "node": [], "score": []}
        if found.num_rows and ask.num_rows:
            found = found.sort_by("at")
            x = _matrix(found.column("vec"))
            graph = VectorGraph(_equal_norms(x), _matrix(found.column("edges")), int(found.column("start")[0].as_py()))
            ids, asking = (t.column(c).to_numpy() for t, c in ((found, "node"), (ask, "q")))
            q = _matrix(ask.column("qvec"))
            q_flat = np.concatenate([q, np.zeros((len(q), 1), q.dtype)], axis=1).astype(np.float32)
            beam = graph.beam_for(q_flat, k + 1)
            look = graph.scan if beam is None else graph.search
            width = min(2 * (k + 1), graph.n) if beam is None else beam
            for lo in range(0, len(q), _STEP):
                part = q[lo : lo + _STEP]
                _, at = look(q_flat[lo : lo + _STEP], width)
                score = np.einsum("bd,bcd->bc", part.astype(np.float64), x[at].astype(np.float64))
                score = np.where(at >= 0, score, -np.inf)
                node = np.where(at >= 0, ids[at], np.iinfo(np.int64).max)
                best = np.lexsort((node, -score), axis=1)[:, : k + 1]
                score, node = np.take_along_axis(score, best, 1), np.take_along_axis(node, best, 1)
                real = np.isfinite(score)
                out["q"].append(np.repeat(asking[lo : lo + _STEP], real.sum(axis=1)))
                out["node"].append(node[real])
                out["score"].append(score[real])
        kinds = (("q", np.int64), ("node", np.int64), ("score", np.float64))
        return pa.table({c: pa.array(np.concatenate([np.zeros(0, t), *out[c]]).astype(t)) for c, t in kinds})

    ask = queries.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))
    ask = ask.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    graph_rows = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    hits = graph_rows.groupBy("shard", "block").cogroup(ask.groupBy("shard", "block")).applyInArrow(search, "q long, node long, score double")
    hits = written(hits, "hits")

    best = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    top = hits.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    each = top.join(nodes.select("node", "members"), "node").select("q", "score", F.explode("members").alias("id"))
    order = F.struct((-F.col("score")).alias("by"), "id", "score")
    lists = each.groupBy("q").agg(F.sort_array(F.collect_list(order)).alias("near"))  # at most (k + 1)^2
    lists = lists.select("q", F.slice("near", 1, k + 1).alias("near"))
    mine = F.slice(F.filter("near", lambda c: c["id"] != F.col("query_id")), 1, k)
    return asked.join(lists, "q").select("query_id", F.posexplode(mine).alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score")
    )
