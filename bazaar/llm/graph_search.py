"""Approximate nearest neighbours by cosine over robust-pruned directed graphs.

Equal vectors are one node, dealt to shards by hash.  Each shard builds a graph
in numpy: a greedy beam search proposes neighbours for a batch of new nodes,
relaxed pruning keeps an edge unless a kept one is much nearer to its end, and
edges are added both ways.  Nodes that no entry reaches become entries, so
every node can be found.  Queries go to every shard in blocks, a beam search
answers each, and the shards' answers are merged.

The number of shards grows with the square root of the rows, which balances
the length of a build task with the number of searches.  The index is a table
(one row per node with its vector and edges); a task holds one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import stored

#: Edges of a node, beam of the build and of a search, relaxation of the pruning.
DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 64, 160, 1.2
#: Nodes that a step of the search expands for each query.
EXPAND = 4
#: Rows of a shard: ROOT x the square root of all rows, as far as SHARD_BYTES holds the vectors.
ROOT, SHARD_BYTES = 32, 256 << 20

_NODE = "dim int, shard int, node int, ids array<long>, vec array<double>, edges array<int>, entry boolean"


# -------------------------------------------------------------------- numpy

def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow, in single precision."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double precision."""
    # powers of two change no digit
    a = np.ldexp(a, -np.frexp(np.abs(a).max(axis=-1, keepdims=True))[1])
    b = np.ldexp(b, -np.frexp(np.abs(b).max(axis=-1, keepdims=True))[1])
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


class Graph:
    """Directed graph over the rows of ``points``; edges are padded with -1."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE):
        self.points = points
        self.edges = np.full((len(points), degree), -1, np.int32)
        self.entries = np.zeros(0, np.int32)

    def _distances(self, queries: np.ndarray, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        gap = self.points[nodes]
        gap -= queries[rows]
        return np.einsum("ij,ij->i", gap, gap)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances), nearest first, padded with -1 and inf."""
        m, n = len(queries), len(self.points)
        nodes = np.full((m, beam), -1, np.int32)
        dist = np.full((m, beam), np.inf, np.float32)
        done = np.ones((m, beam), bool)
        seen = np.zeros(m * n, bool)
        new = np.tile(self.entries, m)
        rows = np.repeat(np.arange(m), len(self.entries))
        while len(new):
            seen[rows * n + new] = True
            nodes, dist, done = self._merge(nodes, dist, done, rows, new, self._distances(queries, rows, new))
            # the first open places of each beam
            first = np.cumsum(~done, axis=1)
            row, place = np.nonzero(~done & (first <= EXPAND))
            done[row, place] = True
            ends = self.edges[nodes[row, place]]
            key = (row[:, None] * n + ends)[ends >= 0]
            key = np.unique(key[~seen[key]])
            rows, new = key // n, (key % n).astype(np.int32)
        return nodes, dist

    @staticmethod
    def _merge(nodes, dist, done, rows, new, gap):
        m, beam = nodes.shape
        start = np.searchsorted(rows, np.arange(m))
        wide = int(np.bincount(rows, minlength=m).max())
        place = np.arange(len(rows)) - start[rows]
        more = np.full((m, wide), -1, np.int32)
        far = np.full((m, wide), np.inf, np.float32)
        more[rows, place], far[rows, place] = new, gap
        dist = np.concatenate([dist, far], axis=1)
        nodes = np.concatenate([nodes, more], axis=1)
        done = np.concatenate([done, more < 0], axis=1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        return tuple(np.take_along_axis(x, order, axis=1) for x in (nodes, dist, done))

    def prune(self, of: np.ndarray, nodes: np.ndarray, dist: np.ndarray, relax: float) -> np.ndarray:
        """Diverse neighbours of ``of`` among candidates sorted by distance.

        A candidate goes if ``relax`` times its distance to a kept one is at
        most its distance to the node itself.
        """
        degree = self.edges.shape[1]
        kept = np.full((len(of), degree), -1, np.int32)
        open_ = (nodes >= 0) & (nodes != of[:, None])
        v = self.points[np.maximum(nodes, 0)] - self.points[of][:, None]
        near = np.where(open_, np.einsum("ijk,ijk->ij", v, v), np.inf)
        between = near[:, :, None] + near[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        square, at = relax * relax, np.arange(len(of))
        for k in range(degree):
            pick = np.argmax(open_, axis=1)
            live = open_[at, pick]
            if not live.any():
                break
            kept[live, k] = nodes[at, pick][live]
            open_[at, pick] = False
            open_ &= ~((square * between[at, pick] <= near) & live[:, None])
        return kept

    def link(self, of: np.ndarray, kept: np.ndarray, relax: float) -> None:
        """Set the edges of ``of`` and add them the other way; full lists are pruned."""
        self.edges[of] = kept
        start, end = np.nonzero(kept >= 0)
        source, target = of[start], kept[start, end]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        ends, first, count = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(ends), 512):
            e, f, c = ends[a:a + 512], first[a:a + 512], count[a:a + 512]
            row = np.repeat(np.arange(len(e)), c)
            own = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
            more = np.full((len(e), c.max()), -1, np.int32)
            more[row, own] = source[np.repeat(f, c) + own]
            both = np.concatenate([self.edges[e], more], axis=1)
            # the same neighbour may be there already
            both.sort(axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            full = (both >= 0).sum(axis=1) > self.edges.shape[1]
            room = np.sort(both[~full], axis=1)[:, ::-1][:, :self.edges.shape[1]]
            self.edges[e[~full], :room.shape[1]] = room
            if full.any():
                some, of_some = both[full], e[full]
                gap = self.points[np.maximum(some, 0)] - self.points[of_some][:, None]
                dist = np.where(some >= 0, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
                by = np.argsort(dist, axis=1, kind="stable")
                self.edges[of_some] = self.prune(of_some, np.take_along_axis(some, by, 1),
                                                 np.take_along_axis(dist, by, 1), relax)

    def reach_all(self) -> None:
        """Make an entry of a node in every part that no entry reaches."""
        n = len(self.points)
        reached = np.zeros(n, bool)
        todo = self.entries
        more = [self.entries]
        rest = 0
        while True:
            while len(todo):
                reached[todo] = True
                ends = np.unique(self.edges[todo])
                ends = ends[ends >= 0]
                todo = ends[~reached[ends]]
            while rest < n and reached[rest]:
                rest += 1
            if rest == n:
                break
            todo = np.array([rest], np.int32)
            more.append(todo)
        self.entries = np.unique(np.concatenate(more))


def block_rows(n: int) -> int:
    """Queries that are searched together: fewer in a large shard."""
    return int(np.clip((1 << 25) // max(n, 1), 16, 256))


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> Graph:
    """Graph over unit vectors, which come in random order."""
    g = Graph(points, degree)
    n = len(points)
    g.entries = np.arange(min(n, max(1, int(np.sqrt(n)))), dtype=np.int32)
    built = min(n, 2 * degree)
    head = np.arange(built, dtype=np.int32)
    if built > 1:
        everyone = np.tile(head, (built, 1))
        gap = points[everyone] - points[head][:, None]
        dist = np.einsum("ijk,ijk->ij", gap, gap)
        by = np.argsort(dist, axis=1, kind="stable")
        g.edges[head] = g.prune(head, np.take_along_axis(everyone, by, 1), np.take_along_axis(dist, by, 1), relax)
    entries, g.entries = g.entries, g.entries[g.entries < built]
    while built < n:
        size = min(n - built, max(32, min(built // 4, block_rows(n))))
        new = np.arange(built, built + size, dtype=np.int32)
        g.link(new, g.prune(new, *g.search(points[new], beam), relax), relax)
        built += size
        g.entries = entries[entries < built]
    g.reach_all()
    return g


# -------------------------------------------------------------------- Spark

def usable(vec: Column) -> Column:
    """Vectors that take part: not null, not empty, finite everywhere, not all zero."""
    finite = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)


def _rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.col(vec_col).cast("array<double>")
    return (df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
            .where(F.col("id").isNotNull() & usable(F.col("vec"))).distinct()
            .withColumn("dim", F.size("vec")))


@dataclass
class Index:
    """``nodes``: one row per different vector (see _NODE); ``shards``: (dim, shards)."""

    nodes: DataFrame
    shards: DataFrame
    parts: int
    keep: int


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, bool], pa.RecordBatch]]:
    """Pieces of batches with one (dim, shard, is a query)."""
    for b in batches:
        keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                         for c in ("dim", "shard", "query")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if z > a:
                yield (int(keys[a, 0]), int(keys[a, 1]), bool(keys[a, 2])), b.slice(a, z - a)


def _matrix(piece: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return piece.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def build_index(df: DataFrame, id_col: str, vec_col: str, keep: int, degree: int = DEGREE,
                beam: int = BUILD_BEAM, relax: float = RELAX) -> Index:
    """Index of every usable vector of ``df``, for answers of up to ``keep`` neighbours.

    Rows without an id and vectors that are null, empty, zero or hold null or
    non-finite components take no part.  Rows that repeat id and vector count
    once.  Of equal vectors the ``keep + 1`` smallest ids are noted: no other
    can be among the ``keep`` nearest of any query, as ties go to the smaller
    id.  Vectors of different length have shards of their own.
    """
    spark = df.sparkSession
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    nodes = stored(_rows(df, id_col, vec_col).withColumn("rank", rank).where(F.col("rank") <= keep + 1)
                   .groupBy("dim", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    fit = F.greatest(F.lit(1), F.floor(F.lit(SHARD_BYTES) / (F.col("dim") * 12)))
    shards = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select(
        "dim", F.ceil(F.greatest(F.sqrt("n") / ROOT, F.col("n") / fit)).cast("int").alias("shards"))
    shards = stored(shards, "vector-shards")
    parts = shards.agg(F.sum("shards")).first()[0] or 1
    order = F.xxhash64("vec")
    dealt = (nodes.join(shards, "dim").withColumn("order", order)
             .withColumn("shard", F.pmod(F.xxhash64("order", F.lit(1)), F.col("shards")).cast("int"))
             .withColumn("query", F.lit(False)).drop("shards")
             .repartitionByRange(parts, "dim", "shard").sortWithinPartitions("dim", "shard", "order", "ids"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for key, piece in _groups(batches):
            if at is not None and key != at:
                yield from build(at, held)
                held = []
            at = key
            held.append(piece)
        if at is not None:
            yield from build(at, held)

    def build(key: tuple[int, int, bool], held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, shard, _ = key
        g = build_graph(unit_rows(np.concatenate([_matrix(p, "vec", dim) for p in held])), degree, beam, relax)
        entry = np.zeros(len(g.points), bool)
        entry[g.entries] = True
        start = 0
        for p in held:
            stop = start + p.num_rows
            edges = g.edges[start:stop]
            ends = np.concatenate([[0], np.cumsum((edges >= 0).sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(p.num_rows, dim, np.int32)), pa.array(np.full(p.num_rows, shard, np.int32)),
                 pa.array(np.arange(start, stop, dtype=np.int32)), p.column("ids"), p.column("vec"),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(edges[edges >= 0])), pa.array(entry[start:stop])],
                names=["dim", "shard", "node", "ids", "vec", "edges", "entry"])
            start = stop

    return Index(stored(dealt.mapInArrow(part, _NODE), "graph"), shards, parts, keep)


def search(index: Index, queries: DataFrame, id_col: str, vec_col: str, k: int,
           beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every usable query row.

    A query's own id is no candidate.  Nearest first, ties to the smaller id;
    scores are cosines of the original vectors in double precision.  Queries
    that repeat an id with another vector are answered one by one.  An empty
    index or no query gives no row.
    """
    if k > index.keep:
        raise ValueError(f"the index notes {index.keep} ids of equal vectors, {k} are asked for")
    none = F.lit(None)
    asked = (_rows(queries, id_col, vec_col).join(index.shards, "dim")
             .select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                     none.cast("int").alias("node"), F.array("id").alias("ids"), "vec",
                     none.cast("array<int>").alias("edges"), F.lit(False).alias("entry"), F.lit(True).alias("query")))
    # a shard's nodes come first, then the queries, which are answered block by block
    stream = (index.nodes.withColumn("query", F.lit(False)).unionByName(asked)
              .repartitionByRange(index.parts, "dim", "shard").sortWithinPartitions("dim", "shard", "query", "node"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, shard = None, [], None
        for (dim, number, is_query), piece in _groups(batches):
            if (dim, number) != at:
                at, held, shard = (dim, number), [], None
            if not is_query:
                held.append(piece)
            elif held or shard is not None:
                if shard is None:
                    shard, held = _Shard(held, dim), []
                yield from shard.answer(piece, dim, k, beam)

    found = stream.mapInArrow(part, "query_id long, asked long, vec_id long, score double")
    best = Window.partitionBy("query_id", "asked").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


class _Shard:
    """A shard's nodes, read back from the index table."""

    def __init__(self, held: list[pa.RecordBatch], dim: int):
        self.vectors = np.concatenate([_matrix(p, "vec", dim) for p in held])
        self.ids = [x for p in held for x in p.column("ids").to_pylist()]
        edges = [x for p in held for x in p.column("edges").to_pylist()]
        self.graph = Graph(unit_rows(self.vectors), max(1, max(map(len, edges))))
        for row, e in zip(self.graph.edges, edges, strict=True):
            row[:len(e)] = e
        self.graph.entries = np.flatnonzero(np.concatenate(
            [p.column("entry").to_numpy(zero_copy_only=False) for p in held])).astype(np.int32)

    def answer(self, piece: pa.RecordBatch, dim: int, k: int, beam: int) -> Iterator[pa.RecordBatch]:
        step = block_rows(len(self.vectors))
        for a in range(0, piece.num_rows, step):
            block = piece.slice(a, step)
            vectors = _matrix(block, "vec", dim)
            own = [x[0] for x in block.column("ids").to_pylist()]
            nodes, _ = self.graph.search(unit_rows(vectors), beam)
            rows: list[tuple[int, int, int, float]] = []
            for i, (q, near) in enumerate(zip(own, nodes, strict=True)):
                near = near[near >= 0]
                score = cosines(vectors[i][None], self.vectors[near]).tolist()
                named = sorted((-s, c) for s, node in zip(score, near.tolist(), strict=True)
                               for c in self.ids[node] if c != q)
                # the query's vector tells apart rows that repeat its id
                tag = int.from_bytes(hashlib.sha256(vectors[i].tobytes()).digest()[:8], "big", signed=True)
                rows += [(q, tag, c, -s) for s, c in named[:k]]
            if rows:
                q, tag, c, s = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(tag, pa.int64()),
                                                  pa.array(c, pa.int64()), pa.array(s, pa.float64())],
                                                 names=["query_id", "asked", "vec_id", "score"])


def neighbours(df: DataFrame, id_col: str, vec_col: str, every: int, k: int) -> DataFrame:
    """The ``k`` nearest rows of each row whose id is divisible by ``every``."""
    return search(build_index(df, id_col, vec_col, keep=k), df.where(F.col(id_col) % every == 0), id_col, vec_col, k)
