"""Exact k-nearest-neighbour classification (O80) by a pivot tree and
best-first rounds; vectors travel in blocks and are never copied for a pair.

The tree has about sqrt(n) leaves (``MAX_LEAVES`` at most, so its pivots
travel with the tasks): the pivots are references of smallest md5 keys, the
first sqrt of them form the upper level, the others hang under the nearest of
these, and a reference goes down to the nearest upper pivot and then to the
nearest pivot under it.  Every leaf knows its size and the ring [rmin, rmax] of
its members' distances to its pivot, so no member is closer to a query at
distance d of the pivot than max(d - rmax, rmin - d, 0).

A query opens leaves in the order of that bound.  The first round opens
leaves until ``FIRST`` members are covered; each following one opens
``GROWTH`` times as many, but only leaves whose bound doesn't exceed the
k-th distance that the rounds before have found, and a query without such a
leaf is finished.  So every round tightens the bound before more leaves are
opened, and what is evaluated falls as a share of all pairs as n grows
(where the data have any structure that distances show; otherwise all
leaves are opened, which is exact as well).

References are packed once, in the order of their leaves, into tiles of at
most ``chunk`` rows, queries likewise into blocks of at most ``qblock`` (unless
given, ``PACK_BYTES`` of vectors).  A round pairs the tiles with the blocks that
open one of their leaves.  The pairs are read from the packed rows (a Cartesian
product of partitions with a condition) and go straight into a task that holds
one block and keeps its k nearest while tiles stream by.  So what is written is
the references once, the queries and their k nearest once a round, and at most
k rows for each query and each of ``MAX_PARTS`` parts of the tiles: in
proportion to the input, however many pairs there are.  A task's memory is a
block, a tile and one matrix of their rough distances; the exact distance is
computed for the few pairs that can count.  The label is voted (most frequent;
ties -> smallest label; equal distances -> smaller reference id first).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.functions.exprs import md5_long
from trialfold.session import cut_lineage

PARTIAL = "qid long, rid long, label int, dist double"
MAX_LEAVES = 16_384
FIRST, GROWTH = 2048, 16
#: A hair of slack keeps rounding in the bounds from pruning a tie.
SLACK = 1e-9
#: Parts of the tiles at most, and pairs that one task should meet.
MAX_PARTS, TASK_PAIRS = 16, 5e8
#: Entries of a matrix of distances that a task holds at once.
CELLS = 1 << 19
#: Bytes of the vectors in a block or tile, and its rows at most.
PACK_BYTES, PACK_ROWS = 2 << 20, 8192
#: The first row of a partition of tiles, with which the blocks come.
HEAD = -1

#: What isn't there (an id, a label) is told by its flag.
NO_ID, NO_LABEL = 1, 2
MEMBER = np.dtype([("rid", "<i8"), ("label", "<i4"), ("flags", "u1"), ("leaf", "<i4")])
FOUND = np.dtype([("q", "<i4"), ("rid", "<i8"), ("label", "<i4"), ("flags", "u1"), ("dist", "<f8")])
#: A query opens the leaves whose (bound, distance of the pivot) is beyond ``lo``, but not beyond ``hi``.
QUERY = np.dtype([("qid", "<i8"), ("flags", "u1"), ("lo", "<f8", 2), ("hi", "<f8", 2)])
PLACED = "leaf int, id long, label int, vec binary"
TILE = "tile long, leaves array<int>, counts array<long>, lows array<double>, highs array<double>, members binary, vecs binary"
BLOCK = "slot int, seq int, leaves array<int>, queries binary, vecs binary, best binary"


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length arrays (left fold)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all of ``b``, summed left to right over
    the dimensions: the same rounding as a fold."""
    if len(a) > len(b):  # long inner loops
        return distances(b, a).T
    out, diff = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))
    for x, y in zip(a.T.copy(), b.T.copy(), strict=True):
        np.subtract(x[:, None], y, out=diff)
        np.multiply(diff, diff, out=diff)
        out += diff
    return np.sqrt(out)


def row_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same of each row of ``a`` to the row of ``b`` at its place."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        diff = a[:, j] - b[:, j]
        out += diff * diff
    return np.sqrt(out)


class Side:
    """Vectors, their squared lengths, and the factors of the matrix products
    that give squared distances less the query's squared length."""

    def __init__(self, x: np.ndarray, queries: bool):
        self.x, self.queries = x, queries
        self.squares = np.einsum("ij,ij->i", x, x)
        self.most = self.squares.max(initial=0.0)
        self._factors: dict = {}

    def factor(self, kind: type) -> np.ndarray:
        if kind not in self._factors:
            with np.errstate(over="ignore", invalid="ignore"):
                last = np.ones(len(self.x)) if self.queries else self.squares
                self._factors[kind] = np.column_stack((self.x if self.queries else -2.0 * self.x, last)).astype(kind)
        return self._factors[kind]


def _sifted(a: Side, b: Side, rows: np.ndarray, start: int, end: int, most: np.ndarray, k: int, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``rows``, row of b) of the pairs of ``rows`` and ``start`` to ``end`` that
    a matrix product in numbers of this kind can't rule out, and the places of
    the rows for which single numbers leave more than a few."""
    rough = a.factor(kind)[rows] @ b.factor(kind)[start:end].T
    aa, k = a.squares[rows], min(k, end - start)
    # |error| <= about (dims + 3) eps (|a| + |b|)^2 <= 2 (dims + 3) eps (aa + bb)
    slack = 8 * (a.x.shape[1] + 4) * np.finfo(kind).eps * (aa + b.most)
    with np.errstate(over="ignore", invalid="ignore"):
        limit = np.nextafter((most * most * (1 + SLACK) + slack - aa).astype(kind), kind(np.inf))
    hit = np.flatnonzero(~(rough.min(axis=1) > limit))  # what isn't a number is tested exactly
    rough = rough[hit]
    near = ~(rough > limit[hit][:, None])
    many = np.flatnonzero(np.count_nonzero(near, axis=1) > 4 * k)
    if len(many):
        kth = np.partition(rough[many], k - 1, axis=1)[:, k - 1]
        near[many] &= ~(rough[many] > np.nextafter((kth + 2 * slack[hit[many]]).astype(kind), kind(np.inf))[:, None])
        many = many[np.count_nonzero(near[many], axis=1) > 4 * k] if kind is np.float32 else many[:0]
        near[many] = False
    flat = np.flatnonzero(near)
    return hit[flat // (end - start)], start + flat % (end - start), hit[many]


def pairs_near(a: Side, b: Side, rows: np.ndarray, start: int, end: int, most: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of a, row of b, distance), a part of the matrix at a time, of the pairs of
    ``rows`` and ``start`` to ``end`` that can be among the k nearest of a row and
    within its ``most``, by (distance) ties included.  Matrix products rule out
    what they can, in single numbers first, in double ones where those are too coarse."""
    step = max(1, CELLS // max(end - start, 1))
    sane = (a.squares[rows] < 1e20) & (1e-20 < b.most < 1e20)
    again = [np.flatnonzero(~sane)]
    for kind, todo in ((np.float32, np.flatnonzero(sane)), (np.float64, None)):
        todo = np.concatenate(again) if todo is None else todo
        for at in range(0, len(todo), step):
            some = todo[at:at + step]
            qi, ri, coarse = _sifted(a, b, rows[some], start, end, most[some], k, kind)
            qi = rows[some[qi]]
            again.append(some[coarse])
            for i in range(0, len(qi), CELLS // 8):
                q, r = qi[i:i + CELLS // 8], ri[i:i + CELLS // 8]
                yield q, r, row_distances(a.x[q], b.x[r])


def nearest_pairs(a: np.ndarray, b: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pairs_near`` of all rows of both."""
    found = list(pairs_near(Side(a, True), Side(b, False), np.arange(len(a)), 0, len(b), most, k))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return tuple(np.concatenate(x) for x in zip(none, *found, strict=True))


def _first(found: np.ndarray, k: int) -> np.ndarray:
    """The k first of each query by distance and id (no id comes last)."""
    found = found[np.lexsort((found["rid"], found["flags"] & NO_ID, found["dist"], found["q"]))]
    return found[_rank(found["q"]) < k]


def _rank(q: np.ndarray) -> np.ndarray:
    """The place of each row among the equal ones beside it."""
    new = np.flatnonzero(np.diff(q, prepend=q[:1] - 1))
    return np.arange(len(q)) - np.repeat(new, np.diff(new, append=len(q)))


def _far(n: int, k: int, best: np.ndarray) -> np.ndarray:
    """The k smallest distances of each of n queries; rows of ``best`` by query and distance."""
    out = np.full((n, k), np.inf)
    out[best["q"], _rank(best["q"])] = best["dist"]
    return out


class PivotTree:
    """Upper pivots, the leaves' pivots in the order of their parents, and later
    the leaves' sizes and rings."""

    def __init__(self, pivots: np.ndarray):
        self.upper = pivots[:int(np.ceil(np.sqrt(len(pivots))))]
        parent = self._nearest(distances(pivots, self.upper))
        parent[:len(self.upper)] = np.arange(len(self.upper))  # equal pivots keep their places
        order = np.argsort(parent, kind="stable")
        self.pivots = pivots[order]
        self.begins = np.searchsorted(parent[order], np.arange(len(self.upper) + 1))
        self.count = self.low = self.high = np.zeros(0)

    @staticmethod
    def _nearest(d: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(d), np.inf, d).argmin(axis=1)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        top = self._nearest(distances(x, self.upper))
        leaf = np.zeros(len(x), np.int64)
        for u in np.unique(top):
            mine = np.flatnonzero(top == u)
            leaf[mine] = self.begins[u] + self._nearest(distances(x[mine], self.pivots[self.begins[u]:self.begins[u + 1]]))
        return leaf

    def measured(self, rows: list) -> None:
        """Sizes and rings from (leaf, n, low, high) rows."""
        n = len(self.pivots)
        self.count, self.low, self.high = np.zeros(n, np.int64), np.full(n, np.inf), np.full(n, -np.inf)
        for r in rows:
            self.count[r["leaf"]], self.low[r["leaf"]], self.high[r["leaf"]] = r["n"], r["low"], r["high"]

    def bounds(self, x: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bound, distance of the pivot) of each row and leaf: the same bits
        whatever rows and leaves are asked for together."""
        d = distances(x, self.pivots[leaves])
        d = np.where(np.isnan(d), 0.0, d)
        with np.errstate(invalid="ignore"):
            return np.fmax(np.fmax(d - self.high[leaves], self.low[leaves] - d), 0.0), d

    @staticmethod
    def opens(bound: np.ndarray, d: np.ndarray, queries: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Which leaves each query opens: beyond its ``lo``, up to its ``hi``, and none
        whose bound is beyond the limit."""
        lo, hi = queries["lo"][:, :, None], queries["hi"][:, :, None]
        return (((bound > lo[:, 0]) | (bound == lo[:, 0]) & (d > lo[:, 1])) & ((bound < hi[:, 0]) | (bound == hi[:, 0]) & (d <= hi[:, 1]))
                & (bound <= (limit + SLACK * (1 + limit))[:, None]))

    def advanced(self, x: np.ndarray, queries: np.ndarray, limit: np.ndarray, target: float) -> tuple[np.ndarray, np.ndarray]:
        """(queries, leaves that any of them opens) of the next round: each goes on
        where it stopped, to the last leaf that begins before ``target`` covered members."""
        queries, every = queries.copy(), np.arange(len(self.pivots))
        queries["lo"], used = queries["hi"], np.zeros(len(every), bool)
        step = max(1, CELLS // len(every))
        for at in range(0, len(x), step):
            some = slice(at, at + step)
            bound, d = self.bounds(x[some], every)
            if np.isinf(target):
                queries["hi"][some] = np.inf
            else:
                order = np.lexsort((d, bound), axis=1)
                covered = np.cumsum(self.count[order], axis=1) - self.count[order]
                final = np.count_nonzero(covered < target, axis=1) - 1
                final = order[np.arange(len(order)), final]
                queries["hi"][some] = np.column_stack((bound[np.arange(len(order)), final], d[np.arange(len(order)), final]))
            used |= self.opens(bound, d, queries[some], limit[some]).any(axis=0)
        return queries, np.flatnonzero(used & (self.count > 0)).astype(np.int32)


class Search:
    """One block's queries and what a task has found for them so far."""

    def __init__(self, tree: PivotTree, k: int, x: np.ndarray, queries: np.ndarray, best: np.ndarray):
        self.tree, self.k, self.side, self.queries = tree, k, Side(x, True), queries
        self.far = _far(len(x), k, best)
        self.found: list[np.ndarray] = []
        self.held = 0

    def meet(self, members: np.ndarray, side: Side) -> None:
        """Evaluates the tile's leaves that are open to each query."""
        leaves, starts = np.unique(members["leaf"], return_index=True)
        ends = np.append(starts[1:], len(members))
        step = max(1, CELLS // len(leaves))
        for at in range(0, len(self.queries), step):
            some = slice(at, at + step)
            bound, d = self.tree.bounds(self.side.x[some], leaves)
            limit = self.far[some, -1]
            if self.tree.opens(bound, d, self.queries[some], limit).all():
                for start in range(0, len(members), 1024):
                    self._evaluate(members, side, np.arange(at, at + len(bound)), start, min(start + 1024, len(members)))
                continue
            for i in np.argsort(bound.min(axis=0), kind="stable"):
                one = slice(i, i + 1)
                rows = np.flatnonzero(self.tree.opens(bound[:, one], d[:, one], self.queries[some], self.far[some, -1])[:, 0])
                if len(rows):
                    self._evaluate(members, side, at + rows, starts[i], ends[i])

    def _evaluate(self, members: np.ndarray, side: Side, rows: np.ndarray, start: int, end: int) -> None:
        new = []
        for q, r, dist in pairs_near(self.side, side, rows, start, end, self.far[rows, -1], self.k):
            near = dist <= self.far[q, -1]
            q, r = q[near], r[near]
            found = np.zeros(len(q), FOUND)
            found["q"], found["dist"] = q, dist[near]
            for c in ("rid", "label", "flags"):
                found[c] = members[c][r]
            new.append(_first(found, self.k))
        new = np.concatenate(new) if new else np.zeros(0, FOUND)
        if not len(new):
            return
        self.found.append(new := _first(new, self.k))
        self.held += len(new)
        q, rank = new["q"], _rank(new["q"])
        whose, place = np.unique(q, return_inverse=True)
        more = np.full((len(whose), self.k), np.inf)
        more[place, rank] = new["dist"]
        self.far[whose] = np.sort(np.hstack((self.far[whose], more)), axis=1)[:, :self.k]
        if self.held > 4 * self.k * len(self.queries) + CELLS // 8:
            self.found = [self.result()]
            self.held = len(self.found[0])

    def result(self) -> np.ndarray:
        """At most k rows of each query, none beyond its k-th distance."""
        found = np.concatenate([np.zeros(0, FOUND), *self.found])
        return _first(found[found["dist"] <= self.far[found["q"], -1]], self.k)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(*v) for v in columns.values()], names=list(columns))


def _matrix(vectors: pa.Array, width: str) -> np.ndarray:
    """The rows of an array of lists."""
    sizes = vectors.value_lengths()
    if len(sizes.unique()) > 1:
        raise ValueError("vectors differ in length")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(width).reshape(len(vectors), sizes[0].as_py() if len(sizes) else 0)


def _unpacked(vecs, n: int, width: str) -> np.ndarray:
    flat = np.frombuffer(vecs, width)
    return flat.reshape(n, len(flat) // n).astype(np.float64)


def _buffer(batch: pa.RecordBatch, column: str, row: int):
    return batch.column(column)[row].as_buffer()


def _packs(it: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The partition's rows, ``size`` at a time."""
    held, n = [], 0
    for b in it:
        at = 0
        while at < b.num_rows:
            held.append(b.slice(at, size - n))
            at, n = at + held[-1].num_rows, n + held[-1].num_rows
            if n == size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _flagged(t: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, which are missing)."""
    c = t.column(column)
    return c.fill_null(0).to_numpy(), c.is_null().to_numpy()


def _placed(df: DataFrame, tree: PivotTree, width: str, parts: int) -> DataFrame:
    """(leaf, id, label, vec) in the order of the leaves."""
    def to_leaves(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                x = _matrix(b.column("v"), width)
                ends = np.arange(b.num_rows + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
                vec = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(x.tobytes())])
                yield _batch(leaf=(tree.leaf_of(x.astype(np.float64)), pa.int32()), id=b.column("id"), label=b.column("label"), vec=vec)

    return (df.mapInArrow(to_leaves, PLACED).repartitionByRange(parts, "leaf", F.xxhash64("id", "vec"))
            .sortWithinPartitions("leaf"))


def _tiles(refs: DataFrame, tree: PivotTree, width: str, chunk: int, n: int) -> DataFrame:
    def row(tile: int, leaves: np.ndarray, counts: np.ndarray, lows: np.ndarray, highs: np.ndarray, members: bytes, vecs: bytes) -> pa.RecordBatch:
        return _batch(tile=([tile], pa.int64()), leaves=([leaves], pa.list_(pa.int32())), counts=([counts], pa.list_(pa.int64())),
                      lows=([lows], pa.list_(pa.float64())), highs=([highs], pa.list_(pa.float64())), members=([members], pa.binary()), vecs=([vecs], pa.binary()))

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0)
        for seq, t in enumerate(_packs(it, chunk)):
            if not seq:
                yield row(HEAD, none, none, none, none, b"", b"")
            vecs, members = b"".join(t.column("vec").to_pylist()), np.zeros(len(t), MEMBER)
            members["leaf"] = t.column("leaf").to_numpy()
            (members["rid"], no_id), (members["label"], no_label) = _flagged(t, "id"), _flagged(t, "label")
            members["flags"] = NO_ID * no_id + NO_LABEL * no_label
            leaves, starts, counts = np.unique(members["leaf"], return_index=True, return_counts=True)
            dist = row_distances(_unpacked(vecs, len(t), width), tree.pivots[members["leaf"]])
            dist = np.where(np.isnan(dist), 0.0, dist)  # makes the ring wider
            yield row(TaskContext.get().partitionId() << 32 | seq, leaves, counts, np.minimum.reduceat(dist, starts), np.maximum.reduceat(dist, starts),
                      members.tobytes(), vecs)

    # written once: every round reads it
    return cut_lineage(_placed(refs, tree, width, min(MAX_LEAVES, -(-n // (2 * chunk)))).mapInArrow(pack, TILE))


def _block(slot: int, seq: int, leaves: np.ndarray, queries: np.ndarray, vecs: bytes, best: np.ndarray) -> pa.RecordBatch:
    return _batch(slot=([slot], pa.int32()), seq=([seq], pa.int32()), leaves=([leaves], pa.list_(pa.int32())),
                  queries=([queries.tobytes()], pa.binary()), vecs=([vecs], pa.binary()), best=([best.tobytes()], pa.binary()))


def _blocks(queries: DataFrame, tree: PivotTree, width: str, qblock: int, nq: int, target: float) -> DataFrame:
    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, t in enumerate(_packs(it, qblock)):
            vecs, q = b"".join(t.column("vec").to_pylist()), np.zeros(len(t), QUERY)
            q["qid"], q["flags"] = _flagged(t, "id")
            q["hi"] = -np.inf
            q, leaves = tree.advanced(_unpacked(vecs, len(t), width), q, np.full(len(t), np.inf), target)
            yield _block(TaskContext.get().partitionId(), seq, leaves, q, vecs, np.zeros(0, FOUND))

    # ranges are uneven: most have a quarter of a block to spare
    return cut_lineage(_placed(queries, tree, width, min(MAX_LEAVES, -(-4 * nq // (3 * qblock)))).mapInArrow(pack, BLOCK))


def neighbours(refs: DataFrame, queries: DataFrame, k: int, leaves: int | None = None, chunk: int | None = None, qblock: int | None = None,
               first: int = FIRST, watch: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """(qid, rid, label, dist): the k nearest of ``refs`` (rid, v, label) to
    each of ``queries`` (qid, qv).  ``watch`` is shown the (qid, leaf, n) that
    each round opens.  A distance of a vector that is missing, or has a missing
    number, is null; as in the SQL these come last, by id."""
    whole_refs, other_refs, n, other_n = _parted(refs, "v")
    whole_queries, other_queries, nq, other_nq = _parted(queries, "qv")
    found = []
    if n and nq:
        found.append(_nearest(whole_refs, whole_queries, k, n, nq, leaves, chunk, qblock, first, watch))
    for of, count, among in ((other_queries, other_nq, refs), (whole_queries, other_n * nq if n < k else 0, other_refs)):
        if count:
            firsts = among.select("rid", "label").orderBy(F.col("rid").asc_nulls_last()).limit(k)
            found.append(of.select("qid").crossJoin(F.broadcast(firsts)).withColumn("dist", F.lit(None).cast("double")))
    if not found:
        return refs.sparkSession.createDataFrame([], PARTIAL)
    # an id that comes twice has its rows in two places
    w = Window.partitionBy("qid").orderBy(F.col("dist").asc_nulls_last(), F.col("rid").asc_nulls_last())
    return reduce(DataFrame.unionByName, found).withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")


def _parted(df: DataFrame, v: str) -> tuple[DataFrame, DataFrame, int, int]:
    """The rows that have a vector, the others, and how many these are."""
    whole = F.col(v).isNotNull() & ~F.exists(v, lambda x: x.isNull())
    n, every = df.agg(F.count_if(whole), F.count("*")).first()
    return df.where(whole), df.where(~whole), n, every - n


def _nearest(refs: DataFrame, queries: DataFrame, k: int, n: int, nq: int, leaves: int | None, chunk: int | None, qblock: int | None,
             first: int, watch: Callable[[DataFrame], None] | None) -> DataFrame:
    """The same of n whole references and nq whole queries; k rows for each query at most."""
    spark = refs.sparkSession
    # vectors are kept as narrow as they come
    width = "<f4" if {refs.schema["v"].dataType.simpleString(), queries.schema["qv"].dataType.simpleString()} == {"array<float>"} else "<f8"
    m = leaves or min(MAX_LEAVES, int(np.ceil(np.sqrt(n))))
    # the m references of smallest md5 keys: sqrt(n) vectors, MAX_LEAVES at most
    drawn = refs.withColumn("_h", md5_long(F.lit("pivot"), F.col("rid"))).orderBy("_h", "rid").limit(m).select("v").collect()
    tree = PivotTree(np.array([r["v"] for r in drawn], dtype=np.float64))
    rows = max(1, min(PACK_ROWS, PACK_BYTES // max(1, tree.pivots.shape[1] * np.dtype(width).itemsize)))
    chunk, qblock = chunk or rows, qblock or rows

    tiles = _tiles(refs.select(F.col("rid").alias("id"), "v", "label"), tree, width, chunk, n)
    ring = tiles.select(F.explode(F.arrays_zip("leaves", "counts", "lows", "highs")).alias("x")).select("x.*")
    tree.measured(ring.groupBy(F.col("leaves").alias("leaf"))
                  .agg(F.sum("counts").alias("n"), F.min("lows").alias("low"), F.max("highs").alias("high")).collect())  # m rows

    def next_target(target: float) -> float:
        return np.inf if 4 * target >= n else target  # what would leave little is the last round

    target = next_target(first)
    state = _blocks(queries.select(F.col("qid").alias("id"), F.col("qv").alias("v"), F.lit(None).cast("int").alias("label")), tree, width, qblock, nq, target)
    slots = state.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    parts = int(min(MAX_PARTS, max(-(-4 * cores // slots), -(-n * qblock // TASK_PAIRS))))
    shown = tiles.coalesce(parts).select("tile", F.col("leaves").alias("held"), "members", F.col("vecs").alias("v"))

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[tuple, Search] = {}
        tile, members, side = None, np.zeros(0, MEMBER), None
        for b in it:
            for i, (slot, seq, this) in enumerate(zip(*(b.column(c).to_pylist() for c in ("slot", "seq", "tile")), strict=True)):
                if this == HEAD:
                    if (slot, seq) not in mine:
                        q = np.frombuffer(_buffer(b, "queries", i).to_pybytes(), QUERY)
                        mine[slot, seq] = Search(tree, k, _unpacked(_buffer(b, "vecs", i), len(q), width), q, np.frombuffer(_buffer(b, "best", i), FOUND))
                    continue
                if this != tile:
                    members = np.frombuffer(_buffer(b, "members", i).to_pybytes(), MEMBER)
                    tile, side = this, Side(_unpacked(_buffer(b, "v", i), len(members), width), False)
                mine[slot, seq].meet(members, side)
        for (slot, seq), s in mine.items():
            yield _block(slot, seq, np.zeros(0, np.int32), np.zeros(0, QUERY), b"", s.result())

    while True:
        if watch:
            watch(state.mapInArrow(_opened(tree, k, width), "qid long, leaf long, n long"))
        last = np.isinf(target)
        target = next_target(target * GROWTH)

        def merge(it: Iterator[pa.RecordBatch], last: bool = last, target: float = target) -> Iterator[pa.RecordBatch]:
            blocks: dict[tuple, tuple] = {}
            found: dict[tuple, list] = {}
            for b in it:
                for i, key in enumerate(zip(b.column("slot").to_pylist(), b.column("seq").to_pylist(), strict=True)):
                    found.setdefault(key, []).append(np.frombuffer(_buffer(b, "best", i).to_pybytes(), FOUND))
                    if len(q := np.frombuffer(_buffer(b, "queries", i).to_pybytes(), QUERY)):
                        blocks[key] = q, _buffer(b, "vecs", i).to_pybytes()
            for key, (q, vecs) in blocks.items():
                best, opened = _first(np.concatenate(found.pop(key)), k), np.zeros(0, np.int32)
                if last:
                    vecs = b""
                else:
                    q, opened = tree.advanced(_unpacked(vecs, len(q), width), q, _far(len(q), k, best)[:, -1], target)
                yield _block(*key, opened, q, vecs, best)

        # tiles stream by, the blocks of one partition are held; neither is written for it
        head = F.col("tile") == HEAD
        pairs = shown.join(state.hint("shuffle_replicate_nl"), head & (F.size("leaves") > 0) | F.arrays_overlap("held", "leaves"))
        found = (pairs.select("tile", "members", "v", "slot", "seq", *[F.when(head, F.col(c)).alias(c) for c in ("queries", "vecs", "best")])
                 .mapInArrow(search, BLOCK))
        state = cut_lineage(state.unionByName(found).repartitionById(slots, F.pmod("slot", F.lit(slots))).mapInArrow(merge, BLOCK))
        # a query without a leaf within its k-th distance so far opens none and is finished
        if last or state.where(F.size("leaves") > 0).isEmpty():
            break
    return state.mapInArrow(_listed, PARTIAL)


def _opened(tree: PivotTree, k: int, width: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(qid, leaf, n) of the leaves that blocks open."""
    def fn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(b.num_rows):
                q, best = np.frombuffer(_buffer(b, "queries", i), QUERY), np.frombuffer(_buffer(b, "best", i), FOUND)
                x, limit, every = _unpacked(_buffer(b, "vecs", i), len(q), width), _far(len(q), k, best)[:, -1], np.arange(len(tree.pivots))
                step = max(1, CELLS // len(every))
                for at in range(0, len(q), step):
                    some = slice(at, at + step)
                    row, leaf = np.nonzero(tree.opens(*tree.bounds(x[some], every), q[some], limit[some]) & (tree.count > 0))
                    yield _batch(qid=(q["qid"][at + row], pa.int64(), q["flags"][at + row] > 0), leaf=(leaf, pa.int64()), n=(tree.count[leaf], pa.int64()))
    return fn


def _listed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(qid, rid, label, dist) of what blocks have found."""
    for b in it:
        for i in range(b.num_rows):
            q, best = np.frombuffer(_buffer(b, "queries", i), QUERY), np.frombuffer(_buffer(b, "best", i), FOUND)
            mine = q[best["q"]]
            yield _batch(qid=(mine["qid"], pa.int64(), mine["flags"] > 0), rid=(best["rid"], pa.int64(), (best["flags"] & NO_ID) > 0),
                         label=(best["label"], pa.int32(), (best["flags"] & NO_LABEL) > 0), dist=(best["dist"], pa.float64()))


def knn_classify(refs: DataFrame, queries: DataFrame, k: int = 5, leaves: int | None = None,
                 vec: str = "embedding", label: str = "label", rid: str = "vec_id",
                 chunk: int | None = None, qblock: int | None = None, first: int = FIRST, watch: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Output (query id, predicted label)."""
    def numbers(df: DataFrame) -> Column:
        return F.col(vec) if df.schema[vec].dataType.simpleString() == "array<float>" else F.col(vec).cast("array<double>")

    r = refs.select(F.col(rid).cast("long").alias("rid"), numbers(refs).alias("v"), F.col(label).cast("int").alias("label"))
    q = queries.select(F.col(rid).cast("long").alias("qid"), numbers(queries).alias("qv"))
    top = neighbours(r, q, k, leaves, chunk, qblock, first, watch)
    votes = top.groupBy("qid", "label").agg(F.count("*").alias("n"))
    pred = votes.groupBy("qid").agg(F.max_by("label", F.when(F.col("label").isNotNull(), F.struct(F.col("n"), -F.col("label")))).alias("prediction"))
    return pred.select(F.col("qid").alias(rid), "prediction")
