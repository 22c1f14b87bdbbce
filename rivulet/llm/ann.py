"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample and broadcast (its size is fixed by its
parameters); every row is assigned to a leaf. A search visits the leaves best
bin first: a priority queue holds the open branches by the distance to their
centres. How many rows' worth of leaves a search visits is widened until the
measured recall of calibration queries against brute force reaches the target.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import partitions, shared
from rivulet.session import written

SLAB = 1 << 14


@dataclass
class Tree:
    """centers[i] is the centre of node i, children[i] its child nodes; leaves
    are numbered by leaf[i] (-1 for inner nodes). Node 0 is the root."""

    centers: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf each row of x falls into, going down to the nearest centre."""
        at = np.zeros(len(x), np.int64)
        todo = np.arange(len(x))
        while len(todo):
            nodes = at[todo]
            for n in np.unique(nodes):
                rows, kids = todo[nodes == n], self.children[n]
                if kids:
                    at[rows] = np.array(kids)[_distances(x[rows], self.centers[kids]).argmin(axis=1)]
            todo = np.array([i for i in todo if self.children[at[i]]], np.int64)
        return self.leaf[at]

    def best_bins(self, q: np.ndarray, limit: int) -> list[int]:
        """The first `limit` leaves in best-bin-first order of the query."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < limit:
            _, n = heapq.heappop(queue)
            while self.children[n]:
                kids = self.children[n]
                d = _distances(q[None], self.centers[kids])[0]
                best = int(d.argmin())
                for i, k in enumerate(kids):
                    if i != best:
                        heapq.heappush(queue, (float(d[i]), k))
                n = kids[best]
            out.append(int(self.leaf[n]))
        return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def grow_tree(x: np.ndarray, fan: int, leaf_rows: int, depth: int, rounds: int = 8) -> Tree:
    """Split by k-means with `fan` centres until a node has at most
    `leaf_rows` rows of x or lies `depth` levels deep."""
    rng = np.random.default_rng(5)
    centers, children, level = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [[]], [0]
    open_nodes = [(0, np.arange(len(x)))]
    while open_nodes:
        n, rows = open_nodes.pop()
        if len(rows) <= leaf_rows or level[n] >= depth:
            continue
        points = np.unique(x[rows], axis=0)
        if len(points) < 2:
            continue
        c = points[rng.choice(len(points), min(fan, len(points)), replace=False)]
        for _ in range(rounds):
            near = _distances(x[rows], c).argmin(axis=1)
            used = np.unique(near)
            c = np.stack([x[rows[near == k]].mean(axis=0) for k in used])
        near = _distances(x[rows], c).argmin(axis=1)
        for k in np.unique(near):
            child = len(centers)
            centers.append(c[k])
            children.append([])
            level.append(level[n] + 1)
            children[n].append(child)
            open_nodes.append((child, rows[near == k]))
    leaf = np.full(len(centers), -1)
    ends = [i for i, k in enumerate(children) if not k]
    leaf[ends] = np.arange(len(ends))
    return Tree(np.array(centers), children, leaf)


def _tree(parts: tuple) -> Tree:
    return Tree(*parts)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, vec) of the rows that take part, and their dimension: vectors that
    are not null, not all zero, hold finite numbers only and have the most
    frequent length (the longer one in a tie); null ids take no part."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(
        ~bad & F.exists("vec", lambda x: x != 0))
    sizes = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = sizes.d if sizes else 0
    return v.where(F.size("vec") == dim), dim


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
            query_mod: int = 100, sample: int = 20_000, fan: int = 16, leaf_rows: int = 80, depth: int = 4,
            calibration: int = 200, recall: float = 0.95) -> DataFrame:
    """The `k` nearest rows by Euclidean distance of every row whose id is
    divisible by `query_mod`: (query_id, rank, vec_id, score), rank from 1,
    ties to the smaller id, score the exact distance of the original vectors in
    double precision. A query's own rows (those with its id) are no candidates;
    rows that share another id are candidates of their own; with fewer than k
    candidates all are returned. `usable` says which rows take part; an empty
    table gives no rows; other columns are ignored.

    `sample` bounds the rows the tree is fitted on, `calibration` the queries
    compared with brute force over all rows to choose how far searches go.
    Neighbouring leaves are stored together in slabs of at most about SLAB
    rows, a larger leaf in several; a task holds one slab while the queries that
    visit it stream by.
    """
    spark = vectors.sparkSession
    rows, dim = usable(vectors, id_col, vec_col)
    rows = written(rows, "vectors")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30)))
    fit = sorted((r.id, r.vec) for r in drawn.collect())  # about `sample` vectors
    fit = np.array([v for _, v in fit]).reshape(len(fit), dim)
    grown = grow_tree(fit, fan, leaf_rows, depth)
    tree = shared(spark, (grown.centers, grown.children, grown.leaf), _tree)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.append_column("leaf", pa.array(tree().assign(_matrix(b.column("vec"), dim)), pa.int64()))

    indexed = written(rows.mapInArrow(leaves, "id long, vec array<double>, leaf long"), "leaves")
    size = {r.leaf: r.n for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per leaf
    first, count, n_slabs = _slabs(size, tree().leaves(), max(1, min(SLAB, -(-n // partitions(vectors)))))
    queries = indexed.where(F.pmod("id", F.lit(query_mod)) == 0).select("id", "vec").distinct()
    visits = _calibrated(indexed, queries, tree, dim, k, calibration, recall)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = b.column("leaf").to_numpy()
            turn = (np.arange(len(leaf)) * 2654435761 >> 7) % np.maximum(count[leaf], 1)
            yield _cells(first[leaf] + turn, 0, b.column("id"), b.column("vec"), leaf[:, None])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, slab, row, seen = _matrix(b.column("vec"), dim), [], [], []
            for i in range(len(x)):
                mine: dict[int, list[int]] = {}
                for f in tree().best_bins(x[i], visits):
                    for s in range(first[f], first[f] + count[f]):
                        mine.setdefault(s, []).append(f)
                slab += mine
                seen += mine.values()
                row += [i] * len(mine)
            at = pa.array(row, pa.int64())
            yield _cells(np.array(slab, np.int64), 1, b.column("id").take(at), b.column("vec").take(at), seen)

    schema = "slab long, side int, id long, vec array<double>, leaves array<long>"
    spread = queries.repartition(partitions(vectors), "id")  # few bytes, but a search each: not for one task
    cells = indexed.mapInArrow(store, schema).unionByName(spread.mapInArrow(visit, schema))
    cells = cells.repartitionById(n_slabs, F.col("slab").cast("int")).sortWithinPartitions("slab", "side")
    near = cells.mapInArrow(_scan_slabs(dim, k), "query_id long, vec_id long, score double")
    best = near.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("all"))
    out = best.select("query_id", F.posexplode(F.slice("all", 1, k)).alias("pos", "hit"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def _slabs(size: dict[int, int], leaves: int, rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first slab, number of slabs) of every leaf and the number of slabs:
    leaves in their order share a slab up to about `rows` rows; a larger leaf
    has slabs of its own."""
    first, count = (np.zeros(leaves, np.int64) for _ in range(2))
    slab, held = 0, 0
    for f, n in sorted(size.items()):
        if held and held + n > rows:
            slab, held = slab + 1, 0
        first[f], count[f] = slab, max(1, -(-n // rows))
        slab, held = slab + count[f] - 1, held + n if count[f] == 1 else rows
    return first, count, int(slab) + 1


def _cells(slab, side: int, ids: pa.Array, vec: pa.Array, leaves) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(slab, pa.int64()), pa.array([side] * n, pa.int32()), ids, vec,
         pa.array([list(map(int, x)) for x in leaves], pa.list_(pa.int64()))], ["slab", "side", "id", "vec", "leaves"])


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _nearest_rows(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, open_rows=None):
    """(query, row, distance) arrays of the k nearest rows of x by (distance,
    id) for every query, without rows of the query's id and, where given, only
    among the rows marked in open_rows (queries x rows). A matrix product
    selects candidates with a margin over its rounding error; their distances
    are then computed from the differences."""
    out = []
    norm = (x * x).sum(1)
    for a in range(0, len(q), 256):
        qs = q[a:a + 256]
        d = (qs * qs).sum(1)[:, None] - 2 * qs @ x.T + norm[None]
        closed = q_ids[a:a + 256, None] == ids[None]
        if open_rows is not None:
            closed |= ~open_rows[a:a + 256]
        d[closed] = np.inf
        slack = 1e-9 * ((qs * qs).sum(1) + norm.max(initial=0.0))
        edge = np.partition(d, k - 1, axis=1)[:, k - 1] if len(x) > k else d.max(axis=1, initial=0.0)
        i, j = np.nonzero((d <= (edge + slack)[:, None]) & ~closed)
        exact = np.sqrt(((x[j] - qs[i]) ** 2).sum(axis=1))
        by = np.lexsort((ids[j], exact, i))
        i, j, exact = i[by], j[by], exact[by]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < k
        out.append((i[top] + a, j[top], exact[top]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def _scan_slabs(dim: int, k: int):
    """Slabs arrive one after another, their rows (side 0) before the queries
    that visit them; each query gets the slab's k nearest rows."""
    def found(rows: list, batch: pa.RecordBatch) -> pa.RecordBatch:
        x, ids, leaf = (np.concatenate(c) for c in zip(*rows))
        q, q_ids = _matrix(batch.column("vec"), dim), batch.column("id").to_numpy()
        seen = batch.column("leaves").to_pylist()
        names, place = np.unique(leaf, return_inverse=True)
        visited = np.array([np.isin(names, s) for s in seen]).reshape(len(q), len(names))
        i, j, d = _nearest_rows(q, q_ids, x, ids, k, visited[:, place])
        return pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(ids[j]), pa.array(d)], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for b in batches:
            if not b.num_rows:
                continue
            slab, side = b.column("slab").to_numpy(), b.column("side").to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], (slab[1:] != slab[:-1]) | (side[1:] != side[:-1]), [True]]))
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if slab[lo] != now:
                    now, rows = slab[lo], []
                part = b.slice(lo, hi - lo)
                if side[lo] == 0:
                    rows.append((_matrix(part.column("vec"), dim), part.column("id").to_numpy(),
                                 part.column("leaves").flatten().to_numpy()))
                elif rows:
                    for c in range(0, part.num_rows, 1024):
                        yield found(rows, part.slice(c, 1024))
    return run


def _calibrated(indexed: DataFrame, queries: DataFrame, tree, dim: int, k: int, calibration: int,
                recall: float) -> int:
    """The smallest number of leaves to visit at which the calibration queries
    find the asked share of their true k nearest rows (all rows compared)."""
    some = queries.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(calibration).collect()  # `calibration` rows
    if not some:
        return 1
    q_ids = np.array([r.id for r in some])
    q = np.array([r.vec for r in some]).reshape(len(some), dim)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for b in batches:
            if not b.num_rows:
                continue
            ids, leaf = b.column("id").to_numpy(), b.column("leaf").to_numpy()
            i, j, d = _nearest_rows(q, q_ids, _matrix(b.column("vec"), dim), ids, k)
            i, d, name, leaf = (np.concatenate(c) for c in zip(best, (i, d, ids[j], leaf[j])))
            by = np.lexsort((name, d, i))
            by = by[np.arange(len(by)) - np.searchsorted(i[by], i[by]) < k]
            best = i[by], d[by], name[by], leaf[by]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best], ["query", "score", "id", "leaf"])

    near = indexed.mapInArrow(exact, "query long, score double, id long, leaf long")
    true = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "id", "leaf"))).alias("all")).select(
        "query", F.transform(F.slice("all", 1, k), lambda h: h["leaf"]).alias("leaves")).collect()
    leaves = tree().leaves()
    needed = []
    for r in true:
        rank = {f: i + 1 for i, f in enumerate(tree().best_bins(q[r.query], leaves))}
        needed += [rank[f] for f in r.leaves]
    if not needed:
        return 1
    return sorted(needed)[int(np.ceil(recall * len(needed))) - 1]
