"""Approximate nearest neighbours by cosine over balanced posting lists.

Fit: a sample of unit vectors (those of least hash) is split again and again into equal halves along its main axis,
until a part holds at most `posting` of the rows it stands for; the means of the parts are the centroids. Equal halves
keep the lists balanced. Beyond `most_centroids` centroids their number grows with the root of the rows, and the sample
with eight vectors a centroid, so lists and what a query reads grow with the root too. The sample has at most `sample`
vectors or `sample_bytes`, whichever is more, and centroids are at most an eighth of it: the index that goes to the
executors has a fixed bound, whatever the table's size.

Graph: centroids are linked to their nearest ones and to random ones; a beam search over that graph finds the lists
near a vector. It runs for whole batches of vectors at once.

Lists: a vector goes to the list of its nearest centroid and, near a boundary, to further ones whose distance is within
`replica_ratio` of the least, unless a chosen centroid is nearer to that centroid than the vector is (those replicas
would answer the same queries). A query probes the lists whose distance is within `probe_ratio` of the least, and
further ones until their own ids suffice for k neighbours.

Scoring: lists are dealt out in blocks of about `block` rows, so a list that many equal vectors share is scored by many
tasks, and a query goes to each block of a list. The queries of a list are dealt out likewise, in shares of about `asked`,
and each block goes to every share, so a task has at most a block and a share however many queries probe its list. It
returns each query's k best ids; the best of all blocks follow.
Scores are cosines of the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import picked, stored, trimmed


@dataclass(frozen=True)
class Plan:
    """Parameters of the index. Defaults were set by measured recall."""

    sample: int = 1 << 15
    sample_bytes: int = 1 << 28
    posting: int = 256
    most_centroids: int = 4096
    degree: int = 24
    beam: int = 48
    replica_ratio: float = 1.12
    replicas: int = 6
    probe_ratio: float = 1.45
    probes: int = 40
    block: int = 4096
    asked: int = 16384


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray


def sizes_of(rows: int, width: int, plan: Plan) -> tuple[int, int]:
    """Vectors in the sample, and most centroids, for so many rows of so many components."""
    grown = math.isqrt(rows)
    if grown <= plan.most_centroids:
        return plan.sample, plan.most_centroids
    sample = max(plan.sample, min(8 * grown, plan.sample_bytes // (8 * width)))
    return sample, max(plan.most_centroids, min(grown, sample // 8))


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def fit(vectors: np.ndarray, rows: int, plan: Plan) -> Index:
    """Centroids and graph from a sample of unit vectors that stands for so many rows."""
    rng = np.random.default_rng(11)
    parts = int(np.clip(-(-rows // plan.posting), 1, sizes_of(rows, vectors.shape[1], plan)[1]))
    least = max(1, len(vectors) // parts)
    todo, done = [np.arange(len(vectors))], []
    while todo:
        own = todo.pop()
        if len(own) < 2 * least or len(own) < 2:
            done.append(own)
            continue
        x = vectors[own] - vectors[own].mean(axis=0)
        axis = rng.standard_normal(x.shape[1])
        for _ in range(8):  # the power method
            axis = x.T @ (x @ axis)
            size = np.linalg.norm(axis)
            if size == 0:
                break
            axis /= size
        order = np.argsort(x @ axis, kind="stable")
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    centroids = np.array([vectors[own].mean(axis=0) for own in done])
    for _ in range(4):  # a few rounds of refinement; a centroid moves only if its part is at most four times its share
        near = np.empty(len(vectors), np.int64)
        step = max(1, min(4096, (1 << 24) // len(centroids)))
        for a in range(0, len(vectors), step):
            near[a : a + step] = _distances(vectors[a : a + step], centroids).argmin(axis=1)
        size = np.bincount(near, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, near, vectors)
        good = (size > 0) & (size <= 4 * least)
        centroids[good] = total[good] / size[good, None]
    n = len(centroids)
    degree = min(plan.degree, n - 1)
    links = np.empty((n, degree + min(4, n - 1)), np.int64)
    step = max(1, min(1024, (1 << 22) // n))
    for a in range(0, n, step):
        d = _distances(centroids[a : a + step], centroids)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        links[a : a + step, :degree] = np.argpartition(d, degree - 1, axis=1)[:, :degree] if 0 < degree < n else 0
    if n > 1:
        links[:, degree:] = rng.integers(0, n, (n, links.shape[1] - degree))
    entries = np.unique(rng.integers(0, n, 16))
    return Index(centroids, links, entries)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None]))


def nearest_lists(x: np.ndarray, index: Index, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids near each row of x and their distances, nearest first, found by beam search over the graph."""
    n, rows = len(index.centroids), len(x)
    beam = min(beam, n)
    best = np.full((rows, beam), -1, np.int64)
    far = np.full((rows, beam), np.inf)
    seen = np.zeros((rows, n), bool)
    opened = np.zeros((rows, n), bool)
    fresh = np.broadcast_to(index.entries, (rows, len(index.entries)))
    own = np.arange(rows)[:, None]
    norms = (index.centroids**2).sum(axis=1)
    sizes = (x * x).sum(axis=1)[:, None]
    while True:
        fresh = np.sort(fresh, axis=1)
        new = ~seen[own, fresh]
        new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        seen[own, fresh] = True
        d = np.full(fresh.shape, np.inf)
        r, c = np.nonzero(new)
        ids = fresh[r, c]
        for a in range(0, len(r), 1 << 16):
            i, j = r[a : a + (1 << 16)], ids[a : a + (1 << 16)]
            d[i, c[a : a + (1 << 16)]] = np.sqrt(np.maximum(0, sizes[i, 0] - 2 * np.einsum("ij,ij->i", x[i], index.centroids[j]) + norms[j]))
        both, ids = np.concatenate([far, d], axis=1), np.concatenate([best, np.where(new, fresh, -1)], axis=1)
        order = np.argsort(both, axis=1, kind="stable")[:, :beam]
        far, best = np.take_along_axis(both, order, 1), np.take_along_axis(ids, order, 1)
        closed = (best >= 0) & ~opened[own, best]
        if not closed.any():
            return best, far
        # the nearest few that are not open yet, for each row that has any
        rank = np.cumsum(closed, axis=1)
        take = closed & (rank <= 4)
        r, c = np.nonzero(take)
        opened[r, best[r, c]] = True
        slot = rank[r, c] - 1
        step = np.full((rows, 4), -1, np.int64)
        step[r, slot] = best[r, c]
        step = np.where(step < 0, step[:, :1], step)
        step = np.where(step < 0, index.entries[0], step)
        fresh = index.links[step].reshape(rows, -1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def _assign(index, plan: Plan, width: int):
    """(list, vec_id, first, vector) for each list a vector belongs to; first marks its nearest."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        for b in _pieces(batches):
            x = _units(_matrix(b.column("vector"), width))
            ids, far = nearest_lists(x, at, min(plan.beam, 4 * plan.replicas))
            keep = np.zeros(ids.shape, bool)
            keep[:, 0] = True
            for c in range(1, ids.shape[1]):
                good = (ids[:, c] >= 0) & (far[:, c] <= plan.replica_ratio * far[:, 0] + 1e-12) & (keep.sum(axis=1) < plan.replicas)
                for e in range(c):  # a list chosen before that is nearer to this one covers it
                    good &= ~(keep[:, e] & (np.linalg.norm(at.centroids[ids[:, c]] - at.centroids[ids[:, e]], axis=1) < far[:, c]))
                keep[:, c] = good
            r, c = np.nonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(ids[r, c].astype(np.int32)), b.column("vec_id").take(pa.array(r)), pa.array(c == 0), b.column("vector").take(pa.array(r))], ["list", "vec_id", "first", "vector"])

    return run


def _probe(index, plan: Plan, width: int, own_rows: np.ndarray, k: int):
    """(list, query_id, vector) for each list that a query probes."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        for b in _pieces(batches):
            x = _units(_matrix(b.column("vector"), width))
            ids, far = nearest_lists(x, at, max(plan.beam, plan.probes))
            near = (ids >= 0) & (far <= plan.probe_ratio * far[:, :1] + 1e-12)
            near[:, plan.probes :] = False
            held = np.where(ids >= 0, own_rows[ids], 0)
            enough = np.cumsum(held, axis=1) - held > k  # lists before this one have k ids besides the query
            near |= (ids >= 0) & ~enough
            r, c = np.nonzero(near)
            lists = ids[r, c]
            short = np.flatnonzero(held.sum(axis=1) <= k)  # near nothing that holds k rows: probe every list
            if len(short):
                r = np.concatenate([r[~np.isin(r, short)], np.repeat(short, len(own_rows))])
                lists = np.concatenate([lists[~np.isin(np.nonzero(near)[0], short)], np.tile(np.arange(len(own_rows)), len(short))])
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), b.column("vec_id").take(pa.array(r)), b.column("vector").take(pa.array(r))], ["list", "query_id", "vector"])

    return run


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of row pairs, each summed in the same order whatever the rows around it. Rows are first scaled by powers of two, which changes no digit and keeps squares in range."""
    q, v = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None]) for x in (q, v))
    return np.einsum("ij,ij->i", q, v) / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", v, v)))


def _score(width: int, k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        qid, vid = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
        out = ([], [], [])
        if len(qid) and len(vid):
            q, v = _matrix(left.column("vector").combine_chunks(), width), _matrix(right.column("vector").combine_chunks(), width)
            unit = _units(v)
            by_id = np.argsort(vid, kind="stable")
            starts = np.flatnonzero(np.diff(vid[by_id], prepend=vid[by_id[0]] - 1))
            for a in range(0, len(qid), 256):
                s = _units(q[a : a + 256]) @ unit.T
                s[qid[a : a + 256, None] == vid[None]] = -np.inf
                own = np.maximum.reduceat(s[:, by_id], starts, axis=1)  # the best row of each id
                take = min(k, own.shape[1])
                least = np.partition(own, own.shape[1] - take, axis=1)[:, own.shape[1] - take]
                for i in range(len(s)):
                    # all that rounding may put among the first; then exactly, ties to the smaller id
                    c = np.flatnonzero(s[i] >= max(least[i], -2.0) - 1e-12)
                    exact = np.concatenate([cosines(np.broadcast_to(q[a + i], (len(p), width)), v[p]) for p in np.array_split(c, max(1, len(c) // 4096))]) if len(c) else np.empty(0)
                    order = np.lexsort((vid[c], -exact))
                    _, first = np.unique(vid[c][order], return_index=True)
                    order = order[np.sort(first)][:k]
                    out[0].append(np.full(len(order), qid[a + i]))
                    out[1].append(vid[c][order])
                    out[2].append(exact[order])
        cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        return pa.table({"query_id": cat(out[0], np.int64), "vec_id": cat(out[1], np.int64), "score": cat(out[2], np.float64)})

    return run


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part: finite, not zero, no null inside, with an id. Rows may repeat."""
    rows = picked(table, vec_id=id_col, vector=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(~bad & F.exists("vector", lambda x: x != 0)).where(F.size("vector") > 0)


def search(table: DataFrame, queries: DataFrame | None = None, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", plan: Plan = Plan()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of each query, nearest first, ties to the smaller id.

    queries is a condition's rows of the table (all of them if None). Vectors that are null, zero or hold a null or
    non-finite component take no part, nor do rows without an id. Vectors of another length than the most frequent
    take no part either, since no cosine is defined. A row isn't its own neighbour, nor is any row of its id; rows
    that repeat are one. With fewer than k candidates all are returned. An empty table gives an empty result.
    """
    spark = table.sparkSession
    rows = usable(table, id_col, vector_col)
    drawn = F.xxhash64("vec_id", "vector", F.lit(5))
    sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("k"), F.approx_count_distinct(drawn).alias("distinct"))
    top = sizes.orderBy(F.desc("k"), "width").first()
    shape = "query_id long, rank int, vec_id long, score double"
    if top is None:
        return spark.createDataFrame([], shape)
    width, n_rows = top.width, min(top.k, top.distinct)  # repeated rows are one
    rows = rows.where(F.size("vector") == width)
    asked = usable(queries, id_col, vector_col).where(F.size("vector") == width) if queries is not None else rows
    n_sample, _ = sizes_of(n_rows, width, plan)
    share = min(1.0, 2.0 * n_sample / n_rows)
    # twice the sample by threshold, then exactly the rows of least hash
    some = rows.where(drawn <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)))) if share < 1 else rows
    some = some.dropDuplicates(["vec_id", "vector"]).orderBy(drawn, "vec_id").limit(n_sample).select("vector")
    sample = _units(_matrix(some.toArrow().column("vector").combine_chunks(), width))
    index = spark.sparkContext.broadcast(fit(sample, n_rows, plan))
    n_lists = len(index.value.centroids)
    lists = stored(rows.dropDuplicates(["vec_id", "vector"]).mapInArrow(_assign(index, plan, width), "list int, vec_id long, first boolean, vector array<double>"))
    one = lists.where("first").groupBy("vec_id").agg(F.min("list").alias("list")).select("list", F.lit(True).alias("own"))  # an id counts in one list
    both = lists.select("list", F.lit(False).alias("own")).union(one)
    counted = both.groupBy("list").agg(F.count_if(~F.col("own")).alias("k"), F.count_if("own").alias("own")).collect()  # a row a list, as many as centroids
    own, held = np.zeros(n_lists, np.int64), np.zeros(n_lists, np.int64)
    for r in counted:
        own[r.list], held[r.list] = r.own, r.k
    probes = stored(asked.mapInArrow(_probe(index, plan, width, own, k), "list int, query_id long, vector array<double>"))
    posed = {r.list: r.k for r in probes.groupBy("list").agg(F.count("*").alias("k")).collect()}  # a row a list
    parts = spark.createDataFrame([(i, int(max(1, -(-h // plan.block))), int(max(1, -(-posed.get(i, 0) // plan.asked)))) for i, h in enumerate(held)], "list int, blocks int, shares int")
    parts = F.broadcast(parts)  # a row a centroid
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = probes.join(parts, "list").select("list", each("blocks").alias("block"), dealt("query_id", "shares").alias("share"), "query_id", "vector")
    right = lists.join(parts, "list").select("list", dealt("vec_id", "blocks").alias("block"), each("shares").alias("share"), "vec_id", "vector")
    own_task = ("list", "block", "share")
    found = left.groupBy(*own_task).cogroup(right.groupBy(*own_task)).applyInArrow(_score(width, k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
