"""Nearest neighbours with an inverted multi-index.

1. Vectors are cut in two halves; each half has a codebook of centroids, fitted on a bounded sample.  A
   vector's entry is in the cell of its two nearest centroids; every vector is entered.
2. A query walks the centroid pairs in ascending order of the summed distances of its halves, with a heap,
   until the cells it has met hold the share of all entries that reached ``target`` recall within the
   sample.  Structureless vectors need a large share, clustered ones a small one.
3. Entries are dealt by their first centroid, split by a salt where that is large, and queries to the
   centroids they visit, with the second centroids as a bit mask.  A task holds the entries of one such
   part, which are bounded, and streams its queries past them: distances to the entries of the cells
   visited, exact for the nearest ones.  The best of all parts are ranked per query.

Copies of one vector become one entry with its smallest ids: no more of them can be in a result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import slices

#: vectors of the sample that codebooks and share are fitted on, and how many of them are queries
SAMPLE, PROBES = 16_384, 400
CENTROIDS, ROUNDS = 64, 12
TARGET = 0.95
#: entries of a part, about
PART_ROWS = 1 << 16
#: products of a block of queries with a part are made this many at once
PRODUCTS = 1 << 22

#: squares of larger components may leave the double range
LARGE = 1e150

#: the vectors of the query and the entry sides, in one form
ROW = "part int, salt int, kind int, code binary, vector binary, ids array<long>"


@dataclass
class Index:
    """Codebooks of both halves, and the share of entries a query visits."""

    left: np.ndarray
    right: np.ndarray
    share: float

    @property
    def half(self) -> int:
        return self.left.shape[1]


def squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids, components beyond LARGE taken as that: they choose cells only."""
    x = np.clip(x, -LARGE, LARGE)
    return (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None, :]


def cells(index: Index, x: np.ndarray) -> np.ndarray:
    return (squares(x[:, :index.half], index.left).argmin(1) * len(index.right)
            + squares(x[:, index.half:], index.right).argmin(1))


def codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by Lloyd's iterations from distinct rows."""
    x = np.clip(x, -LARGE, LARGE)
    distinct = np.unique(x, axis=0)
    centroids = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)].copy()
    for _ in range(rounds):
        nearest = squares(x, centroids).argmin(1)
        n = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


def walk(left: np.ndarray, right: np.ndarray, counts: np.ndarray, target: int) -> list[int]:
    """Cells in ascending order of ``left[i] + right[j]``, until those met hold ``target`` entries.

    ``counts`` are the entries per cell.  Each step takes the least pair from the heap and adds its
    neighbours in the two sorted lists, each once both its own predecessors were taken.
    """
    order_l, order_r = left.argsort(kind="stable").tolist(), right.argsort(kind="stable").tolist()
    dl, dr = left[order_l].tolist(), right[order_r].tolist()
    # how far each row of the grid, and each column, has been taken
    done_l, done_r = [0] * len(dl), [0] * len(dr)
    heap, met, out, width = [(dl[0] + dr[0], 0, 0)], 0, [], len(dr)
    counts = counts.tolist()
    while heap and met < target:
        _, i, j = heapq.heappop(heap)
        cell = order_l[i] * width + order_r[j]
        out.append(cell)
        met += counts[cell]
        done_l[i], done_r[j] = j + 1, i + 1
        if i + 1 < len(dl) and done_l[i + 1] == j:
            heapq.heappush(heap, (dl[i + 1] + dr[j], i + 1, j))
        if j + 1 < width and done_r[j + 1] == i:
            heapq.heappush(heap, (dl[i] + dr[j + 1], i, j + 1))
    return out


def fit(sample: np.ndarray, k: int, target: float = TARGET, centroids: int = CENTROIDS, seed: int = 7) -> Index:
    """Codebooks of a sample, and the least share with which its probes find ``target`` of their ``k`` nearest.

    With a target of 1 queries visit all entries, and results are exact."""
    rng, half = np.random.default_rng(seed), sample.shape[1] // 2
    index = Index(codebook(sample[:, :half], centroids, rng), codebook(sample[:, half:], centroids, rng), 1.0)
    probes = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
    k = min(k, len(sample) - 1)
    if k < 1 or target >= 1:
        return index
    at = cells(index, sample)
    counts = np.bincount(at, minlength=len(index.left) * len(index.right))
    needed = []
    for p in probes.tolist():
        d = squares(sample, sample[p:p + 1])[:, 0]
        d[p] = np.inf
        near = at[np.argpartition(d, k - 1)[:k]]
        q = sample[p:p + 1]
        order = walk(squares(q[:, :half], index.left)[0], squares(q[:, half:], index.right)[0], counts, len(sample))
        upto = np.cumsum(counts[order])
        place = np.full(len(counts), len(order) - 1)
        place[order] = np.arange(len(order))
        needed += upto[place[near]].tolist()
    index.share = float(np.sort(needed)[min(len(needed) - 1, int(target * len(needed)))]) / len(sample)
    return index


def usable(vectors: DataFrame, dims: int | None = None) -> DataFrame:
    """``vec_id, vector array<double>`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    ok = (F.col("vec_id").isNotNull() & F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"), ok.alias("ok")).where("ok").drop("ok")
    return rows if dims is None else rows.where(F.size("vector") == dims)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def build(vectors: DataFrame, k: int, **settings) -> tuple[Index, int, np.ndarray] | None:
    """Index, number of dimensions and entries per cell; None if no vector takes part.

    Vectors of another length than the most frequent one (the larger of equally frequent ones) take no part.
    """
    sizes = usable(vectors).groupBy(F.size("vector").alias("dims")).count().collect()
    if not sizes:
        return None
    n, dims = max((r["count"], r["dims"]) for r in sizes)
    rows = usable(vectors, dims)
    # a share by a hash of the vector, so copies are in or out together, then at most SAMPLE distinct ones
    scale = 1 << 30
    h = F.xxhash64("vector")
    if n > SAMPLE:
        rows = rows.where(F.pmod(h, F.lit(scale)) < F.lit(int(scale * min(1.0, 2 * SAMPLE / n))))
    sample = rows.select("vector", h.alias("h")).distinct().orderBy("h", "vector").limit(SAMPLE).toArrow()
    if not sample.num_rows:  # nearly all rows are copies
        sample = usable(vectors, dims).select("vector").limit(1).toArrow()
    index = fit(matrix(sample.column("vector").combine_chunks(), dims), k, **settings)
    return index, dims, entries_per_cell(usable(vectors, dims), index, dims)


def entries_per_cell(rows: DataFrame, index: Index, dims: int) -> np.ndarray:
    def count(batches):
        total = np.zeros(len(index.left) * len(index.right), np.int64)
        for batch in slices(batches, "vector"):
            total += np.bincount(cells(index, matrix(batch.column("vector"), dims)), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    counts = np.zeros(len(index.left) * len(index.right), np.int64)
    for r in rows.select("vector").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    return counts


def binaries(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    raw = np.ascontiguousarray(x)
    width = raw.shape[1] * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(np.arange(0, len(raw) * width + 1, width, dtype=np.int32).tobytes()),
                                                         pa.py_buffer(raw.tobytes())])


def entries(rows: DataFrame, index: Index, dims: int, k: int, salts: np.ndarray) -> DataFrame:
    """Entry rows: copies within a slice are one entry with their ``k + 1`` smallest ids."""

    def make(batches):
        width = len(index.right)
        for batch in slices(batches, "vector"):
            x, ids = matrix(batch.column("vector"), dims), batch.column("vec_id").to_numpy()
            x = x + 0.0  # one form of zero
            raw = x.view(np.dtype((np.void, x.itemsize * dims))).ravel()
            order = np.lexsort((ids, raw))
            new = np.concatenate([[True], raw[order][1:] != raw[order][:-1]])
            group = np.cumsum(new) - 1
            fresh = new | np.concatenate([[True], ids[order][1:] != ids[order][:-1]])
            order, group = order[fresh], group[fresh]
            rank = np.arange(len(group)) - np.searchsorted(group, group)
            order, group = order[rank <= k], group[rank <= k]
            first = np.searchsorted(group, np.arange(group[-1] + 1))
            one = x[order[first]]
            at = cells(index, one)
            part = at // width
            # copies have one salt everywhere
            salt = (np.array([xxhash.xxh3_64_intdigest(v.tobytes()) >> 1 for v in one], np.int64) if salts.max() > 1
                    else np.zeros(len(one), np.int64)) % salts[part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(np.zeros(len(one), np.int32)),
                 binaries((at % width).astype(np.int16)[:, None]), binaries(one),
                 pa.ListArray.from_arrays(pa.array(np.append(first, len(group)), pa.int32()), pa.array(ids[order]))],
                ["part", "salt", "kind", "code", "vector", "ids"])

    return rows.mapInArrow(make, ROW)


def visits(queries: DataFrame, index: Index, dims: int, counts: np.ndarray, least: int, salts: np.ndarray) -> DataFrame:
    """Query rows: one per part that the query visits, with the second centroids as a mask."""
    target = max(least, int(np.ceil(index.share * counts.sum())))

    def make(batches):
        width = len(index.right)
        for batch in slices(batches, "vector", 1 << 16):
            x, ids = matrix(batch.column("vector"), dims) + 0.0, batch.column("vec_id").to_numpy()
            dl, dr = squares(x[:, :index.half], index.left), squares(x[:, index.half:], index.right)
            which, part, masks = [], [], []
            for k in range(len(x)):
                mask = np.zeros((len(index.left), width), bool)
                mask.ravel()[walk(dl[k], dr[k], counts, target)] = True
                some = np.flatnonzero(mask.any(1))
                which.append(np.full(len(some), k))
                part.append(some)
                masks.append(np.packbits(mask[some], axis=1))
            which, part, masks = np.concatenate(which), np.concatenate(part), np.concatenate(masks)
            n = salts[part]
            again = np.repeat(np.arange(len(part)), n)
            salt = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
            which, part, masks = which[again], part[again], masks[again]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(np.ones(len(part), np.int32)), binaries(masks),
                 binaries(x[which]), pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1), pa.int32()), pa.array(ids[which]))],
                ["part", "salt", "kind", "code", "vector", "ids"])

    return queries.mapInArrow(make, ROW)


class Part:
    """The entries of one part: copies from different slices merged, ``k + 1`` smallest ids each."""

    def __init__(self, dims: int, k: int):
        self.dims, self.k = dims, k
        self.found: dict[bytes, tuple] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        for code, vector, ids in zip(*(batch.column(c).to_pylist() for c in ("code", "vector", "ids"))):
            old = self.found.get(vector)
            self.found[vector] = (code, ids if old is None else sorted({*old[1], *ids})[:self.k + 1])

    def close(self) -> None:
        n = len(self.found)
        self.x = np.frombuffer(b"".join(self.found), np.float64).reshape(n, self.dims)
        self.code = np.frombuffer(b"".join(c for c, _ in self.found.values()), np.int16)
        self.ids = [ids for _, ids in self.found.values()]
        self.found = {}
        with np.errstate(over="ignore"):
            self.norm = (self.x * self.x).sum(1)

    def nearest(self, batch: pa.RecordBatch):
        """``query_id, vec_id, score`` of each query's ``k`` best here, itself left out."""
        ids = batch.column("ids").flatten().to_numpy()
        q = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64).reshape(-1, self.dims)
        masks = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(q), -1)
        out = ([], [], [])
        step = max(1, PRODUCTS // max(1, len(self.x)))
        for s in range(0, len(q) if len(self.x) else 0, step):
            some = q[s:s + step]
            with np.errstate(over="ignore", invalid="ignore"):
                norm = (some * some).sum(1)[:, None] + self.norm[None, :]
                d = norm - 2 * some @ self.x.T
                # what rounding may have added or taken
                slack = 1e-12 * norm
            # out of double range: looked at exactly
            wild = ~np.isfinite(d)
            d[wild], slack[wild] = 0.0, 0.0
            d[np.unpackbits(masks[s:s + step], axis=1)[:, self.code] == 0] = np.inf
            for r in range(len(some)):
                me, row = int(ids[s + r]), d[r]
                # one more than k, as one may be the query itself
                worst = np.partition(row, self.k)[self.k] if len(row) > self.k + 1 else np.inf
                near = np.flatnonzero((row - slack[r] <= worst + slack[r].max(initial=0)) & (row < np.inf))
                with np.errstate(over="ignore"):
                    exact = np.sqrt(((self.x[near] - some[r]) ** 2).sum(1))
                best = sorted((e, i) for e, at in zip(exact.tolist(), near.tolist()) for i in self.ids[at] if i != me)[:self.k]
                out[0].extend([me] * len(best))
                out[1].extend(i for _, i in best)
                out[2].extend(e for e, _ in best)
        return out


def neighbours(vectors: DataFrame, is_query: Column, k: int = 10, **settings) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query row, by Euclidean distance.

    Ties go to the smaller id.  Rows with a null id, a null, zero or empty vector, or null or
    non-finite components take no part, nor do vectors of another length than the most frequent one.
    Rows that share an id are one item with several vectors: the smallest distance counts.  With
    fewer than ``k`` other items all are returned.  An empty table gives no rows.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    built = build(vectors, k, **settings)
    if built is None:
        return vectors.sparkSession.createDataFrame([], schema)
    index, dims, counts = built
    per_part = counts.reshape(len(index.left), -1).sum(1)
    salts = np.maximum(1, -(-per_part // PART_ROWS))
    rows = usable(vectors, dims)
    dealt = (entries(rows, index, dims, k, salts)
             .unionAll(visits(rows.where(is_query), index, dims, counts, min(int(counts.sum()), 20 * k), salts))
             .repartition("part", "salt").sortWithinPartitions("part", "salt", "kind"))

    def compare(batches):
        now, part = None, None
        for batch in slices(batches, "vector", 4 << 20):
            key = [batch.column(c).to_numpy() for c in ("part", "salt", "kind")]
            cut = np.flatnonzero(np.any([np.diff(c) != 0 for c in key], axis=0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                piece, at = batch.slice(a, b - a), (key[0][a], key[1][a])
                if at != now:
                    now, part, closed = at, Part(dims, k), False
                if key[2][a] == 0:
                    part.add(piece)
                else:
                    if not closed:
                        part.close()
                        closed = True
                    found = part.nearest(piece)
                    yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()),
                                                      pa.array(found[2], pa.float64())], ["query_id", "vec_id", "score"])

    best = (dealt.mapInArrow(compare, "query_id long, vec_id long, score double")
            .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
