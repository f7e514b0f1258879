"""Exact top-k inner-product search by block-at-a-time pruning (operator 9).

Vectors, as integers floor(256 * x), are renumbered so that like ones stand together: by the nearest of PIVOTS sampled
vectors, by the next nearest one, then by vec_id. SHEET of them in that order make a sheet (one row of a table), cut into
blocks of BLOCK. A block keeps, per component ("term"), its greatest and least value, and its vectors as a forward
index. For a query the blocks of a sheet are ordered by the sum of its terms' best contributions; the blocks are
scored in that order until a block's bound falls below the query's kth score (a bound that equals it may still
hold a tie with a smaller vec_id, so it is scored). All scores are exact integers.

A query's first kth score comes from the sheet that it stands in itself, where its like are; it goes with the query to
all other sheets and rises within a task. Vectors are shuffled twice, 16 bits a component where that is exact: into order,
and a run of BUCKET sheets to its task. Queries, a few hundred KB for 2048 of them, are what is copied: once a bucket.
A query's best k from every sheet meet in a ranked group. So neither side is ever whole in a task, on the driver or in a
broadcast.

How much is skipped depends on the vectors: where they stand in clusters, most blocks; where they are spread evenly over
a sphere of many dimensions no bound of this kind tells blocks apart (``pruning`` reports both).

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows without vec_id. Vectors
of different lengths are compared as if the shorter one ended in zeros. Every row counts, whether or not others share its
vec_id: each row that is a query has its own ranks, and its candidates are all rows but itself. Scores beyond a long
raise. With fewer than k candidates all are returned. Extra columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from seatloom.llm.common import bound_batches, cut, fields, partitions_for, tidy

SCALE, SHEET, BLOCK, BUCKET = 256, 2048, 64, 8
#: Vectors that the order is made by: a bounded sample, of those whose hashes are least.
PIVOTS = 256
#: Bytes of vectors that one partition puts into sheets.
PART_BYTES = 32 << 20
#: Query sheets whose kth scores a task remembers.
REMEMBERED = 64


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


# ---------------------------------------------------------------- sheets


def pack(matrix: np.ndarray, *columns: np.ndarray) -> bytes:
    """A matrix of whole numbers, 16 bits each where they fit, and columns of 64-bit integers beside it."""
    small = np.abs(matrix).max(initial=0) < 1 << 15
    return struct.pack("<III", *matrix.shape, int(small)) + matrix.astype("<i2" if small else "<f8").tobytes() + b"".join(c.astype("<i8").tobytes() for c in columns)


def unpack(payload, columns: int) -> tuple[np.ndarray, ...]:
    n, width, small = struct.unpack_from("<III", payload)
    matrix = np.frombuffer(payload, "<i2" if small else "<f8", n * width, 12).reshape(n, width)
    at = 12 + matrix.nbytes
    return matrix, *[np.frombuffer(payload, "<i8", n, at + 8 * n * i) for i in range(columns)]


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _stacked(rows: list[np.ndarray]) -> np.ndarray:
    """One matrix of vectors, or of matrices, that may differ in width."""
    rows = [r.reshape(1, -1) if r.ndim == 1 else r for r in rows]
    width = max((r.shape[1] for r in rows), default=0)
    return np.concatenate([_wide(r, width) for r in rows]) if rows else np.zeros((0, 0))


def pivots(vectors: DataFrame) -> np.ndarray:
    """Up to PIVOTS different vectors, each followed by the nearest of those left, so that neighbours in number are like."""
    found = vectors.select(F.xxhash64("vector").alias("h"), "vector").orderBy("h").limit(4 * PIVOTS).dropDuplicates(["h"]).orderBy("h").limit(PIVOTS).collect()
    drawn = _stacked([np.array(r.vector, np.float64) for r in found])
    chain, left = [], list(range(len(drawn)))
    while left:
        with np.errstate(all="ignore"):
            far = ((drawn[left] - drawn[chain[-1]]) ** 2).sum(1) if chain else np.zeros(len(left))
        chain.append(left.pop(int(np.argmin(far))))
    return drawn[chain]


def ordered(vectors: DataFrame) -> DataFrame:
    """(near, next, vec_id, asked, small, vector): each vector's nearest pivots and its integers as bytes."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(pivots(vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = shared.value
        for batch in batches:
            rows = [v.values.to_numpy(zero_copy_only=False).astype(np.float64) for v in batch.column("vector")]
            matrix = _stacked(rows)
            width = max(matrix.shape[1], centre.shape[1])
            with np.errstate(all="ignore"):  # only the order depends on it
                near = _wide(matrix, width) @ _wide(centre, width).T - (centre * centre).sum(1) / 2
            two = np.zeros((len(rows), 2), np.int64)
            if near.shape[1] > 1:
                two = np.argsort(-near, 1, kind="stable")[:, :2] if near.shape[1] < 3 else _two_best(near)
            whole = [np.floor(r * SCALE) for r in rows]  # exact: a power of two
            small = [bool(np.abs(r).max(initial=0) < 1 << 15) for r in whole]
            data = [r.astype("<i2" if s else "<f8").tobytes() for r, s in zip(whole, small, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(two[:, 0].astype(np.int32)), pa.array(two[:, 1].astype(np.int32)), batch.column("vec_id"), batch.column("asked"), pa.array(small), pa.array(data, pa.binary())],
                ["near", "next", "vec_id", "asked", "small", "vector"],
            )

    return vectors.mapInArrow(tidy(run), "near int, next int, vec_id long, asked boolean, small boolean, vector binary")


def _two_best(score: np.ndarray) -> np.ndarray:
    pair = np.argpartition(-score, 1, axis=1)[:, :2]
    swap = np.take_along_axis(score, pair, 1)
    pair[swap[:, 0] < swap[:, 1]] = pair[swap[:, 0] < swap[:, 1]][:, ::-1]
    return pair


def sheets(vectors: DataFrame) -> DataFrame:
    """(part, nth, payload): SHEET vectors a row, in order. Payload: integers, vec_id, number of the row, whether asked."""
    keyed = ordered(vectors).withColumn("row", F.monotonically_increasing_id())
    order = ["near", "next", "vec_id", "row"]
    ranged = keyed.repartitionByRange(partitions_for(vectors, PART_BYTES), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        vectors, ids, asked = [], [], []

        def flush():
            number = (part << 40) + nth * SHEET + np.arange(len(ids))
            payload = pack(_stacked(vectors), np.array(ids), number, np.array(asked))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([payload], pa.binary())], ["part", "nth", "payload"])

        for batch in batches:
            for vec_id, flag, small, data in zip(batch.column("vec_id").to_pylist(), batch.column("asked").to_pylist(), batch.column("small").to_pylist(), batch.column("vector"), strict=True):
                ids.append(vec_id)
                asked.append(flag)
                vectors.append(np.frombuffer(data.as_buffer(), "<i2" if small else "<f8"))
                if len(ids) == SHEET:
                    yield flush()
                    vectors, ids, asked, nth = [], [], [], nth + 1
        if ids:
            yield flush()

    return cut(ranged.select("vec_id", "asked", "small", "vector").mapInArrow(tidy(run), "part int, nth int, payload binary"))


# ---------------------------------------------------------------- one sheet of queries, one of candidates


class BlockIndex:
    """Blocks of a sheet: forward index and, per component, greatest and least value. number: the rows' numbers, in order."""

    def __init__(self, matrix: np.ndarray, ids: np.ndarray, number: np.ndarray):
        self.matrix, self.ids, self.number = matrix, ids, number
        at = np.arange(0, len(ids), BLOCK)
        self.bounds = list(zip(at.tolist(), [*at[1:].tolist(), len(ids)], strict=True))
        self.high, self.low = np.maximum.reduceat(matrix, at, axis=0), np.minimum.reduceat(matrix, at, axis=0)

    def search(self, queries: np.ndarray, number: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each query, whose row has that number: ids and scores of its k best of at least floor (id -1: none), ties to
        the smaller id; and how many pairs of a query and a block were scored."""
        width = max(self.matrix.shape[1], queries.shape[1])
        size = float(np.abs(self.matrix.astype(np.float64)).max(initial=0)) * float(np.abs(queries.astype(np.float64)).max(initial=0)) * width
        if size >= 2.0**52:  # whole numbers of any size
            return *self._plain(queries, number, floor, k), len(queries) * len(self.bounds)
        kind = np.float32 if size < 2.0**24 else np.float64  # every sum on the way is exact
        matrix, q, high, low = (_wide(m, width).astype(kind) for m in (self.matrix, queries, self.high, self.low))
        bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        order = np.argsort(-bound, axis=1, kind="stable")
        best, best_id = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        kth, open_, scored = floor.copy(), np.arange(len(q)), 0
        for turn in range(len(self.bounds)):
            block = order[open_, turn]
            live = bound[open_, block] >= kth[open_]
            open_, block = open_[live], block[live]
            if not len(open_):
                break
            scored += len(open_)
            by = np.argsort(block, kind="stable")
            for rows in np.split(open_[by], np.flatnonzero(np.diff(block[by])) + 1):
                a, b = self.bounds[order[rows[0], turn]]
                score = q[rows] @ matrix[a:b].T
                own = np.flatnonzero((number[rows] >= self.number[a]) & (number[rows] <= self.number[b - 1]))
                score[own, number[rows[own]] - self.number[a]] = -np.inf
                hit = np.flatnonzero((score >= kth[rows, None]).any(1))
                if not len(hit):
                    continue
                rows, score = rows[hit], score[hit].astype(np.float64)
                score[score < kth[rows, None]] = -np.inf
                both = np.concatenate([best[rows], score], 1)
                names = np.concatenate([best_id[rows], np.broadcast_to(self.ids[a:b], score.shape)], 1)
                pick = np.lexsort((names, -both), axis=1)[:, :k]
                best[rows], best_id[rows] = np.take_along_axis(both, pick, 1), np.take_along_axis(names, pick, 1)
                kth[rows] = np.maximum(kth[rows], best[rows, k - 1])
        return np.where(best > -np.inf, best_id, -1), best, scored

    def _plain(self, queries, number, floor, k):
        whole = [[int(x) for x in row] for row in self.matrix]
        ids, best = np.full((len(queries), k), -1, np.int64), np.full((len(queries), k), None, object)
        for i, (own, row) in enumerate(zip(number, queries, strict=True)):
            v = [int(x) for x in row]
            found = sorted((-sum(x * y for x, y in zip(v, c, strict=False)), int(name)) for name, n, c in zip(self.ids, self.number, whole, strict=True) if n != own)
            for j, (score, name) in enumerate([x for x in found if -x[0] >= floor[i]][:k]):
                ids[i, j], best[i, j] = name, -score
        return ids, best


# ---------------------------------------------------------------- Spark


def _found(queries: tuple, ids: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, query_id, vec_id, score) of what a search has found. vec_ids may be negative, so a score tells."""
    there = np.array([[x is not None and x > -np.inf for x in row] for row in best]).reshape(best.shape) if best.dtype == object else best > -np.inf
    i, j = np.nonzero(there)
    return queries[2][i], queries[1][i], ids[i, j], np.array([int(x) for x in best[i, j]], np.int64)


def query_sheets(data: DataFrame, k: int) -> DataFrame:
    """(q, payload) of the rows asked for, up to SHEET a row. Payload: integers, vec_id, number, and a kth score that the
    query's own sheet assures (the least long: none)."""
    none = np.iinfo(np.int64).min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, n = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            payload = pack(_stacked([h[0] for h in held]), *[np.concatenate([h[i] for h in held]) for i in (1, 2, 3)])
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + nth], pa.int64()), pa.array([payload], pa.binary())], ["q", "payload"])

        for batch in batches:
            for payload in batch.column("payload"):
                matrix, ids, number, asked = unpack(payload.as_buffer(), 3)
                mine = np.flatnonzero(asked)
                if not len(mine):
                    continue
                if n + len(mine) > SHEET:
                    yield flush()
                    held, n, nth = [], 0, nth + 1
                _, best, _ = BlockIndex(matrix, ids, number).search(matrix[mine], number[mine], np.full(len(mine), -np.inf), k)
                kth = [none if x is None or x == -np.inf else int(x) for x in best[:, k - 1]]
                held.append((matrix[mine], ids[mine], number[mine], np.array(kth, np.int64)))
                n += len(mine)
        if held:
            yield flush()

    return cut(data.select("payload").mapInArrow(tidy(run), "q long, payload binary"))


def _pairs(vectors: DataFrame, query: Column, k: int, vector: str) -> DataFrame:
    """(q, queries, candidates): every query sheet with every sheet, those of one bucket in one task."""
    bound_batches(vectors.sparkSession)
    rows = fields(vectors, "vec_id", vector).withColumn("asked", F.coalesce(query, F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col(f"`{vector}`")))
    data = sheets(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), "asked"))
    asked = query_sheets(data, k)
    last = data.agg(F.max("part").alias("part"), F.max("nth").alias("nth")).first()
    per_part = (last.nth or 0) // BUCKET + 1
    bucket = F.col("part").cast("long") * per_part + F.floor(F.col("nth") / BUCKET)
    # the stated queries against all rows, in blocks: each query sheet goes to each bucket once
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(((last.part or 0) + 1) * per_part - 1).cast("long"))
    sent = asked.select("q", F.col("payload").alias("queries"), F.explode(numbers).alias("bucket"))
    return sent.join(data.select(bucket.alias("bucket"), F.col("payload").alias("candidates")), "bucket").select("q", "queries", "candidates")


def _searched(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple, np.ndarray, np.ndarray, int, int]]:
    """Of each pair of sheets: q, the queries, what was found, and how many pairs of a query and a block there are and were scored."""
    kth: dict[int, np.ndarray] = {}
    for batch in batches:
        for q, asked, sheet in zip(batch.column("q").to_pylist(), batch.column("queries"), batch.column("candidates"), strict=True):
            queries, ids, number, first = unpack(asked.as_buffer(), 3)
            floor = kth.pop(q, None)
            if floor is None:
                floor = np.where(first == np.iinfo(np.int64).min, -np.inf, first.astype(np.float64))
                floor[np.abs(floor) > 2.0**52] = -np.inf  # not exact as a double
            index = BlockIndex(*unpack(sheet.as_buffer(), 3)[:3])
            found, best, scored = index.search(queries, number, floor, k)
            if best.dtype != object:
                floor = np.maximum(floor, best[:, k - 1])
            kth[q] = floor
            if len(kth) > REMEMBERED:
                kth.pop(next(iter(kth)))
            yield q, (queries, ids, number), found, best, len(queries) * len(index.bounds), scored


def top_k(vectors: DataFrame, query: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of every row for which query holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, asked, ids, best, _, _ in _searched(k, batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _found(asked, ids, best)], ["number", "query_id", "vec_id", "score"])

    best = _pairs(vectors, query, k, vector).mapInArrow(tidy(run), "number long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def pruning(vectors: DataFrame, query: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """(pairs, scored): how many pairs of a query and a block there are, and how many of them were scored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, pairs, scored in _searched(k, batches):
            yield pa.RecordBatch.from_arrays([pa.array([pairs], pa.int64()), pa.array([scored], pa.int64())], ["pairs", "scored"])

    rows = _pairs(vectors, query, k, vector).mapInArrow(tidy(run), "pairs long, scored long")
    return rows.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("scored"), F.lit(0)).alias("scored"))
