"""Exact top-k search by a three-phase uniform threshold (operator 8).

Components become integers floor(scale * x). A score is the inner product; it is the sum of partial scores over slices
of the dimensions, one list for each slice.

1. Every partition gathers the ends of its local lists: of each component the entries that are highest and lowest, whatever
   the queries. These few are scored in full. The k-th highest score of a partition's entries is one that k entries reach,
   so the highest such number over all partitions is a safe cutoff: the answer has no lower score.
2. The cutoff is broadcast. Lists are then collected one after another. An entry can reach the cutoff only if some list
   gives it cutoff / lists or more; hence once the lists seen so far, with the most that the others can give it (the product
   of the norms), don't make up the cutoff, the entry is left out of all further lists.
3. Of the entries that are left the remaining partial scores are resolved, exactly; those at the cutoff or above compete. A
   task raises its cutoff when it has found k better ones.

Queries are taken in blocks of at most ``query_block`` rows, so that what is broadcast has a fixed bound, against all
candidates; a block costs two scans. A partition returns k entries for each query at most, ties included, whatever the
number of equal vectors.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a null id, take no part;
missing components of a shorter vector count as 0; a candidate with the query's own id is left out; ties go to the
smaller id; repeated candidate rows compete each; equal query rows are one query; sums are exact whatever the size of
the components, and scores beyond a long are held at its ends and rank as such; an empty table gives an empty table;
only the first two columns are read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

SCHEMA = "query_id long, rank int, vec_id long, score long"
#: Candidates and queries that are multiplied at once.
ROWS, TILE = 2048, 512
#: Rows of a partition for each one that is scored in phase 1.
ENDS = 16
#: The share of pairs up to which the next list is computed pair by pair.
SPARSE = 0.125
_LOW = -(2**63)


def integers(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the matrix of floor(scale * x) as exact doubles, of the rows that take part."""
    ids, vectors = batch.column(0), batch.column(1)
    ids = np.array([-1 if i is None else i for i in ids.to_pylist()], np.int64) if ids.null_count else ids.to_numpy(zero_copy_only=False).astype(np.int64)
    good = ~np.asarray(batch.column(0).is_null()) & ~np.asarray(vectors.is_null())
    lists = vectors.fill_null([]) if vectors.null_count else vectors
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
    out = np.zeros((len(ids), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(ids)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    finite = np.isfinite(out).all(axis=1) if out.size else np.ones(len(ids), bool)
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.floor(scale * out)
    good &= finite & (np.isfinite(out).all(axis=1) if out.size else True)
    return ids[good], out[good]


def _wide(m: np.ndarray, d: int) -> np.ndarray:
    return m[:, :d] if m.shape[1] >= d else np.pad(m, ((0, 0), (0, d - m.shape[1])))


def _exact(q: np.ndarray, v: np.ndarray) -> bool:
    """Whether doubles hold all sums."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1]) < 2**53


def _whole(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """All scores, as longs; those beyond a long are held at its ends."""
    if _exact(q, v):
        return (q @ v.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    held = np.frompyfunc(lambda x: max(_LOW, min(2**63 - 1, int(x))), 1, 1)
    return held(np.dot(whole(q), whole(v.T))).astype(np.int64).reshape(len(q), len(v)) if q.shape[1] else np.zeros((len(q), len(v)), np.int64)


def reached(q: np.ndarray, v: np.ndarray, cut: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """All pairs (query, candidate) whose score reaches the query's cutoff, their scores, and the multiplications it took."""
    n, d = len(q) * len(v), q.shape[1]
    if not _exact(q, v) or not d:
        scores = _whole(q, v)
        a, b = np.nonzero(scores >= cut[:, None])
        return a, b, scores[a, b], n * d
    ends = [d * j // lists for j in range(1, lists + 1)]
    most = [(np.linalg.norm(q[:, e:], axis=1) * (1 + 1e-9), np.linalg.norm(v[:, e:], axis=1)) for e in ends]
    floor = cut.astype(np.float64) * (1 - 2e-16 * np.sign(cut)) - 1  # rounded down
    sums, done, cost = q[:, : ends[0]] @ v[:, : ends[0]].T, ends[0], n * ends[0]
    a, b = np.nonzero(sums + most[0][0][:, None] * most[0][1][None, :] >= floor[:, None])
    for j in range(1, lists):
        span = slice(done, ends[j])
        if len(a) > SPARSE * n:  # nearly all are left: one product
            sums += q[:, span] @ v[:, span].T
            cost += n * (ends[j] - done)
            left = sums[a, b]
        else:
            left = sums[a, b] + np.einsum("ij,ij->i", q[a, span], v[b, span])
            sums[a, b] = left
            cost += len(a) * (ends[j] - done)
        done = ends[j]
        high = left + most[j][0][a] * most[j][1][b] >= floor[a]
        a, b = a[high], b[high]
    scores = sums[a, b].astype(np.int64)
    high = scores >= cut[a]
    return a[high], b[high], scores[high], cost


def _wide(m: np.ndarray, d: int) -> np.ndarray:
    return m[:, :d] if m.shape[1] >= d else np.pad(m, ((0, 0), (0, d - m.shape[1])))


class _Best:
    """The k best (score, id) of each query, and the cutoffs that follow."""

    def __init__(self, cut: np.ndarray, k: int):
        self.k, self.cut = k, cut.copy()
        self.of, self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, of: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        of, scores, ids = np.concatenate([self.of, of]), np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        by = np.lexsort((ids, ~scores, of))  # ~x falls as x rises, without overflow
        of, scores, ids = of[by], scores[by], ids[by]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        last = place == self.k - 1
        self.cut[of[last]] = np.maximum(self.cut[of[last]], scores[last])
        keep = place < self.k
        self.of, self.scores, self.ids = of[keep], scores[keep], ids[keep]


def _matrices(batches: Iterator[pa.RecordBatch], d: int, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            ids, v = integers(batch.slice(at, ROWS), scale)
            if len(ids):
                yield ids, _wide(v, d)


def _cutoffs(query_ids: np.ndarray, queries: np.ndarray, k: int, scale: float):
    """Phase 1: for each query the k-th highest score among the entries at the ends of the partition's lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = queries.shape[1]
        best, rows = _Best(np.full(len(query_ids), _LOW), k), 0
        for ids, v in _matrices(batches, d, scale):
            rows += len(ids)
            each = max(1, len(ids) // (2 * max(1, d) * ENDS))  # entries of an end
            ends = np.argpartition(v, [min(each, len(v)) - 1, max(0, len(v) - each)], axis=0) if d else np.zeros((len(v), 0), np.int64)
            some = np.unique(np.concatenate([ends[:each].ravel(), ends[-each:].ravel()]))[: max(k + 1, len(ids) // ENDS)]
            for at in range(0, len(queries), TILE):
                scores = _whole(queries[at : at + TILE], v[some])
                a, b = np.nonzero((scores > best.cut[at : at + TILE, None]) & (query_ids[at : at + TILE, None] != ids[some][None, :]))
                best.offer(a + at, scores[a, b], ids[some][b])
        found = np.flatnonzero(best.cut > _LOW)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(best.cut[found], pa.int64())], ["q", "cut"])

    return run


def _resolved(query_ids: np.ndarray, queries: np.ndarray, cut: np.ndarray, k: int, lists: int, scale: float):
    """Phases 2 and 3: the k best of a partition's entries that reach the cutoffs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(cut, k)
        for ids, v in _matrices(batches, queries.shape[1], scale):
            for at in range(0, len(queries), TILE):
                a, b, scores, _ = reached(queries[at : at + TILE], v, best.cut[at : at + TILE], lists)
                other = query_ids[at + a] != ids[b]
                if other.any():
                    best.offer(at + a[other], scores[other], ids[b[other]])
        yield pa.RecordBatch.from_arrays([pa.array(query_ids[best.of], pa.int64()), pa.array(best.of, pa.int32()), pa.array(best.ids, pa.int64()), pa.array(best.scores, pa.int64())], ["query_id", "q", "vec_id", "score"])

    return run


def exact_top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, lists: int = 4, query_block: int = 16384, run: scratch.Run | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score). Both inputs have an id and a vector as their first two columns."""
    spark, run = candidates.sparkSession, run or scratch.Run(candidates.sparkSession)
    candidates = candidates.select(*candidates.columns[:2])
    queries = queries.select(F.col(queries.columns[0]).alias("id"), F.col(queries.columns[1]).alias("vector")).where("id is not null").distinct()
    queries = run.keep(queries, "queries")
    n = queries.count()
    blocks = math.ceil(n / query_block)
    block = F.pmod(F.xxhash64("id", "vector"), F.lit(max(1, blocks)))
    found = []
    for b in range(blocks):
        table = queries.where(block == b).orderBy("id").toArrow()  # about query_block rows
        query_ids, matrix = integers(table.combine_chunks().to_batches()[0], scale) if table.num_rows else (np.zeros(0, np.int64), None)
        if not len(query_ids):
            continue
        cuts = candidates.mapInArrow(_cutoffs(query_ids, matrix, k, scale), "q int, cut long").groupBy("q").agg(F.max("cut").alias("cut"))
        cut = np.full(len(query_ids), _LOW)
        for row in cuts.collect():  # one number for each query of the block
            cut[row["q"]] = row["cut"]
        best = candidates.mapInArrow(_resolved(query_ids, matrix, cut, k, lists, scale), "query_id long, q int, vec_id long, score long")
        order = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
        top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found.append(run.keep(top, "topk") if blocks > 1 else top)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], SCHEMA)
