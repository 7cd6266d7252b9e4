"""Exact top-k search by vector-approximation blocks.

Vectors become integers and are stored in blocks of bounded size with their approximation: per dimension one of
``CELLS`` equal cells between the block's least and largest value, a byte each. A scan of the cells bounds every
inner product from both sides; exact vectors, in the narrowest integers that hold the block, are then read in
order of their bound until the k-th result is certain, that is until no unread vector's bound reaches it.

Queries go in blocks of at most ``QUERY_BYTES``. Each block of queries meets each group of candidate blocks
once: queries are copied to the groups, candidate blocks to the query blocks, and a task streams its candidate
blocks past one block of queries, keeping k results per query, whatever many candidates are equal or nearly so.
Those are merged by query. What is copied is candidates times query blocks, so these are as large as a task can hold.

Defined results: a null vector, one with a null or non-finite component, and a row without id take no
part; components are clipped to 62 bits and scores to 64. Vectors of different length are not compared.
Rows with the query's id are its own. A repeated row is a candidate each time and one query. Equal
scores rank by id. Fewer candidates than k give fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common

CELLS = 256
BLOCK = 1024
BLOCK_BYTES = 4 << 20
QUERY_BYTES = 16 << 20
_LARGEST = 2**62
_BLOCK_SCHEMA = "dim int, n int, ids binary, cells binary, low binary, step binary, exact binary"
_FOUND = "query_id long, query_key long, vec_id long, score long"


def _valid(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def integers(rows: DataFrame) -> DataFrame:
    """vec_id and v: components times 256, rounded down, of the rows that take part; key tells vectors apart."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.least(F.greatest(F.floor(x * 256).cast("double"), F.lit(-float(_LARGEST))), F.lit(float(_LARGEST))).cast("long"))
    return rows.where(F.col("vec_id").isNotNull() & _valid(F.col("embedding").cast("array<double>"))).select("vec_id", scaled.alias("v"))


def _block(dim: int, ids: np.ndarray, exact: np.ndarray) -> list:
    low, high = exact.min(axis=0).astype(np.float64), exact.max(axis=0).astype(np.float64)
    step = np.maximum((high - low) / CELLS, 1e-9)
    cells = np.minimum((exact - low) / step, CELLS - 1).astype(np.uint8)
    return [dim, len(ids), ids.tobytes(), cells.tobytes(), low.tobytes(), step.tobytes(), exact.astype(_narrowest(exact)).tobytes()]


def _narrowest(exact: np.ndarray) -> np.dtype:
    """The smallest signed integers that hold all of ``exact``."""
    return np.promote_types(np.min_scalar_type(min(int(exact.min(initial=0)), -1)), np.min_scalar_type(min(-1, ~int(exact.max(initial=0)))))


def _blocked(size: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        rows_of = lambda dim: max(1, min(size, BLOCK_BYTES // max(1, 8 * dim)))

        def emit(rows: list) -> pa.RecordBatch:
            types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[x.split()[0] for x in _BLOCK_SCHEMA.split(", ")])

        def full(dim: int, least: int | None = None) -> Iterator[pa.RecordBatch]:
            ids, exact = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            n = rows_of(dim)
            while len(ids) >= (n if least is None else least) and len(ids):
                yield emit([_block(dim, ids[:n], exact[:n])])
                ids, exact = ids[n:], exact[n:]
            if len(ids):
                waiting[dim] = [(ids, exact)]

        for batch in batches:
            vectors = batch.column(1)
            n = np.diff(vectors.offsets.to_numpy())
            flat, ids = vectors.flatten().to_numpy(zero_copy_only=False), batch.column(0).to_numpy(zero_copy_only=False)
            first = np.cumsum(n) - n
            for dim in np.unique(n).tolist():
                at = np.flatnonzero(n == dim)
                waiting.setdefault(dim, []).append((ids[at], flat[first[at][:, None] + np.arange(dim)].reshape(len(at), dim)))
                if sum(len(x[0]) for x in waiting[dim]) >= rows_of(dim):
                    yield from full(dim)
        for dim in list(waiting):
            yield from full(dim, 1)

    return run


class _Queries:
    """A block of queries with the best results so far."""

    def __init__(self, dim: int, ids: np.ndarray, keys: np.ndarray, v: np.ndarray, k: int):
        self.dim, self.ids, self.keys, self.v, self.k = dim, ids, keys, v, k
        self.float, self.size = v.astype(np.float64), np.abs(v).astype(np.float64)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), best first

    def scan(self, ids: np.ndarray, cells: np.ndarray, low: np.ndarray, step: np.ndarray, exact: np.ndarray) -> None:
        middle = low + (cells + 0.5) * step
        near = self.float @ middle.T
        scale = self.size @ np.abs(middle).max(axis=0)
        off = self.size @ step / 2 + scale * 1e-12 + 1  # cells, rounding of these sums
        most = max(abs(int(exact.min(initial=0))), abs(int(exact.max(initial=0))))
        large = float(most) * float(self.size.max(initial=0)) * self.dim >= 2.0**53
        for q in range(len(self.ids)):
            upper = np.clip(near[q] + off[q], -(2.0**63), 2.0**63)  # as scores are
            others = np.flatnonzero(ids != self.ids[q])  # the query's own rows, however many, bound nothing
            certain = -np.inf
            if len(others) >= self.k:
                certain = np.clip(np.partition(near[q][others], len(others) - self.k)[len(others) - self.k] - off[q], -(2.0**63), 2.0**63)
            if len(self.best[q]) == self.k:
                certain = max(certain, -self.best[q][-1][0])
            left = others[upper[others] >= certain]
            left = left[np.argsort(-upper[left])]
            for at in range(0, len(left), 64):
                some = left[at : at + 64]
                if len(self.best[q]) == self.k and upper[some[0]] < -self.best[q][-1][0]:
                    break
                if large:
                    mine = [int(x) for x in self.v[q]]
                    scores = [max(-(2**63), min(2**63 - 1, sum(a * int(b) for a, b in zip(mine, exact[i])))) for i in some]
                else:
                    scores = (exact[some].astype(np.int64) @ self.v[q]).tolist()
                found = [(-s, i) for s, i in zip(scores, ids[some].tolist())]
                self.best[q] = sorted(self.best[q] + found)[: self.k]

    def rows(self) -> pa.RecordBatch:
        flat = [(int(self.ids[q]), int(self.keys[q]), i, -s) for q, best in enumerate(self.best) for s, i in best]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*flat) if flat else [[]] * 4)], names=[x.split()[0] for x in _FOUND.split(", ")])


def _met(k: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, open_key = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]  # one block at a time as Python bytes
                dim, key = row["dim"], (row["dim"], row["side"], row["group"])
                view = lambda name, kind, row=row: np.frombuffer(row[name], dtype=kind)
                shaped = lambda name, kind, row=row, dim=dim: view(name, kind).reshape(row["n"], dim)
                if key != open_key:
                    if queries is not None:
                        yield queries.rows()
                    queries, open_key = None, key
                if row["is_query"]:
                    queries = _Queries(dim, view("ids", np.int64), view("cells", np.int64), shaped("exact", np.int64), k)
                elif queries is not None:
                    width = len(row["exact"]) // max(1, row["n"] * dim)
                    queries.scan(view("ids", np.int64), shaped("cells", np.uint8), view("low", np.float64), view("step", np.float64), shaped("exact", f"<i{width or 8}"))
        if queries is not None:
            yield queries.rows()

    return run


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block for each group of rows: the keys take the place of the cells."""
    for batch in batches:
        rows = [[r["dim"], r["side"], len(r["rows"]), *(np.array([x[c] for x in r["rows"]], dtype=np.int64).tobytes() for c in ("vec_id", "key", "v"))] for r in batch.to_pylist()]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["dim", "side", "n", "ids", "cells", "exact"])


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, query_key, rank, vec_id, score: the ``k`` largest inner products of each row of ``queries``.

    Both have vec_id and embedding.
    """
    spark = common.small_batches(candidates).sparkSession
    groups = common.partitions_for(spark)
    blocks = common.checkpointed(integers(candidates).mapInArrow(_blocked(BLOCK), _BLOCK_SCHEMA))
    asked = integers(queries).select("vec_id", "v", F.xxhash64("v").alias("key"), F.size("v").alias("dim")).dropDuplicates(["vec_id", "key"])
    size = asked.agg(F.coalesce(F.sum(F.lit(8) * (F.col("dim") + 2)), F.lit(0))).first()[0]
    sides = max(1, -(-size // QUERY_BYTES) * 2)  # by hash: about half full, so that each stays small
    dealt = asked.withColumn("side", F.pmod(F.xxhash64("vec_id", "key"), F.lit(sides))).groupBy("dim", "side").agg(F.collect_list(F.struct("vec_id", "key", "v")).alias("rows"))
    asked_blocks = common.checkpointed(dealt.mapInArrow(_query_blocks, "dim int, side long, n int, ids binary, cells binary, exact binary"))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    nothing = F.lit(None).cast("binary")
    left = asked_blocks.select("dim", "side", every(groups).alias("group"), F.lit(True).alias("is_query"), "n", "ids", "cells", nothing.alias("low"), nothing.alias("step"), "exact")
    right = blocks.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups))).select("dim", every(sides).alias("side"), "group", F.lit(False).alias("is_query"), "n", "ids", "cells", "low", "step", "exact")
    both = left.unionByName(right).repartition(groups, "dim", "side", "group").sortWithinPartitions("dim", "side", "group", F.desc("is_query"))
    found = both.mapInArrow(_met(k), _FOUND)
    best = found.groupBy("query_id", "query_key").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))), 1, k).alias("best"))
    return best.select("query_id", "query_key", F.posexplode("best").alias("rank", "b")).select("query_id", "query_key", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))
