"""Approximate nearest neighbours by cross-polytope hashing.

Each table rotates the unit vectors by a fast pseudo-rotation (three rounds of random signs and
a Hadamard transform) and files a vector under the nearest signed axis, the coordinate that is
largest in size. A query looks up its several nearest axes in every table; all it finds there
is compared exactly. Bucket and query blocks are of bounded size, so a very common vector
fills more blocks instead of a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm.common import stored

TABLES = 12
PROBES = 8
#: Vectors of a bucket, or queries of a bucket, that one task compares at a time.
BLOCK = 8192
#: Parts of the whole table that a query with too few finds is compared to.
FALLBACK = 64


@dataclass(frozen=True)
class Rotations:
    """Signs of every table's pseudo-rotation, from a seed."""

    tables: int = TABLES
    seed: int = 20

    def coordinates(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        """The rotated vectors, table by table, padded to a power of two."""
        size = 1 << max(0, unit.shape[1] - 1).bit_length()
        signs = np.random.default_rng([self.seed, size]).choice([-1.0, 1.0], (self.tables, 3, size))
        for table in signs:
            y = np.zeros((len(unit), size))
            y[:, :unit.shape[1]] = unit
            for sign in table:
                y = hadamard(y * sign)
            yield y


def hadamard(y: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    rows, size = y.shape
    half = 1
    while half < size:
        y = y.reshape(rows, size // (2 * half), 2, half)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2)
        half *= 2
    return y.reshape(rows, size) / np.sqrt(size)


def signed_axes(y: np.ndarray, count: int) -> np.ndarray:
    """The nearest signed axes of each row, nearest first: 2 * axis + (1 if negative)."""
    count = min(count, 2 * y.shape[1])
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    if count == 1:
        return both.argmax(axis=1)[:, None]
    near = np.argpartition(-both, count - 1, axis=1)[:, :count]
    order = np.argsort(-np.take_along_axis(both, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1)


#: What makes a vector v comparable: no nulls, all finite, not zero.
COMPARABLE = ("id is not null and v is not null and size(v) > 0 "
              "and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
              "and exists(v, x -> x <> 0)")


def as_doubles(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
               keep: tuple[str, ...] = ()) -> DataFrame:
    return vectors.select(F.col(vec_id).cast("long").alias("id"),
                          F.col(embedding).cast("array<double>").alias("v"), *keep)


def usable(vectors: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, v (doubles), dim of the vectors that have a cosine, and the columns to keep."""
    return as_doubles(vectors, keep=keep).where(COMPARABLE).withColumn("dim", F.size("v"))


def unusable(vectors: DataFrame, otherwise: Column) -> DataFrame:
    """The other rows of the table: without a cosine, or for which a condition does not hold."""
    rows = vectors.withColumn("id", F.col("vec_id").cast("long")).withColumn(
        "v", F.col("embedding").cast("array<double>"))
    return rows.where(~(F.coalesce(F.expr(COMPARABLE), F.lit(False)) & otherwise)).drop("id", "v")


def addresses(rows: DataFrame, probes: int, rotations: Rotations) -> DataFrame:
    """id, v, dim and, for every table and probe, the bucket (table * 2^20 + signed axis)."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for low in range(0, part.num_rows, 4096):
                    some = part.slice(low, 4096)
                    unit = matrix(some.column(1))
                    unit = unit / np.abs(unit).max(axis=1, keepdims=True)
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    for table, y in enumerate(rotations.coordinates(unit)):
                        axes = signed_axes(y, probes)
                        which = np.repeat(np.arange(len(unit)), axes.shape[1])
                        yield pa.RecordBatch.from_arrays(
                            [some.column(0).take(pa.array(which)), some.column(1).take(pa.array(which)),
                             some.column(2).take(pa.array(which)),
                             pa.array((table << 20) + axes.ravel().astype(np.int64))],
                            names=["id", "v", "dim", "bucket"])

    return rows.mapInArrow(hashed, "id long, v array<double>, dim int, bucket long")


def best_of(ids: np.ndarray, base: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
            k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, cosines) of the k nearest others, ties to the smaller id.

    A matrix product finds them up to rounding; scores and ties are then settled by sums
    that do not depend on which vectors share a block.
    """
    b_norm, q_norm = np.sqrt((base * base).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    unit = base / b_norm[:, None]
    # An id with several vectors may come several times among the nearest; enough are looked at.
    most = k * int(np.unique(ids, return_counts=True)[1].max(initial=1))
    for low in range(0, len(queries), 256):
        part = queries[low:low + 256] / q_norm[low:low + 256, None]
        near = part @ unit.T
        near[query_ids[low:low + 256, None] == ids[None, :]] = -np.inf
        for i, row in enumerate(near):
            if len(row) > most:
                floor = np.partition(row, len(row) - most)[len(row) - most] - 1e-9
                at = np.flatnonzero((row >= floor) & (row > -np.inf))
            else:
                at = np.flatnonzero(row > -np.inf)
            q = low + i
            exact = (base[at] * queries[q]).sum(axis=1) / (b_norm[at] * q_norm[q])
            order = np.lexsort((ids[at], -exact))
            if most > k:
                order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])]
            yield int(query_ids[q]), ids[at][order[:k]], exact[order[:k]]


def _compared(k: int):
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            for query, ids, scores in best_of(
                    left.column("id").to_numpy(), matrix(left.column("v")),
                    right.column("id").to_numpy(), matrix(right.column("v")), k):
                out[0].append(np.full(len(ids), query))
                out[1].append(ids)
                out[2].append(scores)
        kinds = (np.int64, np.int64, np.float64)
        return pa.table({name: np.concatenate([np.zeros(0, kind), *got]) for name, got, kind in
                         zip(("query_id", "vec_id", "score"), out, kinds)})
    return compare


FOUND = "query_id long, vec_id long, score double"


def in_blocks(base: DataFrame, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """Compare the rows of both sides that share dim and bucket, block by block.

    Blocks are counted per bucket (as many as tables times axes), and each row of one side goes
    to every block of the other side of its bucket.
    """
    keys = ["dim", "bucket"]
    sizes = (base.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("rows"))
             .join(queries.groupBy(*keys).agg(
                 F.ceil(F.count(F.lit(1)) / block).cast("int").alias("asks")), keys))
    sizes = stored(sizes)
    left = (base.join(sizes, keys).withColumn("r", F.pmod(F.xxhash64("id"), "rows").cast("int"))
            .withColumn("a", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
            .drop("rows", "asks"))
    right = (queries.join(sizes, keys)
             .withColumn("a", F.pmod(F.xxhash64("id"), "asks").cast("int"))
             .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
             .drop("rows", "asks"))
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # apart from the left side
    by = [*keys, "r", "a"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_compared(k), FOUND)


def search(base: DataFrame, queries: DataFrame, k: int = 5, tables: int = TABLES,
           probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of base found for each query row.

    Both sides have id, v, dim (see `usable`). Rows of other dimensions are never compared; the
    rows with the query's own id are left out. Ties go to the smaller id. Equal rows count once;
    an id with several vectors has, as a query and as a candidate, the best score of any.
    A query that finds fewer than k in its buckets is compared to all rows instead, in blocks, so
    it returns k unless fewer exist. Empty sides give no rows.
    """
    base, queries = base.dropDuplicates(["id", "v"]), queries.dropDuplicates(["id", "v"])
    rotations = Rotations(tables)
    filed = in_blocks(stored(addresses(base, 1, rotations)),
                      stored(addresses(queries, probes, rotations)), k)
    found = stored(filed.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    full = found.groupBy("query_id").count().where(F.col("count") >= k)
    short = queries.join(full, F.col("id") == F.col("query_id"), "left_anti")
    whole = in_blocks(base.withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FALLBACK))),
                      short.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                      F.lit(FALLBACK - 1).cast("long")))), k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
            .unionByName(whole.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Contract of op2: the k nearest of every vector whose vec_id is divisible by 50."""
    rows = usable(vectors)
    return search(rows, rows.where(F.col("id") % every == 0), k)
