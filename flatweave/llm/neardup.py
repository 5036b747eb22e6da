"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are rotated to their principal components, the widest first. Within a label they
are laid out along the first component in tiles of bounded size; tiles further apart than the
threshold allows are never compared. For a pair of tiles the products of the leading dimensions
are accumulated first; what the rest can add is at most the product of the suffix norms, so most
pairs stop early. What is left is decided by the exact cosine of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.llm.ann import matrix, unusable, usable
from flatweave.llm.common import components, running_totals, stored

THRESHOLD = 0.93
#: Distinct vectors of a tile, and dimensions added before pairs are tested again.
TILE = 1024
STEP = 16
#: Rows of a tile compared at a time.
STRIP = 128
#: Parts of the first component's range that tasks order on their own.
SLICES = 256


def unit_rows(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def principal_axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """By dimension of the vectors: the axes in order of falling variance, as columns.

    Every task adds up outer products; what comes to the driver is one array for each of dim rows.
    """
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                unit = unit_rows(matrix(batch.filter(pa.array(dims == dim)).column(0)))
                sums[dim] = sums.get(dim, 0) + unit.T @ unit
        for dim, total in sums.items():
            yield _sums(dim, np.arange(dim), total)

    def added(table: pa.Table) -> pa.Table:
        total = matrix(table.column("sums")).sum(axis=0)
        return pa.Table.from_batches([_sums(table.column("dim")[0].as_py(),
                                            table.column("row")[:1].to_numpy(), total[None, :])])

    kinds = "dim int, row int, sums array<double>"
    totals = rows.select("v", "dim").mapInArrow(products, kinds).groupBy("dim", "row").applyInArrow(added, kinds)
    squares: dict[int, np.ndarray] = {}
    for dim, row, sums in totals.toLocalIterator():
        squares.setdefault(dim, np.zeros((dim, dim)))[row] = sums
    return {dim: np.linalg.eigh((x + x.T) / 2)[1][:, ::-1] for dim, x in squares.items()}


def _sums(dim: int, rows: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(np.arange(0, total.size + 1, dim, dtype=np.int32), total.ravel())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), dim, np.int32)),
                                       pa.array(rows.astype(np.int32)), lists], names=["dim", "row", "sums"])


def close_pairs(a: np.ndarray, b: np.ndarray, v_a: np.ndarray, v_b: np.ndarray,
                threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs whose cosine reaches the threshold; a, b rotated, v_a, v_b original."""
    dims = a.shape[1]
    marks = [*range(0, dims, STEP), dims]
    rest_a = {m: np.sqrt((a[:, m:] ** 2).sum(axis=1)) for m in marks}
    rest_b = {m: np.sqrt((b[:, m:] ** 2).sum(axis=1)) for m in marks}
    n_a, n_b = np.sqrt((v_a * v_a).sum(axis=1)), np.sqrt((v_b * v_b).sum(axis=1))
    floor = threshold - 1e-9  # rounding must not lose a pair
    for low in range(0, len(a), STRIP):
        strip = slice(low, low + STRIP)
        first = marks[1]
        so_far = a[strip, :first] @ b[:, :first].T
        i, j = np.nonzero(so_far + rest_a[first][strip, None] * rest_b[first][None, :] >= floor)
        got, i = so_far[i, j], i + low
        for start, stop in zip(marks[1:], marks[2:]):
            got = got + (a[i, start:stop] * b[j, start:stop]).sum(axis=1)
            open_ = got + rest_a[stop][i] * rest_b[stop][j] >= floor
            i, j, got = i[open_], j[open_], got[open_]
        exact = (v_a[i] * v_b[j]).sum(axis=1) / (n_a[i] * n_b[j])
        yield i[exact >= threshold], j[exact >= threshold]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n nodes with edges i, j the smallest node of each one's component."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _linked(threshold: float, axes: Broadcast):
    """Tiles come as original vectors; they are rotated where they are compared."""
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"id": np.zeros(0, np.int64), "links": np.zeros(0, np.int64),
                 "root": np.zeros(0, np.int64)}
        if left.num_rows and right.num_rows:
            same = left.column("tile")[0].as_py() == right.column("tile")[0].as_py()
            ids_a, ids_b = (t.column("id").to_numpy() for t in (left, right))
            many_a, many_b = (t.column("copies").to_numpy() for t in (left, right))
            turn = axes.value[left.column("dim")[0].as_py()]
            v_a, v_b = (matrix(t.column("v")) for t in (left, right))
            pairs = close_pairs(unit_rows(v_a) @ turn, unit_rows(v_b) @ turn, v_a, v_b, threshold)
            links_a, links_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
            ends_i, ends_j, held = [], [], 0
            ids = np.concatenate([ids_a, ids_b])
            order = np.argsort(ids, kind="stable")  # so that a root is the smallest id
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            for i, j in pairs:
                if same:
                    other = ids_a[i] != ids_b[j]
                    i, j = i[other], j[other]
                np.add.at(links_a, i, many_b[j])
                if not same:
                    np.add.at(links_b, j, many_a[i])
                ends_i.append(place[i])
                ends_j.append(place[len(ids_a) + j])
                held += len(i)
                if held > 1 << 20:  # keep a forest in place of the edges so far
                    label = forest(len(ids), np.concatenate(ends_i), np.concatenate(ends_j))
                    ends_i, ends_j, held = [np.arange(len(ids))], [label], len(ids)
            label = forest(len(ids), np.concatenate(ends_i), np.concatenate(ends_j))
            roots = ids[order][label][place]
            links = np.concatenate([links_a, links_b])
            some = np.flatnonzero(links > 0)
            found = {"id": ids[some], "links": links[some], "root": roots[some]}
        return pa.table(found)
    return compare


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Contract of op8: vec_id, n_links, component_id, kept of every row.

    Rows with a null label, or whose vector is null, empty, zero or not finite, link with nothing
    and are their own component; so do rows of different dimension. Every row counts as a vector,
    so repeated rows link with each other. A row without vec_id links with nothing, has no
    component and is not kept. Equal vectors of a label are compared once. Other columns are
    ignored; an empty table gives no rows.
    """
    keys = [F.xxhash64(F.lit(s), "label", "v").alias(f"key{s}") for s in (0, 1)]
    named = vectors.select("vec_id", "embedding", "label")
    good = usable(named.where("label is not null"), keep=("label",))
    members = good.select("id", *keys)
    reps = stored(good.select("id", "label", "v", "dim", *keys).groupBy("key0", "key1").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
        F.first("v").alias("v"), F.first("dim").alias("dim")))
    axes = reps.sparkSession.sparkContext.broadcast(principal_axes(reps))  # dim * dim numbers

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(4).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                first = unit_rows(matrix(part.column(3))) @ axes.value[int(dim)][:, 0]
                yield part.append_column("first", pa.array(first))

    laid = (reps.select("id", "copies", "label", "v", "dim")
            .mapInArrow(along, f"id long, copies long, label {dict(reps.dtypes)['label']}, "
                               "v array<double>, dim int, first double")
            .withColumn("slice", F.floor((F.col("first") + 1) * (SLICES / 2)))
            .withColumn("one", F.lit(1)))
    laid = running_totals(laid, ["label", "dim"], "slice", ["first", "id"], "one", "place")
    laid = stored(laid.withColumn("tile", F.floor(F.col("place") / TILE))
                  .select("id", "copies", "label", "dim", "tile", "v", "first"))

    # Tiles of a label whose ranges of the first component come near enough; one row per tile.
    tiles = laid.groupBy("label", "dim", "tile").agg(F.min("first").alias("low"),
                                                     F.max("first").alias("high"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    pairs = stored(
        tiles.select("label", "dim", F.col("tile").alias("left"), "high")
        .join(tiles.select("label", "dim", F.col("tile").alias("right"), "low"), ["label", "dim"])
        .where((F.col("left") <= F.col("right")) & (F.col("low") - F.col("high") <= reach))
        .select("label", "dim", "left", "right"))
    sides = [laid.withColumnRenamed("tile", side).join(pairs, ["label", "dim", side])
             .select(*(F.col(c).alias(c) for c in ("label", "dim", "left", "right")),
                     F.col(side).alias("tile"), *(F.col(c).alias(c) for c in ("id", "copies", "v")))
             for side in ("left", "right")]
    by = ["label", "dim", "left", "right"]
    found = stored(sides[0].groupBy(*by).cogroup(sides[1].groupBy(*by))
                   .applyInArrow(_linked(threshold, axes), "id long, links long, root long"))

    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = (reps.select("key0", "key1", "id", "copies").join(counts, "id", "left")
               .join(linked, "id", "left")
               .select("key0", "key1",
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component", "id").alias("component_id")))
    classed = members.join(classes, ["key0", "key1"]).select("id", "n_links", "component_id")
    alone = unusable(named, F.col("label").isNotNull())
    return (classed.select(F.col("id").alias("vec_id"), "n_links", "component_id")
            .unionByName(alone.select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                      F.col("vec_id").cast("long").alias("component_id")))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
