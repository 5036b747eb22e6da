"""Sharding by a k-d tree over document metadata.

A node that stands for several shards is cut in two along its widest dimension, at the value
that splits its bytes in the ratio of the shards on both sides; leaves hold the target bytes
each. All nodes of a level are cut together. Medians come from histograms: one of the whole
node, then one of the bin that the cut falls in, until a bin holds less than the tolerance. A
histogram has a fixed number of bins per node, so what the driver sees does not grow with the
documents, and the documents themselves are never sorted by one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import ROWS_PER_BUCKET, running_totals, stored

SHARDS = 24
#: Bins of a histogram, rounds of refinement, and the share of a shard a cut may be off by.
BINS = 512
ROUNDS = 6
TOLERANCE = 1e-4
#: Bins narrower than this hold no two different points.
FINEST = 2.0 ** -42


@dataclass(frozen=True)
class Cut:
    """Rows of a node with a value below `at` in the dimension go left."""

    node: int
    dimension: str
    at: float


def spread(value: Column, place: Column, ordinal: Column) -> Column:
    """Whole numbers as points of a line: equal ones lie apart by 41 bits in [0, 1).

    Of these, 24 are a hash of the row's content, so that they do not depend on where a row lies. The
    last 17 come from its ordinal: rows that are equal altogether lie side by side, and a cut may
    fall between them.
    """
    def bits(seed: str, hashed: Column, many: int) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), hashed), 64 - many).cast("double")

    return (value.cast("double") + bits("spread", place, 24) / F.lit(2.0 ** 24)
            + bits("copies", ordinal, 17) / F.lit(2.0 ** 41))


def dimensions(docs: DataFrame) -> dict[str, Column]:
    """The metadata a document is placed by, each as a whole number.

    The hash ring of source and of lang keeps rows of one source or language together; the
    logarithm of the size separates short from long documents.
    """
    def ring(name: str) -> Column:
        return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")),
                      F.lit(4096))

    found = {"by_size": F.floor(F.log2(F.col("size").cast("double")) * 64)}
    for name in ("source", "lang"):
        if name in docs.columns:
            found[f"by_{name}"] = ring(name)
    return found


def by_node(values: dict[int, float], otherwise: float = 0.0) -> Column:
    """A number for each of a bounded set of nodes."""
    pairs = [x for node, value in sorted(values.items()) for x in (F.lit(node), F.lit(float(value)))]
    if not pairs:
        return F.lit(float(otherwise))
    return F.coalesce(F.create_map(*pairs)[F.col("node")], F.lit(float(otherwise)))


def axis_of(chosen: dict[int, str], names: list[str]) -> Column:
    """The value of the dimension that was chosen for a row's node; null where none was."""
    return reduce(lambda other, name: F.when(
        F.col("node").isin([n for n, x in sorted(chosen.items()) if x == name]), F.col(name))
        .otherwise(other), names, F.lit(None).cast("double"))


def widest(points: DataFrame, names: list[str], whole: dict[str, tuple[float, float]]) -> dict:
    """The widest dimension of every node, measured by the extent of the whole table."""
    seen = points.groupBy("node").agg(
        F.sum("size").alias("bytes"),
        *(x for n in names for x in (F.min(n).alias(f"{n}_low"), F.max(n).alias(f"{n}_high"))))
    found = {}
    for row in seen.collect():  # one row per node, at most as many as shards
        width = {n: (row[f"{n}_high"] - row[f"{n}_low"]) / max(whole[n][1] - whole[n][0], 1e-9)
                 for n in names}
        name = max(names, key=lambda n: width[n])
        found[row["node"]] = (name, row[f"{name}_low"], row[f"{name}_high"], row["bytes"])
    return found


def cuts_of(points: DataFrame, names: list[str], shards: dict[int, int],
            whole: dict[str, tuple[float, float]], tolerance: float) -> dict[int, Cut]:
    """Cut every node that stands for more than one shard at its weighted median."""
    nodes = {n: x for n, x in widest(points, names, whole).items() if shards[n] > 1}
    aim = {n: x[3] * (shards[n] // 2) / shards[n] for n, x in nodes.items()}
    spans = {n: (x[1], x[2] + 1e-9) for n, x in nodes.items()}
    below = dict.fromkeys(nodes, 0.0)
    chosen: dict[int, float] = {}
    axis = axis_of({n: x[0] for n, x in nodes.items()}, names)
    for _ in range(ROUNDS):
        chosen |= {n: s[0] for n, s in spans.items() if n not in chosen and (s[1] - s[0]) / BINS < FINEST}
        active = {n: s for n, s in spans.items() if n not in chosen}
        if not active:
            break
        low = by_node({n: s[0] for n, s in active.items()})
        step = by_node({n: (s[1] - s[0]) / BINS for n, s in active.items()}, 1.0)
        bins = (points.where(F.col("node").isin(sorted(active))).withColumn("axis", axis)
                .withColumn("bin", F.floor((F.col("axis") - low) / step))
                .where(f"bin >= 0 and bin < {BINS}")
                .groupBy("node", "bin").agg(F.sum("size").alias("bytes")).collect())
        for n, (start, stop) in active.items():
            width, total = (stop - start) / BINS, below[n]
            mine = sorted((r["bin"], r["bytes"]) for r in bins if r["node"] == n)
            at = stop
            for number, held in mine:
                if total + held > aim[n]:
                    at = start + width * number
                    if held <= tolerance * aim[n] / max(1, shards[n] // 2):
                        chosen[n] = at if aim[n] - total <= total + held - aim[n] else at + width
                    break
                total += held
            below[n] = total
            spans[n] = (at, at + width)
    for n in nodes:
        chosen.setdefault(n, spans[n][0])
    return {n: Cut(n, nodes[n][0], at) for n, at in chosen.items()}


def shard_points(points: DataFrame, names: list[str], shards: int = SHARDS,
                 tolerance: float = TOLERANCE) -> DataFrame:
    """Add `shard` to rows with size and dimensions; as many nodes as shards at the end."""
    extent = points.agg(*(x for n in names for x in (F.min(n).alias(f"{n}_low"),
                                                     F.max(n).alias(f"{n}_high")))).first()
    if extent[0] is None:
        return points.withColumn("shard", F.lit(0))
    whole = {n: (extent[f"{n}_low"], extent[f"{n}_high"]) for n in names}
    points = points.withColumn("node", F.lit(0))
    standing = {0: shards}  # a node's number is that of its first shard
    while any(n > 1 for n in standing.values()):
        cuts = cuts_of(points, names, standing, whole, tolerance)
        beyond = (axis_of({n: c.dimension for n, c in cuts.items()}, names)
                  >= by_node({n: c.at for n, c in cuts.items()}))
        step = by_node({n: standing[n] // 2 for n in cuts}).cast("int")
        # Stored level by level, or each level's expression would hold all before it.
        points = stored(points.withColumn("node", F.col("node") + F.when(beyond, step).otherwise(0)))
        grown: dict[int, int] = {}
        for node, count in standing.items():
            if count > 1:
                grown[node], grown[node + count // 2] = count // 2, count - count // 2
            else:
                grown[node] = count
        standing = grown
    return points.withColumnRenamed("node", "shard")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Contract of op7 under the law of near-equal bytes.

    doc_id, size (UTF-8 bytes of the text, null: none, plus 8), text_crc32, law, shard, slot and
    grown_shard (null). Every row gets a shard, repeated rows and null ids too; equal texts may
    lie in several shards, since one group of copies may outweigh a shard, and rows that are equal
    altogether are dealt by their ordinal in the table. An empty table gives no rows. Columns other than doc_id, text, source and lang are ignored.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    meta = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        *(F.col(c) for c in ("source", "lang") if c in docs.columns))
    found = dimensions(docs)
    place = F.xxhash64("doc_id", "text_crc32", "size")
    meta = meta.withColumns({"_place": place, "_ordinal": F.monotonically_increasing_id()})
    points = stored(meta.select("doc_id", "size", "text_crc32", "_place", "_ordinal", *(
        spread(value, F.xxhash64(F.lit(name), "_place"), F.col("_ordinal")).alias(name)
        for name, value in found.items())))
    rows = shard_points(points, sorted(found), shards)
    rows = rows.select("doc_id", "size", "text_crc32", F.col("shard").cast("int"), "_place", "_ordinal")
    count = points.count()
    buckets = max(1, -(-count // (shards * ROWS_PER_BUCKET)))
    rows = (rows.withColumn("_one", F.lit(1))
            .withColumn("_bucket", F.pmod(F.xxhash64("_place", "_ordinal"), F.lit(buckets))))
    rows = running_totals(rows, ["shard"], "_bucket", ["_place", "_ordinal"], "_one", "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
