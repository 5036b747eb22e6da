"""Conversation prefix trie, with a count-min sketch that keeps lone tails out of the shuffle.

Each prefix of a conversation is a 128-bit digest. A count-min sketch of all digests never counts
too few, so a count of one proves that no other conversation has that prefix, nor any longer one
of the same conversation: the rest of it is a tail of lone nodes, made on the spot from its two
ends. Only prefixes that may be shared are shuffled and grouped exactly; a wrong guess of the
sketch costs a row in that shuffle, never a result.

A node is named by its smallest member. Along one conversation the nodes it names are the last
ones, so a sum over a subtree is a sum, over the members of its top, of what each member names,
less what the top's own member names above it. No step goes level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from flatweave.llm.common import running_totals, stored
from flatweave.llm.text import U64, mix

#: Turns of one conversation that one task orders at a time.
TURNS_PER_BUCKET = 4096
#: Rows of the sketch, cells of a row for each prefix, and the most cells of a row: 2 bits each,
#: so what is sent to the driver and broadcast stays below 48 MB.
SKETCH_ROWS = 3
CELLS_PER_PREFIX = 4
MOST_CELLS = 1 << 26
#: Cells that are merged together, and prefixes that one sketching task takes at least.
BLOCK = 1 << 16
#: Turns that a conversation takes over at most, and the period of the ids it takes them from.
HEAD_TURNS = 5
HEAD_EVERY = 100
#: Bytes of a list of ids that are hashed at a time.
CHUNK_BYTES = 1 << 16

NODE = ["depth", "d0", "d1"]


# Conversations as rows of turn hashes

def hashed_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, t0, t1, chars): position from 0, two hashes of role and text."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    # Texts are hashed first, so that only the one shuffle that orders the turns carries them.
    rows = rows.where("conv_id is not null").withColumns({
        "_one": F.lit(1), "t0": F.xxhash64(F.lit("a"), "role", "text"),
        "t1": F.xxhash64(F.lit("b"), "role", "text"), "chars": F.length("text").cast("long"),
        "_bucket": F.coalesce(F.floor(F.col("turn") / TURNS_PER_BUCKET), F.lit(-1 << 62))})
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = running_totals(rows, ["conv_id"], "_bucket", order, "_one", "position")
    return rows.select("conv_id", F.col("position").cast("long").alias("position"), "t0", "t1", "chars")


def with_heads(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations rebuilt: (conv_id, position, t0, t1, chars, length), (conv_id, length).

    The first h turns of conversation c are those of c - c % 100, fewer if it has fewer, none if
    it is absent; the own turns after the first h follow. h is crc32(c) % 6.
    """
    heads = (rows.where(f"conv_id % {HEAD_EVERY} = 0 and position < {HEAD_TURNS}")
             .groupBy(F.col("conv_id").alias("_head"))
             .agg(F.sort_array(F.collect_list(F.struct("position", "t0", "t1", "chars"))).alias("_turns")))
    convs = (rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_own"))
             .withColumn("_h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_TURNS + 1))
             .withColumn("_head", F.col("conv_id") - F.col("conv_id") % HEAD_EVERY))
    convs = convs.join(heads, "_head", "left").withColumn(
        "_turns", F.slice(F.coalesce("_turns", F.array().cast(heads.schema["_turns"].dataType)),
                          1, F.col("_h").cast("int")))
    convs = stored(convs.withColumn("_base", F.size("_turns").cast("long")).withColumn(
        "length", F.col("_base") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0)))
        .select("conv_id", "_h", "_base", "_turns", "length"))
    own = (rows.join(convs.select("conv_id", "_h", "_base", "length"), "conv_id").where("position >= _h")
           .select("conv_id", (F.col("position") - F.col("_h") + F.col("_base")).alias("position"),
                   "t0", "t1", "chars", "length"))
    taken = convs.select("conv_id", F.explode("_turns").alias("_t"), "length").select(
        "conv_id", "_t.*", "length")
    return own.unionByName(taken), convs.select("conv_id", "length")


def paths_of(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, d0, d1, p0, p1, chars, length): digests of each prefix and of the one before.

    A digest is the XOR of one hash per turn that also covers the turn's position. XOR needs no
    order, so a conversation of any length is added up in parts; the prefix before is the digest
    XOR the last turn's hash.
    """
    rows = rows.withColumn("_bucket", F.floor(F.col("position") / TURNS_PER_BUCKET))
    for i in (0, 1):
        rows = rows.withColumn(f"_x{i}", F.xxhash64(F.lit(f"turn{i}"), "position", "t0", "t1"))
    ahead = Window.partitionBy("conv_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "_bucket").agg(*(F.bit_xor(f"_x{i}").alias(f"_s{i}") for i in (0, 1)))
    sums = sums.select("conv_id", "_bucket", *(
        F.coalesce(F.bit_xor(f"_s{i}").over(ahead), F.lit(0)).alias(f"_b{i}") for i in (0, 1)))
    inside = Window.partitionBy("conv_id", "_bucket").orderBy("position").rowsBetween(
        Window.unboundedPreceding, 0)
    rows = rows.select("*", *(F.bit_xor(f"_x{i}").over(inside).alias(f"_i{i}") for i in (0, 1)))
    rows = rows.join(sums, ["conv_id", "_bucket"])
    return rows.select("conv_id", (F.col("position") + 1).alias("depth"),
                       *(F.expr(f"_b{i} ^ _i{i}").alias(f"d{i}") for i in (0, 1)),
                       *(F.expr(f"_b{i} ^ _i{i} ^ _x{i}").alias(f"p{i}") for i in (0, 1)),
                       "chars", "length")


# The sketch

def cells_of(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    """The cell of every digest in each row of the sketch."""
    d0, d1 = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
              for n in ("d0", "d1"))
    return [(mix(d0 + U64(2 * i + 1) * d1) & U64(width - 1)).astype(np.int64) for i in range(SKETCH_ROWS)]


def pack(cells: np.ndarray) -> bytes:
    """Counts 0, 1 and 2 (two or more) in 2 bits each."""
    four = cells.reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()


def unpack(body: bytes) -> np.ndarray:
    packed = np.frombuffer(body, dtype=np.uint8)
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


def sketched(paths: DataFrame, width: int) -> np.ndarray:
    """The packed sketch, one row of bytes for each row of cells; its size is bounded by width."""
    block = min(BLOCK, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((SKETCH_ROWS, width), dtype=np.uint8)
        for batch in batches:
            for row, cells in zip(held, cells_of(batch, width)):
                at, times = np.unique(cells, return_counts=True)
                row[at] = np.minimum(row[at] + np.minimum(times, 2), 2)
        out: list[list] = [[], [], [], [], []]
        for i, row in enumerate(held):
            for number, cells in enumerate(row.reshape(-1, block)):
                ones, twos = (np.flatnonzero(cells == n) for n in (1, 2))
                if len(ones) + len(twos):
                    thin = 2 * (len(ones) + len(twos)) < block // 4
                    for cell, value in zip(out, (
                            i, number, ones.astype("<u2").tobytes() if thin else None,
                            twos.astype("<u2").tobytes() if thin else None,
                            None if thin else pack(cells))):
                        cell.append(value)
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                         names=["row", "block", "ones", "twos", "cells"])

    def merged(table: pa.Table) -> pa.Table:
        total = np.zeros(block, dtype=np.uint8)
        for ones, twos, cells in zip(*(table.column(c) for c in ("ones", "twos", "cells"))):
            if cells.is_valid:
                total += unpack(cells.as_py())
            else:
                total[np.frombuffer(ones.as_py(), "<u2")] += 1
                total[np.frombuffer(twos.as_py(), "<u2")] += 2
            np.minimum(total, 2, out=total)
        return pa.table({"row": table.column("row")[:1], "block": table.column("block")[:1],
                         "cells": pa.array([pack(total)], pa.binary())})

    parts = (paths.select("d0", "d1")
             .mapInArrow(count, "row int, block int, ones binary, twos binary, cells binary")
             .groupBy("row", "block").applyInArrow(merged, "row int, block int, cells binary"))
    packed = np.zeros((SKETCH_ROWS, width // 4), dtype=np.uint8)
    for row, number, cells in parts.toLocalIterator():
        packed[row, number * block // 4:(number + 1) * block // 4] = np.frombuffer(cells, np.uint8)
    return packed


def screened(paths: DataFrame, width: int) -> DataFrame:
    """Add `alone`: the sketch counts the prefix once, so no other conversation has it."""
    sketch = paths.sparkSession.sparkContext.broadcast(sketched(paths, width))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = sketch.value
        for batch in batches:
            alone = np.zeros(batch.num_rows, dtype=bool)
            for row, cells in zip(packed, cells_of(batch, width)):
                alone |= (row[cells >> 2] >> (2 * (cells & 3)).astype(np.uint8) & 3) == 1
            yield batch.append_column("alone", pa.array(alone))

    return paths.mapInArrow(look, StructType([*paths.schema.fields, StructField("alone", BooleanType())]))


def sketch_width(prefixes: int, most: int = MOST_CELLS) -> int:
    """Cells of a row: a power of two that follows the prefixes up to the bound."""
    return min(most, max(1 << 10, 1 << (CELLS_PER_PREFIX * prefixes - 1).bit_length()))


# Lists of members, hashed

def id_lists(ends: DataFrame) -> DataFrame:
    """(depth, d0, d1, ends_sha256): hash of the ascending decimal ids of each node, joined by commas.

    Ids are sorted over all tasks and written as pieces of bounded size; a node's pieces are then
    hashed in order as they come, so a node with any number of ids needs the memory of one piece.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for *now, id_ in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key or size >= CHUNK_BYTES:
                    if held:
                        out.append((*key, first, ",".join(held)))
                    key, first, held, size = now, id_, [], 0
                    if len(out) >= 1024:
                        yield _piece_rows(out)
                        out = []
                held.append(str(id_))
                size += len(held[-1]) + 1
        if held:
            out.append((*key, first, ",".join(held)))
        yield _piece_rows(out)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *now, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now == key:
                    state.update(b",")
                else:
                    if state:
                        done.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                state.update(text.encode())
            yield _hash_rows(done)
        if state:
            yield _hash_rows([(*key, state.hexdigest())])

    order = [*NODE, "conv_id"]
    rows = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    texts = rows.mapInArrow(pieces, "depth long, d0 long, d1 long, first long, ids string")
    texts = texts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return texts.mapInArrow(hashes, "depth long, d0 long, d1 long, ends_sha256 string")


def _columns(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    cells = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=names)


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    return _columns(rows, [pa.int64()] * 4 + [pa.string()], [*NODE, "first", "ids"])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    return _columns(rows, [pa.int64()] * 3 + [pa.string()], [*NODE, "ends_sha256"])


# The trie

def trie(rows: DataFrame, convs: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """Nodes of rows (conv_id, position, t0, t1, chars, length) and conversations (conv_id, length).

    conv_id (smallest member), depth, d0 and d1 (the node's digest), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Without a conversation there is no node.
    """
    paths = stored(paths_of(rows))
    paths = stored(screened(paths, sketch_width(paths.count(), most_cells)))

    # Tails start at the first prefix that is proved to be alone.
    tails = stored(paths.where("alone").groupBy("conv_id").agg(
        F.min(F.struct("depth", "d0", "d1", "p0", "p1", "length")).alias("_t")).select("conv_id", "_t.*"))
    starts = tails.select("conv_id", F.col("depth").alias("_start"))
    shared = stored(paths.where("not alone").join(starts, "conv_id", "left")
                    .where("_start is null or depth < _start").drop("alone", "_start"))

    nodes = stored(shared.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p0").alias("p0"),
        F.min("p1").alias("p1"), F.max("chars").alias("chars")))
    tops = nodes.select("depth", "p0", "p1").unionAll(tails.select("depth", "p0", "p1"))
    children = stored(tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("d0"),
                                   F.col("p1").alias("d1")).agg(F.count(F.lit(1)).alias("n_children")))
    nodes = nodes.join(children, NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "_saved": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = stored(nodes.withColumn("_leaf", (F.col("n_children") == 0).cast("long")))

    named = (nodes.select("conv_id", "_leaf", "_saved")
             .unionAll(tails.select("conv_id", F.lit(1).cast("long"), F.lit(0).cast("long")))
             .groupBy("conv_id").agg(F.sum("_leaf").alias("_leaf"), F.sum("_saved").alias("_saved")))
    named = stored(named)
    sums = (shared.select("conv_id", *NODE).join(named, "conv_id").groupBy(*NODE)
            .agg(F.sum("_leaf").alias("n_leaves"), F.sum("_saved").alias("_all")))
    above = running_totals(nodes.withColumn("_bucket", F.floor(F.col("depth") / TURNS_PER_BUCKET)),
                           ["conv_id"], "_bucket", ["depth"], "_saved", "_above")
    ends = shared.where("depth = length").select(*NODE, "conv_id")
    turnless = convs.where("length = 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("d0"),
        F.lit(0).cast("long").alias("d1"), "conv_id")
    lists = stored(id_lists(ends.unionByName(turnless)))

    # Two rows of sums: all conversations are members of the root, and all nodes are below it.
    least, members = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    leaves, saved = named.agg(F.sum("_leaf"), F.sum("_saved")).first()
    long = {"conv_id": least, **dict.fromkeys(NODE, 0), "parent_conv_id": None, "n_convs": members,
            "n_leaves": leaves or 1, "saved_tokens": saved or 0}
    root = rows.sparkSession.range(1 if members else 0).select(
        *(F.lit(value).cast("long").alias(name) for name, value in long.items()))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d0").alias("p0"),
                           F.col("d1").alias("p1"), F.col("conv_id").alias("_parent"))

    def placed(frame: DataFrame) -> DataFrame:
        """Add parent_conv_id: of depth 1 the root's, else that of the node before."""
        return (frame.join(parents, ["depth", "p0", "p1"], "left")
                .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(least).cast("long"))
                            .otherwise(F.col("_parent"))).drop("_parent"))

    inner = placed(above.join(sums, NODE).withColumn("saved_tokens", F.col("_all") - F.col("_above")))
    inner = inner.select(*root.columns)
    empty = F.lit(hashlib.sha256().hexdigest())
    every = (root.unionByName(inner).join(children, NODE, "left").join(lists, NODE, "left")
             .withColumns({"n_children": F.coalesce("n_children", F.lit(0)),
                           "ends_sha256": F.coalesce("ends_sha256", empty)}))
    lone = placed(tails).select("*", F.explode(F.sequence("depth", "length")).alias("_at"))
    lone = lone.select(
        "conv_id", F.col("_at").alias("depth"),
        *(F.when(F.col("_at") == F.col("depth"), F.col(c)).alias(c) for c in ("d0", "d1")),
        F.when(F.col("_at") == F.col("depth"), F.col("parent_conv_id")).otherwise(F.col("conv_id"))
        .alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        (F.col("_at") < F.col("length")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("_at") == F.col("length"), F.sha2(F.col("conv_id").cast("string"), 256))
        .otherwise(empty).alias("ends_sha256"))
    return every.select(*lone.columns).unionByName(lone)


def prefix_trie(turns: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """Contract of op12: the nodes of the rebuilt conversations.

    Turns are ordered by turn, null first, then by role and text; repeated rows are turns of their
    own. A null role or text is empty. Turns without conv_id belong to no conversation and are
    left out. Other columns are ignored; an empty table gives no rows. Turns of one conversation
    with the same turn number are ordered by one task; all else may be of any size.
    """
    rows, convs = with_heads(stored(hashed_turns(turns)))
    return trie(rows, convs, most_cells).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


#: The same nodes in DuckDB, by comparing whole prefixes.
PREFIX_TRIE_SQL = """
with o as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
                            coalesce(text, '')) - 1 as pos
  from conversations where conv_id is not null),
k as (
  select c, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
      range(1, len(c::varchar) + 1), lambda i: list_prepend(ascii((c::varchar)[i])::bigint,
                                                            [-1, -1, -1, -1, -1, -1, -1, -1])))),
      lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end)) % 6 as h
  from (select distinct c from o)),
b as (
  select k.c, o.pos, role, text from k join o on o.c = k.c - k.c % 100 and o.pos < h
  union all
  select k.c, o.pos, role, text from k join o on o.c = k.c and o.pos >= h),
p as (
  select c, row_number() over (partition by c order by pos) as depth, length(text) as chars,
         string_agg(md5(role || chr(1) || text) || md5(text), '') over (partition by c order by pos) as node
  from b
  union all select c, 0, 0, '' from k),
l as (select c, max(depth) as last from p group by c),
n as (
  select depth, node, min(c) as rep, count(*) as n_convs, max(chars) as chars,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (depth = last), '')) as ends_sha256
  from p join l using (c) group by depth, node),
x as (select n.*, q.node as up, q.depth as top from n join p q on q.c = n.rep and q.depth <= n.depth),
m as (select up as node, top as depth, count(*) filter (depth = top + 1) as n_children,
             sum((n_convs - 1) * chars) as saved
      from x group by 1, 2),
s as (select x.up as node, x.top as depth, count(*) as n_leaves
      from x join m on m.node = x.node and m.depth = x.depth and m.n_children = 0 group by 1, 2)
select n.rep as conv_id, n.depth::bigint as depth, r.rep as parent_conv_id, n.n_convs::bigint as n_convs,
       m.n_children::bigint as n_children, s.n_leaves::bigint as n_leaves,
       m.saved::bigint as saved_tokens, n.ends_sha256
from n join m using (node, depth) join s using (node, depth)
left join n r on n.depth = r.depth + 1 and n.node[1:64 * r.depth] = r.node
"""
