"""Exact n-gram Jaccard self-join, with signature trees inside buckets.

Two texts link when the sets of their word shingles have a Jaccard similarity of at least the
threshold. Four steps keep the work near the real links, and none of them loses one:

1. A document with more than (1 - threshold) of its shingles found in no other document cannot
   link. Counting a fixed part of the hash range is enough to prove that for nearly all.
2. Of the rest, equal sets become one. Documents that share their least shingle meet in a
   bucket, and so do, by other hash orders, representatives of the components found so far.
3. As step 1, for shingles that lie within one component: what cannot link outside is done.
4. What remains meets in buckets of its rarest shingles, of which every linked pair shares one.

In a bucket a signature tree holds OR-ed bitmaps and size ranges; two nodes are traversed
together only while the largest overlap their bitmaps allow can still reach the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm.bloom import bloom_filter, holds
from flatweave.llm.common import bucketed, components, shards_for, stored
from flatweave.llm.text import U64, bytes_of, mix, released, shingle_sets, slices

WORDS = 5
#: The threshold as a fraction: 100 * intersection >= 75 * union.
NUMERATOR, DENOMINATOR = 75, 100
#: Part of the hash range whose shingles are counted in steps 1 and 3, in 48-bit hashes.
COUNTED = int(0.375 * 2 ** 48)
#: Shingles a task holds before it passes them on; documents of a bucket compared at a time.
HELD = 1 << 21
BLOCK = 1024
#: Bytes of counted shingles that a range of hashes is planned for.
SHARD_BYTES = 16 << 20
#: Bytes of sets, and rows of buckets, that a part of the last step is planned for.
PART_BYTES = 2 << 20
PART_ROWS = 8192
#: Digests of sets that a task remembers as sent, and pairs that it remembers as not linked.
SETS_KNOWN = 1 << 18
PAIRS_KNOWN = 1 << 20
#: Bytes of sets in a bucket of their table.
TABLE_BYTES = 8 << 20
#: A token in so large a share of a task's sets, and in so many, is common; and the most of them.
COMMON_SHARE, COMMON_LEAST = 0.01, 64
MOST_COMMON = 200_000
#: Bits of a signature, and children of a tree node.
BITS = 2048
FANOUT = 16
#: Hash orders by which representatives meet, after the first.
ORDERS = 2


def pack48(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(body: bytes | np.ndarray) -> np.ndarray:
    out = np.zeros((len(body) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(body, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def tokens_of(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, shingles, their sorted distinct 48-bit hashes)."""
    for row, full in shingle_sets(column, words):
        short = full >> U64(16)  # still sorted
        if len(short) > 1:
            short = short[np.append(True, short[1:] != short[:-1])]
        yield row, len(full), short


# Step 1: shingles that no other document has

#: A chunk goes to every range of hashes. Its ids and sizes go with one of them only, and what is
#: counted with a range names the documents that have a hash there, so the rows stay as large in
#: sum as the hashes however many ranges there are.
SENT = ("shard int, chunk long, ids binary, sizes binary, single binary, owners binary, "
        "runs binary, several binary")


def _send(shards: int, words: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(held) if held else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            new = np.append(True, tokens[1:] != tokens[:-1]) if len(tokens) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            alone = np.diff(np.append(at, len(tokens))) == 1
            where = (tokens * U64(shards)) // U64(COUNTED) if len(tokens) else tokens
            rows: list[list] = [[] for _ in range(8)]
            chunk = part * (1 << 32) + number
            meta = (np.array(ids, "<i8").tobytes(), np.array(sizes, "<u4").tobytes())
            none = np.zeros(0, np.uint64)
            for shard in range(shards):
                if len(at):
                    lo, hi = np.searchsorted(where[at], [shard, shard + 1])
                    mine, solo = at[lo:hi], alone[lo:hi]
                    single, whose, several = tokens[mine[solo]], owner[mine[solo]], tokens[mine[~solo]]
                else:
                    single, whose, several = none, none.astype(np.int64), none
                by = np.argsort(whose, kind="stable")
                owners, runs = np.unique(whose, return_counts=True)
                first = shard == chunk % shards
                if first or len(single) or len(several):
                    for cell, value in zip(rows, (
                            shard, chunk, meta[0] if first else None, meta[1] if first else None,
                            pack48(single[by]), owners.astype("<u4").tobytes(),
                            runs.astype("<u4").tobytes(),
                            pack48(several))):
                        cell.append(value)
            kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                              names=[n.split()[0] for n in SENT.split(", ")])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for row, n, tokens in tokens_of(batch.column(1), words):
                part_of = tokens[:np.searchsorted(tokens, U64(COUNTED))]
                ids.append(keys[row])
                sizes.append(n)
                held.append(part_of)
                size += len(part_of) + 16
                if size >= HELD:
                    yield flush()
                    ids.clear(), sizes.clear(), held.clear()
                    number, size = number + 1, 0
        if ids:
            yield flush()
    return send


def _lone(table: pa.Table) -> pa.Table:
    """For one range of hashes: the documents with hashes that occur once in all, and how many."""
    single = [unpack48(b.as_py()) for b in table.column("single")]
    several = [unpack48(b.as_py()) for b in table.column("several")]
    every = np.concatenate(single + several)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    same = ranked[1:] == ranked[:-1]
    lone = np.empty(len(every), dtype=bool)
    lone[order] = ~(np.append(False, same) | np.append(same, False))
    owners, counts, start = [], [], 0
    for tokens, whose, runs in zip(single, table.column("owners"), table.column("runs")):
        runs = np.frombuffer(runs.as_py(), "<u4").astype(np.int64)
        sums = np.append(0, np.cumsum(lone[start:start + len(tokens)]))
        ends = np.cumsum(runs)
        many = sums[ends] - sums[ends - runs]
        owners.append(np.frombuffer(whose.as_py(), "<u4")[many > 0].tobytes())
        counts.append(many[many > 0].astype("<u4").tobytes())
        start += len(tokens)
    return pa.table([table.column("chunk"), table.column("ids"), table.column("sizes"),
                     pa.array(owners, pa.binary()), pa.array(counts, pa.binary())],
                    names=["chunk", "ids", "sizes", "owners", "lone"])


def _summed(table: pa.Table) -> pa.Table:
    [first] = np.flatnonzero(table.column("ids").is_valid().to_numpy())
    ids = np.frombuffer(table.column("ids")[first].as_py(), "<i8")
    sizes = np.frombuffer(table.column("sizes")[first].as_py(), "<u4")
    lone = np.zeros(len(ids), dtype=np.int64)
    for owners, many in zip(table.column("owners"), table.column("lone")):
        lone[np.frombuffer(owners.as_py(), "<u4")] += np.frombuffer(many.as_py(), "<u4")
    return pa.table({"doc_id": ids, "n_shingles": sizes.astype(np.int64), "lone": lone})


def set_sizes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and lone: counted shingles that occur in no other row."""
    shards = shards_for(docs, F.col(docs.columns[1]), COUNTED / 2 ** 48, SHARD_BYTES)
    return (docs.mapInArrow(released(_send(shards, words)), SENT)
            .groupBy("shard").applyInArrow(
                _lone, "chunk long, ids binary, sizes binary, owners binary, lone binary")
            .groupBy("chunk").applyInArrow(_summed, "doc_id long, n_shingles long, lone long"))


# Signature trees

def bitmap(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=bool)
    bits[(tokens % U64(BITS)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


class Signatures:
    """Of some sets the bitmaps, sizes, and tokens beyond the first on a bit.

    An overlap can exceed the common bits by as many as either set has of the last.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.maps = np.stack([bitmap(s) for s in sets]) if sets else np.zeros((0, BITS // 64), np.uint64)
        self.spare = self.sizes - np.bitwise_count(self.maps).sum(axis=1).astype(np.int64)


class Tree:
    """Levels of nodes over sets in order of size; level 0 are the sets themselves."""

    def __init__(self, marks: Signatures, which: np.ndarray):
        sizes = marks.sizes[which]
        self.levels = [(marks.maps[which], sizes, sizes, marks.spare[which])]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, spare = self.levels[-1]
            at = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(spare, at)))

    def open(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether some pair below nodes i and j may reach the threshold."""
        maps, low, high, spare = self.levels[level]
        fits = ((high[i] * DENOMINATOR >= low[j] * NUMERATOR)
                & (high[j] * DENOMINATOR >= low[i] * NUMERATOR))
        most = (np.bitwise_count(maps[i] & maps[j]).sum(axis=1).astype(np.int64)
                + np.minimum(spare[i], spare[j]))
        # overlap >= t * union is overlap * (1 + t) >= t * (|a| + |b|)
        return fits & (most * (DENOMINATOR + NUMERATOR) >= NUMERATOR * (low[i] + low[j]))

    def leaf_pairs(self) -> Iterator[tuple[int, int]]:
        """Pairs of lowest inner nodes that the dual traversal leaves, nearest first."""
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            if level <= 1:
                yield i, j
                continue
            n = len(self.levels[level - 1][0])
            a = np.arange(i * FANOUT, min((i + 1) * FANOUT, n))
            b = np.arange(j * FANOUT, min((j + 1) * FANOUT, n))
            x, y = (g.ravel() for g in np.meshgrid(a, b, indexing="ij"))
            keep = x <= y
            x, y = x[keep], y[keep]
            keep = self.open(level - 1, x, y)
            stack.extend((level - 1, p, q) for p, q in zip(x[keep][::-1].tolist(),
                                                           y[keep][::-1].tolist()))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) * DENOMINATOR < len(b) * NUMERATOR:
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both * DENOMINATOR >= NUMERATOR * (len(a) + len(b) - both)


def tree_links(sets: list[np.ndarray], labels: list[int], marks: Signatures | None = None,
               which: list[int] | None = None, apart: set | None = None) -> Iterator[tuple[int, int]]:
    """Links (i, j) that connect whatever the threshold connects; equal labels are connected.

    If the sets meet several times, marks are the signatures of all that may meet, which are the
    places of these among them, and apart collects the pairs of places that do not link.
    """
    marks = marks or Signatures(sets)
    places = np.arange(len(sets)) if which is None else np.array(which)
    apart = set() if apart is None else apart
    order = np.argsort(marks.sizes[places], kind="stable")
    sets, places, first = [sets[k] for k in order], places[order], {}
    parent = list(range(len(sets)))
    for at, k in enumerate(order):
        parent[at] = first.setdefault(labels[k], at)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if len(first) < 2:
        return
    tree = Tree(marks, places)
    for p, q in tree.leaf_pairs():
        a = np.arange(p * FANOUT, min((p + 1) * FANOUT, len(sets)))
        b = np.arange(q * FANOUT, min((q + 1) * FANOUT, len(sets)))
        roots_a, roots_b = [find(x) for x in a.tolist()], [find(x) for x in b.tolist()]
        if len({*roots_a, *roots_b}) == 1:
            continue
        x, y = (g.ravel() for g in np.meshgrid(a, b, indexing="ij"))
        keep = x < y
        x, y = x[keep], y[keep]
        keep = tree.open(0, x, y)
        for i, j in zip(x[keep].tolist(), y[keep].tolist()):
            pair = (int(places[i]), int(places[j]))
            if pair in apart or find(i) == find(j):
                continue
            if similar(sets[i], sets[j]):
                parent[find(i)] = find(j)
                yield int(order[i]), int(order[j])
            else:
                apart.add(pair)


def least_links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    """Links (a, b) that connect the same ids, each of them with the least one it is connected to."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    found = [(x, find(x)) for x in parent]
    return pa.RecordBatch.from_pydict({"a": pa.array([a for a, b in found if a != b], pa.int64()),
                                       "b": pa.array([b for a, b in found if a != b], pa.int64())})


def units(rows: DataFrame, exact: bool) -> DataFrame:
    """(bucket, left, right, id, label, blocks, least): what is compared together, of rows (bucket, id, label).

    blocks is the number of a bucket's blocks, least its least id.

    Buckets of one component are left out. A bucket of more than a block is compared block by
    block: exact, all pairs of blocks; else each block by itself, which may leave links to later
    steps.
    """
    blocks = (rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"),
                                         F.max("label").alias("high"), F.min("id").alias("least"))
              .where("n > 1 and low <> high").drop("low", "high"))
    count = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = (rows.join(blocks, "bucket").withColumn("blocks", count)
            .withColumn("_own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    if exact:
        rows = (rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("left", F.least("_own", "_other"))
                .withColumn("right", F.greatest("_own", "_other")))
    else:
        rows = rows.withColumn("left", F.col("_own")).withColumn("right", F.col("_own"))
    return rows.select("bucket", "left", "right", "id", "label", "blocks", "least")


def shared_links(rows: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """All links (a, b) among rows (bucket, id, label) that share a bucket.

    sets are (id, tokens), sizes (id, n). Documents that meet at all tend to meet in many buckets.
    So buckets are dealt to as many parts as the sets need, those of one least document to one
    part, and a part gets each set once and knows what it has connected. A bucket of several blocks
    is dealt out by pairs of blocks.
    """
    met = rows.select("id").distinct()
    held = 6 * (sizes.join(met, "id").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    rows = stored(units(rows, exact=True))
    parts = max(1, -(-int(held) // PART_BYTES), -(-rows.count() // PART_ROWS))
    rows = stored(rows.withColumn("part", F.pmod(F.when(F.col("blocks") == 1, F.xxhash64("least"))
                                                 .otherwise(F.xxhash64("bucket", "left", "right")),
                                                 F.lit(parts)).cast("int")))
    bodies = (rows.select("part", F.col("id").alias("_id")).distinct()
              .join(sets.select("id", "tokens"), F.col("_id") == F.col("id"))
              .select("part", "id", "tokens"))

    def compare(meeting: pa.Table, given: pa.Table) -> pa.Table:
        ids = given.column("id").to_pylist()
        place = {id_: i for i, id_ in enumerate(ids)}
        tokens = [unpack48(b.as_py()) for b in given.column("tokens")]
        marks, apart = Signatures(tokens), set()
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found: list[tuple[int, int]] = []
        meeting = meeting.sort_by([(c, "ascending") for c in ("bucket", "left", "right", "id")])
        cells = [meeting.column(c).to_numpy() for c in ("bucket", "left", "right")]
        new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in cells]))
        at = np.append(np.flatnonzero(new), len(new))
        who, labels = meeting.column("id").to_pylist(), meeting.column("label").to_pylist()
        for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
            now = [find(x) for x in labels[low:high]]
            if len(set(now)) > 1:
                some = [place[x] for x in who[low:high]]
                if len(apart) > PAIRS_KNOWN:
                    apart.clear()
                for i, j in tree_links([tokens[k] for k in some], now, marks, some, apart):
                    parent[find(now[i])] = find(now[j])
                    found.append((ids[some[i]], ids[some[j]]))
        return pa.Table.from_batches([least_links(found)])

    right = bodies.select(*(F.col(c).alias(c) for c in ("part", "id", "tokens")))
    return rows.groupBy("part").cogroup(right.groupBy("part")).applyInArrow(compare, "a long, b long")


def bucket_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) among rows (bucket, id, label) that share a bucket's block."""
    keys = ["bucket", "left", "right"]
    rows = (units(rows, exact=False).join(sets.select("id", "tokens"), "id")
            .select(*keys, "id", "label", "tokens").repartition(*keys)
            .sortWithinPartitions(*keys, "id"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, labels, sets = None, [], [], []

        def links() -> pa.RecordBatch:
            found = list(tree_links(sets, labels)) if len(sets) > 1 else []
            return least_links([(ids[i], ids[j]) for i, j in found])

        for batch in batches:
            cells = [batch.column(i).to_pylist() for i in range(5)]
            for *now, id_, label, body in zip(*cells, batch.column(5)):
                if now != key:
                    if len(sets) > 1 and (got := links()).num_rows:
                        yield got
                    key, ids, labels, sets = now, [], [], []
                ids.append(id_)
                labels.append(label)
                sets.append(unpack48(body.as_py()))
        if len(sets) > 1:
            yield links()

    return rows.mapInArrow(released(compare), "a long, b long")


def without_repeats(rows: DataFrame) -> DataFrame:
    """Drop buckets of (bucket, id, label) whose rows all meet in another bucket as well.

    If the bucket before it, in the order of each of its documents, is one and the same, then a
    bucket's documents are among that one's; and of buckets of the same documents one is enough.
    """
    before = F.lag("bucket").over(Window.partitionBy("id").orderBy("bucket"))
    rows = stored(rows.withColumn("before", before))
    buckets = (rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count("before").alias("n_before"),
        F.min("before").alias("low"), F.max("before").alias("high"),
        F.bit_xor(F.xxhash64("id")).alias("set0"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("set1"))
        .where("n > 1 and not (n = n_before and low = high)")
        .groupBy("n", "set0", "set1").agg(F.min("bucket").alias("bucket")).select("bucket"))
    return rows.join(buckets, "bucket", "left_semi").select("bucket", "id", "label")


# The join

def _least_tokens(orders: int):
    """Add bucket keys: the least token by each of several hash orders."""
    odd = [U64(1)] + [U64(pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64)) for i in range(1, orders)]

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[list[int]] = [[] for _ in odd]
            for body in batch.column(batch.schema.get_field_index("tokens")):
                tokens = unpack48(body.as_py())
                for i, (key, factor) in enumerate(zip(keys, odd)):
                    least = tokens.min() if not i else tokens[mix(tokens * factor).argmin()]
                    key.append(int(least))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(k, pa.int64()) for k in keys)],
                names=[*batch.schema.names, *(f"least{i}" for i in range(len(odd)))])
    return least


def _sets(words: int, wanted: Broadcast | None):
    """(key, id, tokens) of the texts whose key the filter may hold.

    An id is 64 bits of the set's digest. A task sends each set's tokens once and null after, so
    that a text with very many copies is not gathered in one place.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            if wanted is not None:
                keys = batch.column(0).to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(holds(wanted.value, keys)))
            where, bodies, ids = [], [], []
            for row, _, tokens in tokens_of(batch.column(1), words):
                if len(tokens):
                    body = pack48(tokens)
                    id_ = int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)
                    where.append(row)
                    ids.append(id_)
                    bodies.append(None if id_ in sent else body)
                    sent.add(id_)
            if len(sent) > SETS_KNOWN:
                sent.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(where, pa.int64())), pa.array(ids, pa.int64()),
                 pa.array(bodies, pa.binary())], names=["key", "id", "tokens"])
    return sets


def contained(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which tokens are among the sorted ones."""
    if not len(known):
        return np.zeros(len(tokens), dtype=bool)
    return known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens


def _slices(batch: pa.RecordBatch, every: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row of each token, tokens, sizes of the sets) of a bounded number of sets.

    Of all tokens, or of the counted ones.
    """
    data, offsets = bytes_of(batch.column(1))
    for low, high in slices(offsets):
        part = offsets[low:high + 1]
        tokens, sizes = unpack48(data[part[0]:part[-1]]), np.diff(part) // 6
        rows = np.repeat(np.arange(high - low), sizes)
        if not every:
            rows, tokens = rows[tokens < U64(COUNTED)], tokens[tokens < U64(COUNTED)]
        yield low, rows, tokens, sizes


def _exploded(every: bool, common: np.ndarray):
    """(token, id, label) of every set (id, tokens, label), common tokens left out."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, rows, tokens, _ in _slices(batch, every):
                keep = ~contained(tokens, common)
                at = pa.array(rows[keep] + low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[keep].astype(np.int64)), batch.column(0).take(at),
                     batch.column(2).take(at)], names=["token", "id", "label"])
    return explode


def common_tokens(sets: DataFrame, most: int = MOST_COMMON) -> np.ndarray:
    """Tokens that some task found in a large share of its sets, so that their rows need no one place.

    They are handled apart, with the same results. Of more than the bound the most frequent count.
    Sorted; they go to the tasks with the code that needs them.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            tokens, times = np.unique(np.concatenate(held), return_counts=True)
            many = times >= max(COMMON_LEAST, COMMON_SHARE * len(held))
            return pa.RecordBatch.from_arrays([pa.array(tokens[many].astype(np.int64)),
                                               pa.array(times[many].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for body in batch.column(0):
                held.append(unpack48(body.as_py()))
                size += len(held[-1])
                if size >= HELD:
                    yield out()
                    held.clear()
                    size = 0
        if held:
            yield out()

    found = sets.select("tokens").mapInArrow(count, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(most)
    return np.sort(np.array([r.token for r in found.collect()], dtype=np.uint64))


def common_facts(sets: DataFrame, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each common token whether one label has all sets (id, tokens, label) with it, and their number.

    Each task adds up its own sets, so a token in very many of them is as many rows as there are tasks.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(common), np.iinfo(np.int64).max)
        most, many = np.full(len(common), np.iinfo(np.int64).min), np.zeros(len(common), np.int64)
        for batch in batches:
            labels = batch.column(2).to_numpy()
            for low, rows, tokens, _ in _slices(batch, True):
                keep = contained(tokens, common)
                at, label = np.searchsorted(common, tokens[keep]), labels[rows[keep] + low]
                np.minimum.at(least, at, label)
                np.maximum.at(most, at, label)
                many += np.bincount(at, minlength=len(common))
        seen = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(x[seen]) for x in (np.arange(len(common)), least, most, many)],
                                         names=["place", "low", "high", "df"])

    closed, df = np.zeros(len(common), dtype=bool), np.zeros(len(common), np.int64)
    if len(common):
        sums = sets.mapInArrow(add, "place long, low long, high long, df long").groupBy("place").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("df").alias("df"))
        for place, low, high, many in sums.collect():  # at most MOST_COMMON rows
            closed[place], df[place] = low == high, many
    return closed, df


def _summed_up(every: bool, common: np.ndarray, closed: np.ndarray, df: np.ndarray):
    """What a set's common tokens are, one row a set: (id, n, label, closed, room, needed).

    closed counts those of one label. If all other tokens came first in the order of a prefix,
    with closed ones at the front, then room places of it were left, and needed are the tokens
    there; a room below zero tells how many of the other tokens are beyond the prefix.
    """
    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, rows, tokens, sizes in _slices(batch, every):
                keep = contained(tokens, common)
                rows, at = rows[keep], np.searchsorted(common, tokens[keep])
                held = np.bincount(rows, minlength=len(sizes))
                shut = np.bincount(rows[closed[at]], minlength=len(sizes))
                length = sizes - -(-sizes * NUMERATOR // DENOMINATOR) + 1
                room = length - shut - (sizes - held)
                rows, at = rows[~closed[at]], at[~closed[at]]
                order = np.lexsort((at, df[at], rows))
                rows, at = rows[order], at[order]
                rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
                first = rank < room[rows]
                ends = np.append(0, np.cumsum(np.bincount(rows[first], minlength=len(sizes))))
                needed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                                  pa.array(common[at[first]].astype(np.int64)))
                some = slice(low, low + len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[some], pa.array(sizes), batch.column(2)[some], pa.array(shut),
                     pa.array(room), needed], names=["id", "n", "label", "closed", "room", "needed"])
    return sum_up




def _labelled(reps: DataFrame, found: DataFrame) -> DataFrame:
    return (reps.join(found, "id", "left")
            .withColumn("label", F.coalesce("component", "id")).drop("component"))


def _edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("a"), F.col("component").alias("b"))


EXPLODED = "token long, id long, label long"
SUMMED = "id long, n long, label long, closed long, room long, needed array<long>"


def _extents(sets: DataFrame, labels: DataFrame, every: bool, common: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Of the sets in labels (id, n, label): (token, id, low, high, df), and SUMMED for each set.

    low and high are the least and the largest label of the sets that hold the token, df is their
    number; rows of one token meet in one task. Common tokens are not among them, but in the sums.
    """
    rows = sets.join(labels.select("id", "label"), "id").select("id", "tokens", "label")
    by = Window.partitionBy("token")
    rare = rows.mapInArrow(released(_exploded(every, common)), EXPLODED)
    rare = rare.select("token", "id", F.min("label").over(by).alias("low"), F.max("label").over(by).alias("high"),
                       F.count(F.lit(1)).over(by).alias("df"))
    closed, df = common_facts(rows, common)
    return rare, rows.mapInArrow(_summed_up(every, common, closed, df), SUMMED)


def _not_closed(sets: DataFrame, labels: DataFrame, every: bool, common: np.ndarray) -> DataFrame:
    """Of labels (id, n, label) those that can link outside their component, among the sets given.

    A token is closed if all these sets that hold it are of one component; a set with more than
    (1 - threshold) of its tokens closed is done. Counted tokens, or every one, are looked at.
    """
    rare, sums = _extents(sets, labels, every, common)
    inside = rare.where("low = high").groupBy("id").agg(F.count(F.lit(1)).alias("_shut"))
    return stored(sums.join(inside, "id", "left")
                  .where(f"(coalesce(_shut, 0) + closed) * {DENOMINATOR} <= n * {DENOMINATOR - NUMERATOR}")
                  .select("id", "n", "label"))


def rarest_prefixes(sets: DataFrame, labels: DataFrame, common: np.ndarray) -> DataFrame:
    """(bucket, id, label): where those of labels (id, n, label) meet whatever they may link with.

    Of a set's n tokens, with closed ones first, then from the rarest on and the common ones last,
    the first n - ceil(threshold * n) + 1 are its prefix. Two sets of different components share
    no closed token, and if they link, the first token they share is in both prefixes. So a
    common line or passage is a bucket only for sets that consist of little else.
    """
    rare, sums = _extents(sets, labels, True, common)
    sums, by = stored(sums), Window.partitionBy("id")
    ranked = rare.where("low <> high").select(
        "token", "id", F.count(F.lit(1)).over(by).alias("open"),
        F.row_number().over(by.orderBy("df", "token")).alias("rank"))
    return (ranked.join(sums, "id").where("rank <= room + open").select(F.col("token").alias("bucket"), "id", "label")
            .unionByName(sums.select(F.explode("needed").alias("bucket"), "id", "label")))


def document_key(doc_id: Column, text: Column) -> Column:
    """64 bits that stand for a distinct pair of id and text; the id may be null."""
    return F.xxhash64(doc_id, text)


def linked_components(docs: DataFrame, words: int = WORDS,
                      by_id: bool = False) -> tuple[DataFrame, DataFrame]:
    """For rows (key, doc_id, text): (key, n_shingles) of every row, and (key, component) of keys.

    Keys without a link may be missing in the second frame; components are numbers of their own.
    Rows that share a key are repeated rows (see `document_key`). By id, the keys of one doc_id
    are linked too.
    """
    texts = docs.select("key", "text")
    sizes = stored(set_sizes(texts, words).withColumnRenamed("doc_id", "key"))
    open_ = (sizes.where(f"n_shingles > 0 and lone * {DENOMINATOR} "
                         f"<= n_shingles * {DENOMINATOR - NUMERATOR}").select("key").distinct())
    if open_.isEmpty():
        return sizes.select("key", "n_shingles"), open_.select("key", F.col("key").alias("component"))
    # A filter of bounded size spares the texts a shuffle. What it lets pass by chance links with
    # nothing. Beyond its bound the open keys are joined.
    wanted = bloom_filter(open_)
    if wanted is None:
        texts = texts.join(open_, "key", "left_semi").select("key", "text")
    sets = stored(texts.mapInArrow(released(_sets(words, wanted)), "key long, id long, tokens binary"))
    members = stored(sets.select("key", "id").distinct())
    held = sets.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()[0]
    buckets = max(1, -(-int(held) // TABLE_BYTES))
    reps = bucketed(sets.where("tokens is not null").select("id", "tokens").repartition(buckets, "id")
                    .dropDuplicates(["id"]), "id", buckets)

    # Step 2. Labels are those of the representatives' components so far.
    fields = ", ".join(f"least{i} long" for i in range(ORDERS + 1))
    keyed = reps.select("id", "tokens").mapInArrow(_least_tokens(ORDERS + 1),
                                                   f"id long, tokens binary, {fields}")
    keyed = stored(keyed.drop("tokens"))
    found = stored(components(bucket_links(keyed.select(
        F.col("least0").alias("bucket"), "id", F.col("id").alias("label")), reps)))
    for i in range(1, ORDERS + 1):
        some = (_labelled(keyed, found).groupBy("label", f"least{i}")
                .agg(F.min("id").alias("id")).select(F.col(f"least{i}").alias("bucket"), "id", "label"))
        found = stored(components(bucket_links(some, reps).unionByName(_edges(found))))

    # Step 3. A token is closed if all sets that hold it are of one component.
    labels = stored(_labelled(reps.select("id", (F.octet_length("tokens") / 6).cast("long")
                                          .alias("n")), found))
    common = common_tokens(reps)
    rest = labels
    for whole in (False, True):
        rest = _not_closed(reps, rest, whole, common)

    # Step 4. Linked sets share a token of their prefixes.
    every = _edges(found)
    if not rest.isEmpty():
        meeting = stored(without_repeats(rarest_prefixes(reps, rest, common)))
        every = every.unionByName(shared_links(meeting, reps, rest))
    if by_id:
        named = docs.where("doc_id is not null").select("key", "doc_id").distinct().join(members, "key")
        least = named.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("_most"))
        every = every.unionByName(named.join(least.where("b <> _most"), "doc_id")
                                  .where("id <> b").select(F.col("id").alias("a"), "b"))
    joined = (members.join(components(every), "id", "left")
              .select("key", F.coalesce("component", "id").alias("component")))
    return sizes.select("key", "n_shingles"), stored(joined)


def jaccard_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Contract of op10: doc_id, n_shingles, component_id of every row.

    Words are runs of other than white space, A-Z lower-cased. With fewer words than a shingle
    has, the whole sequence is the one shingle; without words, and where the text is null, the
    set is empty and links with nothing. Rows that share a doc_id are one document, linked by any
    of its texts. Each text without doc_id is a document of its own and links as others do; its
    component is null if no row there has an id. Repeated rows give repeated results. Other
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.select(document_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text")
    sizes, found = linked_components(rows, words, by_id=True)
    names = rows.select("key", "doc_id").distinct()
    placed = stored(names.join(found, "key", "left"))
    # All sets of an id are of one component; those of its texts that cannot link have none.
    of_id = (placed.where("doc_id is not null and component is not null")
             .groupBy("doc_id").agg(F.min("component").alias("component")))
    least = of_id.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_id = of_id.join(least, "component").select("doc_id", "component_id")
    named = placed.where("doc_id is not null").select("key", "doc_id").join(of_id, "doc_id", "left")
    lost = placed.where("doc_id is null")
    alone = lost.where("component is null").select(
        "key", "doc_id", F.lit(None).cast("long").alias("component_id"))
    lost = (lost.where("component is not null").join(least, "component", "left")
            .select("key", "doc_id", "component_id"))
    every = named.select("key", "doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    return (sizes.join(every.unionByName(lost).unionByName(alone), "key")
            .select("doc_id", "n_shingles", "component_id"))
