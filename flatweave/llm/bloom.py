"""A Bloom filter of 64-bit keys, made in parts by Spark and broadcast while its size is bounded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.text import U64, mix

#: Bits for each key, and hashes of a key: one stranger in 2,000 passes.
BITS_PER_KEY = 16
HASHES = 4
#: Bits at most (32 MB), so keys at most; more keys are no case for a filter.
MOST_BITS = 1 << 28
MOST_KEYS = MOST_BITS // BITS_PER_KEY
#: Bits that are merged together.
BLOCK = 1 << 18


def places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    first = mix(keys.astype(np.int64).view(U64))
    second = mix(first ^ U64(0x9E3779B97F4A7C15)) | U64(1)
    for i in range(HASHES):
        yield ((first + U64(i) * second) & U64(bits - 1)).astype(np.int64)


def holds(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; never false for one that is."""
    found = np.ones(len(keys), dtype=bool)
    for at in places(keys, 8 * len(packed)):
        found &= (packed[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 1
    return found


def bloom_filter(keys: DataFrame, most: int = MOST_KEYS) -> Broadcast | None:
    """The packed bits of the one column of keys (long, not null), or None if there are too many.

    Each task marks its keys in blocks of bits, blocks are merged by a shuffle, and the driver
    puts them side by side; it never sees a key.
    """
    count = keys.count()
    if count > most:
        return None
    bits = max(BLOCK, 1 << (BITS_PER_KEY * count - 1).bit_length())

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            for at in places(batch.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(packed, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        parts = packed.reshape(-1, BLOCK // 8)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array([parts[i].tobytes() for i in some], pa.binary())],
            names=["block", "bits"])

    def merged(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK // 8, dtype=np.uint8)
        for body in table.column("bits"):
            total |= np.frombuffer(body.as_py(), dtype=np.uint8)
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([total.tobytes()], pa.binary())})

    packed = np.zeros(bits // 8, dtype=np.uint8)
    parts = keys.mapInArrow(mark, "block long, bits binary").groupBy("block").applyInArrow(
        merged, "block long, bits binary")
    for block, body in parts.toLocalIterator():
        packed[block * BLOCK // 8:(block + 1) * BLOCK // 8] = np.frombuffer(body, dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(packed)


def split_by_keys(frame: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key (long) is surely not among the keys, and the others, a few strangers included.

    The first need no join with what the keys stand for, so wide rows that it does not concern
    are not shuffled. Only the key goes to Python. With too many keys for a filter all rows are others.
    """
    wanted = bloom_filter(keys)
    if wanted is None:
        return frame.where("false"), frame

    @F.arrow_udf("boolean")
    def may(found: pa.Array) -> pa.Array:
        return pa.array(holds(wanted.value, found.to_numpy(zero_copy_only=False)))

    return frame.where(~may(key)), frame.where(may(key))
