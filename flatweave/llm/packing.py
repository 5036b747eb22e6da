"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document's token ids are cut into full windows and a tail; tails are cut into pieces no longer
than a part of a window. A bounded batch of pieces is then spread over as many windows as its
tokens need: partial partitions, each a list of window sums, are merged two at a time, the pair
with the largest imbalances first, the fullest windows of one on the emptiest of the other.
The windows come out nearly equal; if one still exceeds the capacity, the batch gets one more.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from flatweave.llm.common import fresh, stored
from flatweave.llm.text import bytes_of, released, resident, slices

#: Tokens of a window, and of a piece of a document's tail at most.
CAPACITY = 1024
PIECE = 256
#: Windows that are filled together, about.
BATCH = 256
#: The id that ends a document.
END = 0
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of_char() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies write for each byte, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str):
    """A function from text to ids, equal to the tokenizer file at path without added ids.

    The file is a byte-level BPE whose merges are numbered in order, so the faster of the two
    public tokenizer libraries gives the same ids from the same vocabulary. Texts that hold one
    of the file's special tokens go to the file's own library.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    special = [t["content"] for t in made["added_tokens"]]
    back = byte_of_char()
    ranks = {bytes(back[c] for c in token): i for token, i in made["model"]["vocab"].items()
             if token not in special}
    fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})
    own: list = []  # its tables are as large again, so they are made when a text needs them

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            if not own:
                from tokenizers import Tokenizer
                own.append(Tokenizer.from_file(path))
            return own[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(tokens: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[int]:
    """Lengths that a document of so many tokens is cut into."""
    full, tail = divmod(tokens, capacity)
    parts, rest = divmod(tail, piece)
    return [capacity] * full + [piece] * parts + [rest] * (rest > 0)


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY,
              piece: int = PIECE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece of every document."""
    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = resident(path, lambda: encoder(path))
        for batch in batches:
            offsets = bytes_of(batch.column(1))[1]
            for low, high in slices(offsets):  # some 20 pieces a document: a bounded slice at a time
                where: list[int] = []
                cells: list[list[int]] = [[], [], [], []]
                for i in range(low, high):
                    ids = np.array([*encode(batch.column(1)[i].as_py() or ""), END], dtype="<u4")
                    start = 0
                    for length in cut(len(ids), capacity, piece):
                        where.append(i)
                        for cell, value in zip(cells, (start, length, zlib.crc32(
                                ids[start:start + length].tobytes()), len(ids))):
                            cell.append(value)
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(where, pa.int64())),
                     *(pa.array(c, pa.int64()) for c in cells)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        released(tokenized, path), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size when spread over so many windows with near-equal sums."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return np.zeros(n, dtype=np.int64)
    # A partial partition is its window sums, largest first, less the smallest of them.
    sums: dict[int, np.ndarray] = {}
    for i, size in enumerate(sizes):
        first = np.zeros(windows, dtype=np.int64)
        first[0] = size
        sums[i] = first
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        node = n + len(merges)
        sums[node] = both - both[-1]
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(both[0] - both[-1]), node))
    # From the last merge back: which window stands at each place of a partial partition.
    places = {heap[0][1]: np.arange(windows)}
    out = np.zeros(n, dtype=np.int64)
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        at = np.empty(windows, dtype=np.int64)
        at[order] = places.pop(n + k)
        for child, labels in ((a, at), (b, at[::-1])):
            if child < n:
                out[child] = labels[0]
            else:
                places[child] = labels
    return out


def spread(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size, by differencing over classes of equal sizes.

    As often as a size fills all windows it is dealt to each of them: such a partial partition has no
    imbalance and changes none it is merged with. What is left of each size, fewer than there are
    windows, is merged by differencing, so the work follows the different sizes.
    """
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    first = np.searchsorted(ranked, ranked, side="left")
    count = np.searchsorted(ranked, ranked, side="right") - first
    place = np.arange(len(sizes)) - first
    dealt = place < count // windows * windows
    out = np.empty(len(sizes), dtype=np.int64)
    out[order[dealt]] = place[dealt] % windows
    out[order[~dealt]] = differencing(ranked[~dealt], windows)
    return out


def packed_windows(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, no window above capacity, with as few windows as do."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = spread(sizes, windows)
        if np.bincount(found, weights=sizes).max(initial=0) <= capacity:
            return found
        windows += 1


def pack(pieces: DataFrame, capacity: int = CAPACITY, batch: int = BATCH) -> DataFrame:
    """Add sequence_id and offset to stored pieces with a column length.

    Full pieces are sequences of their own. The others meet in batches dealt by a hash of their
    place in the table, never of what they hold, so that equal rows, in any number, are spread like
    others. Sequence ids are unique, not gapless.
    """
    rest = pieces.where(F.col("length") < capacity)
    tokens = rest.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    batches = max(1, -(-tokens // (batch * capacity)))
    columns = pieces.columns
    added = [fresh(n, columns) for n in ("_batch", "sequence_id", "offset")]
    schema = StructType([*pieces.schema.fields, *(StructField(n, LongType()) for n in added[1:])])

    def filled(rows: pa.Table) -> pa.Table:
        sizes = rows.column("length").to_numpy()
        window = packed_windows(sizes, capacity)
        order = np.lexsort((-sizes, window))
        rows, window, sizes = rows.take(pa.array(order)), window[order], sizes[order]
        ahead = np.cumsum(sizes) - sizes
        first = np.searchsorted(window, window, side="left")
        sequence = rows.column(added[0])[0].as_py() * (1 << 20) + window
        return pa.table([*(rows.column(c) for c in columns), pa.array(sequence),
                         pa.array(ahead - ahead[first])], names=schema.names)

    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches))
    spread_out = rest.withColumn(added[0], number).groupBy(added[0]).applyInArrow(filled, schema)
    # Full windows are numbered by partition and place, below zero.
    alone = pieces.where(F.col("length") >= capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias(added[1]),
        F.lit(0).cast("long").alias(added[2]))
    return spread_out.unionByName(alone)


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Contract of op9: one row per piece, with its sequence and its offset there.

    A null or empty text is the end id alone; repeated rows and null ids are packed like others,
    texts of any length are cut at full windows. Other columns are ignored. An empty table gives
    no rows.
    """
    pieces = stored(pieces_of(docs, path or vocabulary_path(), capacity))
    return pack(pieces, capacity)
