"""Removal of repeated substrings, by suffix arrays over the places where repeats can be.

Of every window of LENGTH bytes the least hash among its grams is its anchor, so equal windows
have the same anchor at the same offset. Anchors meet by the hash of their gram. An anchor's
context is the bytes of all windows it stands for:

- a gram that occurs once has no repeated window;
- an occurrence whose context equals an earlier one's repeats all its windows;
- the first occurrences of different contexts of one gram are told apart by their suffix array
  (see `suffixes`): windows are equal where their suffixes share LENGTH bytes, and these are
  neighbours in it. The earliest of equal windows stays.
- A gram with very many contexts, such as the edge of a common passage, would make one large
  array; the windows of its contexts meet by a hash of the whole window instead.

Equality within a suffix array is that of the bytes. Elsewhere 48 bits of gram, 40 bits of
context and 63 bits of window hash stand for them.

A document is a distinct pair of id and text, known by (doc, tie): the id and 63 bits of the
text's hash. Earlier is what comes first in this order; see `keyed`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.bloom import split_by_keys
from flatweave.llm.common import small_batches, stored
from flatweave.llm.suffixes import suffix_arrays
from flatweave.llm.text import U64, RangeHash, bytes_of, mix, released, slices

LENGTH = 100
#: Bytes of a gram. A window holds LENGTH - GRAM + 1 of them.
GRAM = 32
#: Contexts of a gram that one suffix array takes.
CONTEXTS = 32
#: Anchors that a task looks through together before it sends them on.
ANCHORS = 1 << 18
#: Bytes whose anchors are found, and bytes of lanes whose suffixes are sorted, at a time.
PIECE = 1 << 18
LANES = 1 << 18
#: Neighbouring suffixes that are compared, and contexts whose windows are hashed, at a time.
NEIGHBOURS = 1 << 14
HASHED_CONTEXTS = 2000

#: An anchor's place, packed: first window << 16 | number of windows << 8 | offset of the anchor.
START, COUNT = 16, 8


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, row, place) of the anchors of some rows' windows."""
    windows = LENGTH - GRAM + 1
    empty = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    if len(data) < LENGTH:
        return empty
    hashed = RangeHash(data)
    n = len(data) - GRAM + 1
    grams = (hashed.sums[GRAM:] - hashed.sums[:n]) * hashed.down[:n]
    low = U64((1 << 24) - 1)
    # The gram's place in the low bits, so that the leftmost of equal ones is least.
    least = (grams & ~low) | np.arange(n, dtype=U64)
    step = 1
    while 2 * step <= windows:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if windows > step:
        least = np.minimum(least[:len(least) - (windows - step)], least[windows - step:])
    at = (least & low).astype(np.int64)
    whole = np.ones(len(at) + 1, dtype=bool)  # windows that cross no end of a row
    for end in offsets[1:-1]:
        whole[max(0, end - LENGTH + 1):end] = False
    whole = whole[:len(at)]
    new = whole.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return empty
    ends = whole.copy()
    ends[:-1] &= (at[1:] != at[:-1]) | ~whole[1:]
    last = np.flatnonzero(ends)
    place = at[first]
    row = np.searchsorted(offsets, first, side="right") - 1
    context = mix(hashed(first, last + LENGTH) ^ (place - first).astype(U64))
    return (hashed(place, place + GRAM) >> U64(16), context >> U64(24), row,
            (first - offsets[row] << START) | (last - first + 1 << COUNT) | (place - first))


def long_pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row, first byte, last byte) of bounded pieces; long rows are cut.

    Cuts overlap by two windows, so that every window is whole in one of the pieces and has
    its anchor there; an anchor near a cut may be found for fewer windows, in both pieces.
    """
    for low, high in slices(offsets, PIECE):
        if high - low > 1 or offsets[high] - offsets[low] <= 8 * PIECE:
            yield low, high, int(offsets[low]), int(offsets[high])
        else:
            for start in range(int(offsets[low]), int(offsets[high]), PIECE):
                yield low, high, start, min(start + PIECE + LENGTH - 1, int(offsets[high]))


#: Stands in for a null id; its ties are not negative, those of ids are, so null ids come last.
NO_ID = (1 << 63) - 1


def keyed(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """(doc, tie) of rows: one pair for each distinct id and text, in order of id, null ids last."""
    tie = F.shiftrightunsigned(F.xxhash64(text), 1)
    return (F.coalesce(doc_id.cast("long"), F.lit(NO_ID)),
            F.when(doc_id.isNull(), tie).otherwise(-1 - tie))


PLACES = "gram long, context long, doc long, tie long, place long, kind int"

#: What is known of an anchor: nothing yet; all its windows repeat; its suffix array or the hashes
#: of its windows tell.
OPEN, REPEATED, SORTED, HASHED = 0, 1, 2, 3
#: In place of a context: some task has seen more contexts of the gram than a suffix array takes.
LARGE = -1


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of all windows, with what a task can tell of them by itself.

    Of a chunk's anchors with one gram and context only the first can be the first of all; the
    others are repeated. A gram with more contexts than a suffix array takes needs no further
    count. So a passage in very many documents sends few rows to the task that its gram is dealt to.
    """
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal size
        cells = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        size = 0
        return _batch(*_told(*cells))

    for batch in batches:
        data, offsets = bytes_of(batch.column(2))
        docs, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for low, high, start, stop in long_pieces(offsets):
            part = np.clip(offsets[low:high + 1], start, stop) - start
            gram, context, row, place = anchors(data[start:stop], part)
            if high - low == 1:
                place = place + (start - int(offsets[low]) << START)
            held.append((gram.astype(np.int64), context.astype(np.int64), docs[row + low],
                         ties[row + low], place))
            size += len(gram)
            if size >= ANCHORS:
                yield flush()
    if held:
        yield flush()


def _batch(*cells: np.ndarray) -> pa.RecordBatch:
    names = [n.split()[0] for n in PLACES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=names)


def _told(gram, context, doc, tie, place) -> tuple[np.ndarray, ...]:
    """Columns of PLACES for a chunk's anchors; the same place of one document is kept once."""
    kind = np.zeros(len(gram), dtype=np.int32)
    order = np.argsort((gram.view(U64) * U64(0x9E3779B97F4A7C15)) ^ context.view(U64), kind="stable")
    g, c = gram[order], context[order]
    twin = np.append(False, (g[1:] == g[:-1]) & (c[1:] == c[:-1]))[:len(g)]
    several = order[twin | np.append(twin[1:], False)[:len(g)]]
    rows = several[np.lexsort([x[several] for x in (place, tie, doc, context, gram)])]
    later = np.append(False, (gram[rows][1:] == gram[rows][:-1])
                      & (context[rows][1:] == context[rows][:-1]))[:len(rows)]
    kind[rows[later]] = REPEATED
    same = later & np.append(False, (doc[rows][1:] == doc[rows][:-1]) & (tie[rows][1:] == tie[rows][:-1])
                             & (place[rows][1:] >> START == place[rows][:-1] >> START))[:len(rows)]
    keep = np.ones(len(gram), dtype=bool)
    keep[rows[same]] = False
    found, counts = np.unique(gram[kind == OPEN], return_counts=True)
    large = found[counts > CONTEXTS]
    kind[np.isin(gram, large) & (kind == OPEN)] = HASHED
    cells = [x[keep] for x in (gram, context, doc, tie, place, kind)]
    marks = (large, *(np.full(len(large), x, np.int64) for x in (LARGE, 0, 0, 0)),
             np.full(len(large), OPEN, np.int32))
    return tuple(np.concatenate(x) for x in zip(cells, marks))


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PLACES come in order of kind, gram, context, doc, tie, place.

    What is told already passes. Of an open gram only the first row of each context waits for the
    end of the gram, and no more than a suffix array takes; any other is repeated.
    """
    last = None  # the open row before
    wait = np.zeros((5, 0), dtype=np.int64)
    large = False  # the open gram has more contexts than a suffix array takes

    def out(rows: np.ndarray, kind) -> pa.RecordBatch:
        kinds = np.broadcast_to(np.asarray(kind, dtype=np.int64), rows.shape[1:])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*rows[[0, 2, 3, 4]], kinds)],
                                          names=["gram", "doc", "tie", "place", "kind"])

    def close(rows: np.ndarray, wide: np.ndarray | bool) -> pa.RecordBatch:
        """First rows of whole grams; wide tells of which grams many contexts were seen elsewhere."""
        grams, which, counts = np.unique(rows[0], return_inverse=True, return_counts=True)
        many = (counts > CONTEXTS) | np.isin(grams, wide)
        kind = np.where(many, HASHED, np.where(counts > 1, SORTED, OPEN))[which]
        return out(rows[:, kind > OPEN], kind[kind > OPEN])

    for batch in batches:
        cells = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)])
        told = cells[5] != OPEN
        if told.any():
            yield out(cells[:5, told], cells[5, told])
        rows = cells[:5, ~told]
        if not rows.shape[1]:
            continue
        before = np.concatenate([rows[:, :1] if last is None else last, rows[:, :-1]], axis=1)
        new = (rows[0] != before[0]) | (rows[1] != before[1])
        new[0] |= last is None
        same = ~new & (rows[2] == before[2]) & (rows[3] == before[3]) & (rows[4] >> START == before[4] >> START)
        marked = rows[1] == LARGE
        repeated = ~new & ~same & ~marked
        if repeated.any():
            yield out(rows[:, repeated], REPEATED)
        wide = rows[0, marked]
        if last is not None and large:
            wide = np.append(wide, last[0])
        if last is not None and rows[0, 0] != last[0, 0]:
            large = False
        firsts = np.concatenate([wait, rows[:, new & ~marked]], axis=1)
        tail = firsts[0] == rows[0, -1]
        if not tail.all():
            yield close(firsts[:, ~tail], wide)
        wait, last = firsts[:, tail], rows[:, -1:]
        large = bool((wide == last[0, 0]).any()) or wait.shape[1] > CONTEXTS
        if large and wait.shape[1]:
            yield out(wait, HASHED)
            wait = wait[:, :0]
    if wait.shape[1]:
        yield close(wait, np.zeros(0, np.int64))


CONTEXT = "gram long, doc long, tie long, place long, kind int, body binary"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts asked for: doc, tie, text, lists of gram, place and kind."""
    for batch in batches:
        data, offsets = bytes_of(batch.column(2))
        cells: list[list] = [[], [], [], [], [], []]
        for row, (doc, tie, asked) in enumerate(zip(*(batch.column(i).to_pylist()
                                                      for i in (0, 1, 3)))):
            for one in asked:
                start = int(offsets[row]) + (one["place"] >> START)
                stop = start + (one["place"] >> COUNT & 255) + LENGTH - 1
                for cell, value in zip(cells, (one["gram"], doc, tie, one["place"], one["kind"],
                                               data[start:stop].tobytes())):
                    cell.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)],
                                         names=[n.split()[0] for n in CONTEXT.split(", ")])


RUNS = "doc long, tie long, start long, windows long"


def ranked(doc: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each document in order of (doc, tie), and where the first of each rank is."""
    order = np.lexsort((tie, doc))
    d, t = doc[order], tie[order]
    new = np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]))[:len(d)]
    rank = np.empty(len(d), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order[new]


def runs_of(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated windows as runs of successive starts: doc, start, windows."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1))[:len(doc)]
    at = np.flatnonzero(new)
    return doc[at], start[at], np.diff(np.append(at, len(doc)))


def sorted_repeats(bodies: list[bytes], lane: np.ndarray, doc: np.ndarray,
                   start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of the windows of contexts that an earlier window of their lane equals.

    Contexts come lane by lane. In a lane each is followed by a mark below all bytes.
    """
    count = np.array([len(b) for b in bodies])
    data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    ends_lane = np.append(lane[1:] != lane[:-1], True)
    width = count + 1 + ends_lane
    first = np.cumsum(width) - width
    symbols = np.zeros(int(width.sum()), dtype=np.int64)
    body = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(data))
    symbols[body] = data.astype(np.int64) + 2
    symbols[first + count] = 1
    lengths = np.add.reduceat(width, np.append(0, np.flatnonzero(ends_lane)[:-1] + 1))
    order = suffix_arrays(symbols, lengths)

    context = np.repeat(np.arange(len(bodies)), width)
    inside = np.arange(len(symbols)) - first[context]
    order = order[inside[order] + LENGTH <= count[context[order]]]  # whole windows
    views = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.uint16), LENGTH)
    equal = np.zeros(len(order), dtype=bool)
    for low in range(1, len(order), NEIGHBOURS):
        high = min(low + NEIGHBOURS, len(order))
        equal[low:high] = (views[order[low:high]] == views[order[low - 1:high - 1]]).all(axis=1)
    whose = context[order]
    equal[1:] &= lane[whose[1:]] == lane[whose[:-1]]
    kind = np.cumsum(~equal)
    d, s = doc[whose], start[whose] + inside[order]
    by = np.lexsort((s, d, kind))
    kind, d, s = kind[by], d[by], s[by]
    # Windows at one place of one document are the same window.
    later = np.append(False, kind[1:] == kind[:-1])
    twin = np.append(False, (d[1:] == d[:-1]) & (s[1:] == s[:-1]))
    for i in np.flatnonzero(later & twin):
        later[i] = later[i - 1]
    return d[later], s[later]


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in order of gram: a lane a gram, a bounded number of lanes at a time.

    Repeated rows of a document bring the same contexts, of which one is taken.
    """
    bodies: list[bytes] = []
    grams: list[int] = []
    docs: list[int] = []
    ties: list[int] = []
    places: list[int] = []
    size = 0

    def flush(upto: int) -> Iterator[pa.RecordBatch]:
        nonlocal size
        if upto:
            gram = np.array(grams[:upto])
            lane = np.cumsum(np.append(False, gram[1:] != gram[:-1]))
            doc, tie = np.array(docs[:upto]), np.array(ties[:upto])
            rank, first = ranked(doc, tie)
            which, start = sorted_repeats(bodies[:upto], lane, rank,
                                          np.array(places[:upto]) >> START)
            if len(which):
                which, start, windows = runs_of(which, start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (doc[first[which]], tie[first[which]], start, windows)],
                    names=["doc", "tie", "start", "windows"])
            del bodies[:upto], grams[:upto], docs[:upto], ties[:upto], places[:upto]
            size = sum(map(len, bodies))

    for batch in batches:
        for gram, doc, tie, place, body in zip(*(batch.column(i).to_pylist()
                                                 for i in (0, 1, 2, 3, 5))):
            if grams and (gram, doc, tie, place) == (grams[-1], docs[-1], ties[-1], places[-1]):
                continue
            if size > LANES and gram != grams[-1]:
                yield from flush(len(grams))
            bodies.append(body)
            grams.append(gram)
            docs.append(doc)
            ties.append(tie)
            places.append(place)
            size += len(body)
    yield from flush(len(grams))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the contexts, by hash: (window, doc, tie, start)."""
    for batch in (b.slice(low, HASHED_CONTEXTS) for b in batches
                  for low in range(0, b.num_rows, HASHED_CONTEXTS)):
        bodies = batch.column(5).to_pylist()
        count = np.array([len(b) for b in bodies])
        data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        first = np.cumsum(count) - count
        many = count - LENGTH + 1
        which = np.repeat(np.arange(len(bodies)), many)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        at = first[which] + inside
        window = RangeHash(data)(at, at + LENGTH) >> U64(1)
        doc = batch.column(1).to_numpy()[which]
        tie = batch.column(2).to_numpy()[which]
        start = (batch.column(3).to_numpy() >> START)[which] + inside
        yield pa.RecordBatch.from_arrays(
            [pa.array(window.astype(np.int64)), pa.array(doc), pa.array(tie), pa.array(start)],
            names=["window", "doc", "tie", "start"])


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc, tie, start, windows: runs of windows of (doc, tie, text) that also start earlier.

    Rows that share doc and tie hold the same text (see `keyed`).
    """
    # Rows of an open gram meet; others only pass, in any task.
    deal = F.when(F.col("kind") == OPEN, F.col("gram")).otherwise(F.xxhash64("doc", "place"))
    found = (docs.mapInArrow(released(_anchored), PLACES).repartition(deal)
             .sortWithinPartitions("kind", "gram", "context", "doc", "tie", "place"))
    with small_batches(docs.sparkSession):
        decided = stored(found.mapInArrow(released(_decided), "gram long, doc long, tie long, place long, kind long"))
    asked = (decided.where(f"kind <> {REPEATED}").groupBy("doc", "tie")
             .agg(F.collect_list(F.struct("gram", "place", F.col("kind").cast("int").alias("kind")))
                  .alias("asked")))
    # Only texts of which contexts are asked are shuffled.
    _, perhaps = split_by_keys(docs, F.xxhash64("doc", "tie"), decided.where(f"kind <> {REPEATED}").select(
        F.xxhash64("doc", "tie").alias("key")).distinct())
    # Merged, so that no task needs a worker for the filter and another one for the bodies.
    with small_batches(docs.sparkSession):
        contexts = stored(perhaps.join(asked.hint("merge"), ["doc", "tie"]).select("doc", "tie", "text", "asked")
                          .mapInArrow(released(_bodies), CONTEXT))
    by_suffix = (contexts.where(f"kind = {SORTED}").repartition("gram")
                 .sortWithinPartitions("gram", "doc", "tie", "place").mapInArrow(released(_sorted), RUNS))
    windows = contexts.where(f"kind = {HASHED}").mapInArrow(
        released(_windows), "window long, doc long, tie long, start long")
    least = windows.groupBy("window").agg(F.min(F.struct("doc", "tie", "start")).alias("first"),
                                          F.count(F.lit(1)).alias("n")).where("n > 1")
    by_hash = (windows.join(least, "window")
               .where("doc <> first.doc or tie <> first.tie or start <> first.start")
               .select("doc", "tie", "start", F.lit(1).cast("long").alias("windows")))
    whole = decided.where(f"kind = {REPEATED}").select(
        "doc", "tie", F.shiftright("place", START).alias("start"),
        F.shiftright("place", COUNT).bitwiseAND(255).alias("windows"))
    return whole.unionByName(by_suffix).unionByName(by_hash)


def removed_bytes(size: int, start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which bytes of a text the runs cover."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, np.minimum(start, size), 1)
    np.add.at(edge, np.minimum(start + windows + LENGTH - 1, size), -1)
    return np.cumsum(edge[:-1]) > 0


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc, tie, n_bytes, n_removed, n_spans, kept (binary) for rows (doc, tie, text).

    A null text counts as empty. Rows with the same doc and tie are repeated rows of one text:
    neither is earlier than the other. Texts shorter than LENGTH lose nothing. Only texts that hold
    a repeat are shuffled.
    """
    runs = stored(repeated_runs(docs).groupBy("doc", "tie")
                  .agg(F.collect_set(F.struct("start", "windows")).alias("runs")))
    alone, perhaps = split_by_keys(docs, F.xxhash64("doc", "tie"),
                                   runs.select(F.xxhash64("doc", "tie").alias("key")).distinct())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(2))
            cells: list[list] = [[], [], [], []]
            for row, found in enumerate(batch.column(3).to_pylist()):
                text = data[offsets[row]:offsets[row + 1]]
                if found:
                    gone = removed_bytes(len(text), np.array([r["start"] for r in found]),
                                         np.array([r["windows"] for r in found]))
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                    values = len(text), int(gone.sum()), spans, text[~gone].tobytes()
                else:
                    values = len(text), 0, 0, text.tobytes()
                for cell, value in zip(cells, values):
                    cell.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cells, kinds))],
                names=["doc", "tie", "n_bytes", "n_removed", "n_spans", "kept"])

    whole = alone.select("doc", "tie", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                         *(F.lit(0).cast("long").alias(n) for n in ("n_removed", "n_spans")),
                         F.coalesce("text", F.lit("")).cast("binary").alias("kept"))
    return whole.unionByName(perhaps.join(runs.hint("merge"), ["doc", "tie"], "left").select("doc", "tie", "text", "runs")
                             .mapInArrow(cut, "doc long, tie long, n_bytes long, n_removed long, "
                                              "n_spans long, kept binary"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Contract of op6: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Each distinct text of a doc_id is a document, in order of a hash of the text; so is each
    distinct text without doc_id, after all others. Only rows equal in both are repeated rows.
    Other columns are ignored; an empty table gives no rows.
    """
    text = F.col("text").cast("string")
    doc, tie = keyed(F.col("doc_id"), text)
    done = without_repeats(docs.select(doc.alias("doc"), tie.alias("tie"), text.alias("text")))
    return done.select(F.when(F.col("tie") < 0, F.col("doc")).alias("doc_id"), "n_bytes",
                       "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
