"""Interpolated modified Kneser-Ney bigram model, counted in Spark and read as mapped arrays.

Counting: tasks sort the word pairs of their documents and send each distinct pair once, as
packed arrays by range of the first word's hash. A shard adds these up and writes the sorted
hashes of its pairs with their counts. What a word needs as a context (how many words follow it
once, twice, more often) is known there too; how many different words precede it is added up
in a second exchange by word. Scoring: workers map the sorted arrays from the shared folder and
look up a batch's pairs in sorted order, so that pages are read in sequence.

Words are 48-bit hashes in the model's arrays; the first 16 bits choose the shard.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import qualified, remainder, shards_for
from flatweave.session import shared_folder
from flatweave.llm.text import U64, mix, released, rows_of_words

#: Word pairs a task sorts at a time before it passes them on.
PAIRS_HELD = 1 << 21
#: Bytes of text that a shard is planned for.
SHARD_BYTES = 16 << 20
#: Weight given to each word in the base model.
BASE = 0.1

#: The end of a document, as a word: a document starts after one and ends with one.
END = int(mix(np.array([0xE0D], dtype=np.uint64))[0] >> U64(16))

#: Arrays beside the words' hashes. Only tokens can be more than four bytes count.
KINDS = {"count": "<i8", "preceded": "<u4", "once": "<u4", "twice": "<u4", "more": "<u4"}

_opened: dict[str, np.ndarray] = {}


def tokens_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words, words per row) in bounded slices; each row's words end with END."""
    for low, hashes, counts in rows_of_words(column):
        ends = np.cumsum(counts)
        yield low, np.insert(hashes >> U64(16), ends, U64(END)), counts + 1


def before(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The word before each word; END before a row's first."""
    prior = np.empty_like(words)
    prior[1:] = words[:-1]
    prior[np.cumsum(counts) - counts] = U64(END)
    return prior


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return ((words >> U64(32)) * U64(shards)) >> U64(16)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit key of a pair: the first word's leading 16 bits, then a hash of both."""
    both = mix(first * U64(0x9E3779B97F4A7C15) ^ mix(second))
    return (first >> U64(32) << U64(48)) | (both >> U64(16))


def pack48(words: np.ndarray) -> bytes:
    """Six bytes a word."""
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(body, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def grouped(keys: tuple[np.ndarray, ...], weights: np.ndarray | None) -> tuple:
    """Distinct keys in order, and the sum of the weights (or the number) of each."""
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    sums = (np.diff(np.append(at, len(order))) if weights is None or not len(at)
            else np.add.reduceat(weights[order], at))
    return (*(k[at] for k in keys), sums)


# Counting

PAIRS = "shard int, first binary, runs binary, second binary, many binary, counts binary"


def _pairs(shards: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            first, second, n = grouped((np.concatenate([h[0] for h in held]),
                                        np.concatenate([h[1] for h in held])), None)
            held.clear()
            bounds = np.searchsorted(shard_of(first, shards), np.arange(shards + 1))
            rows: list[list] = [[] for _ in range(6)]
            for shard, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if a < b:
                    at = np.flatnonzero(np.append(True, first[a + 1:b] != first[a:b - 1]))
                    many = np.flatnonzero(n[a:b] > 1)
                    for cell, value in zip(rows, (
                            shard, pack48(first[a:b][at]),
                            np.diff(np.append(at, b - a)).astype("<u4").tobytes(),
                            pack48(second[a:b]), many.astype("<u4").tobytes(),
                            n[a:b][many].astype("<u4").tobytes())):
                        cell.append(value)
            kinds = [pa.int32()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                              names=["shard", "first", "runs", "second", "many",
                                                     "counts"])

        size = 0
        for batch in batches:
            for _, words, counts in tokens_of(batch.column(0)):
                held.append((before(words, counts), words))
                size += len(words)
                if size >= PAIRS_HELD:
                    yield flush()
                    size = 0
        if held:
            yield flush()
    return count


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    firsts, seconds, counts = [], [], []
    for row in range(table.num_rows):
        get = {n: table.column(n)[row].as_py() for n in ("first", "runs", "second", "many", "counts")}
        second = unpack48(get["second"])
        n = np.ones(len(second), dtype=np.int64)
        n[np.frombuffer(get["many"], "<u4")] = np.frombuffer(get["counts"], "<u4")
        firsts.append(np.repeat(unpack48(get["first"]), np.frombuffer(get["runs"], "<u4")))
        seconds.append(second)
        counts.append(n)
    return np.concatenate(firsts), np.concatenate(seconds), np.concatenate(counts)


WORDS = "shard int, side int, word binary, a binary, b binary, c binary"


def _add_pairs(folder: str, shards: int):
    """Write a shard's sorted pairs; send what its words are as contexts and as successors."""
    def add(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        first, second, n = grouped(*(lambda f, s, c: ((f, s), c))(*_unpacked(table)))
        keys = pair_keys(first, second)
        order = np.argsort(keys, kind="stable")
        once = n[order] == 1
        write(folder, f"pairs-{shard:05d}-once", keys[order][once].astype("<u8"))
        write(folder, f"pairs-{shard:05d}-keys", keys[order][~once].astype("<u8"))
        write(folder, f"pairs-{shard:05d}-counts", n[order][~once].astype("<u4"))
        rows: list[list] = [[] for _ in range(6)]

        def send(to: int, side: int, word, a, b, c) -> None:
            for cell, value in zip(rows, (to, side, pack48(word), *(
                    x.astype("<u4").tobytes() for x in (a, b, c)))):
                cell.append(value)

        at = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        kinds = [np.add.reduceat(x.astype(np.int64), at) for x in (n == 1, n == 2, n >= 3)]
        send(shard, 0, first[at], *kinds)
        word, preceded = grouped((second,), None)
        _, seen = grouped((second,), n)
        # Counts beyond four bytes go as several rows.
        bounds = np.searchsorted(shard_of(word, shards), np.arange(shards + 1))
        for to, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a < b:
                low = np.minimum(seen[a:b], (1 << 32) - 1)
                send(to, 1, word[a:b], preceded[a:b], low, (seen[a:b] - low) >> 32)
        # Counts of counts, for the discounts.
        counts = [int((n == i).sum()) for i in (1, 2, 3, 4)]
        send(shard, 2, np.zeros(4, np.uint64), np.array(counts) & 0xFFFFFFFF,
             np.array(counts) >> 32, np.zeros(4, np.int64))
        types = [pa.int32(), pa.int32()] + [pa.binary()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(rows, types)],
                        names=["shard", "side", "word", "a", "b", "c"])
    return add


TOTALS = ("shard long, paired long, n1 long, n2 long, n3 long, n4 long, m1 long, m2 long, m3 long, m4 long, pairs long, "
          "words long, tokens long")


def _add_words(folder: str):
    """Write a shard's sorted words with their counts; return what the discounts need."""
    def add(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        sides: dict[int, list] = {0: [], 1: [], 2: []}
        for row in range(table.num_rows):
            get = {n: table.column(n)[row].as_py() for n in ("side", "word", "a", "b", "c")}
            sides[get["side"]].append((unpack48(get["word"]), *(
                np.frombuffer(get[n], "<u4").astype(np.int64) for n in "abc")))
        joined = {s: [np.concatenate([p[i] for p in parts]) for i in range(4)] if parts
                  else [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3]
                  for s, parts in sides.items()}
        words = np.unique(np.concatenate([joined[0][0], joined[1][0]]))
        columns = {}
        for side, names in ((0, ("once", "twice", "more")), (1, ("preceded", "count", None))):
            at = np.searchsorted(words, joined[side][0])
            for i, name in enumerate(names):
                if name:
                    columns[name] = np.zeros(len(words), dtype=np.int64)
                    np.add.at(columns[name], at, joined[side][1 + i])
            if side:
                np.add.at(columns["count"], at, joined[1][3] << 32)
        write(folder, f"words-{shard:05d}-keys", words.astype("<u8"))
        for name, values in columns.items():
            write(folder, f"words-{shard:05d}-{name}", values.astype(KINDS[name]))
        stats = joined[2][1] + (joined[2][2] << 32)
        pairs = stats.reshape(-1, 4).sum(axis=0).tolist()
        lower = [int((columns["preceded"] == i).sum()) for i in (1, 2, 3, 4)]
        values = [shard, int(len(joined[0][0]) > 0), *pairs, *lower, int(columns["preceded"].sum()), int((columns["count"] > 0).sum()),
                  int(columns["count"].sum())]
        return pa.table({name.split()[0]: pa.array([v], pa.int64())
                         for name, v in zip(TOTALS.split(", "), values)})
    return add


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path with a scheme, as every worker sees it, and the path there."""
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


def write(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array under a name of its own, then rename: a task may run twice."""
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(values).view(np.uint8).data if len(values) else b"")
    system.move(draft, f"{path}/{name}")


def array(folder: str, name: str, kind: str) -> np.ndarray:
    """An array of the model: mapped if the folder is mounted, else read once per worker.

    A missing file is an error: it means that this worker does not see the shared folder.
    """
    key = f"{folder}/{name}"
    if key not in _opened:
        system, path = filesystem(folder)
        info = system.get_file_info(f"{path}/{name}")
        if info.type != pa.fs.FileType.File:
            raise FileNotFoundError(f"{key} is missing: is the folder shared by all workers?")
        if not info.size:
            _opened[key] = np.zeros(0, dtype=kind)
        elif isinstance(system, pa.fs.LocalFileSystem):
            _opened[key] = np.memmap(f"{path}/{name}", dtype=kind, mode="r")
        else:
            with system.open_input_stream(f"{path}/{name}") as file:
                _opened[key] = np.frombuffer(file.read(), dtype=kind)
    return _opened[key]


# The model

@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that all of them need."""

    folder: str
    shards: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    pairs: int
    words: int
    tokens: int
    #: Kinds of words preceded by one, two, more different words.
    lower: tuple[int, int, int]
    #: Shards that have words, and that have pairs; only these have files.
    held: frozenset[int]
    paired: frozenset[int]

    def found(self, keys: np.ndarray, shard: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: which are in the array, and where in their shard."""
        at, hit = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        bounds = np.searchsorted(shard, np.arange(self.shards + 1))
        there = self.held if name.startswith("words") else self.paired
        for s, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a < b and s in there:
                known = array(self.folder, name.format(s), "<u8")
                if len(known):
                    place = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                    at[a:b], hit[a:b] = place, known[place] == keys[a:b]
        return hit, at

    def taken(self, hit: np.ndarray, at: np.ndarray, shard: np.ndarray, name: str,
              kind: str) -> np.ndarray:
        out = np.zeros(len(hit), dtype=np.int64)
        bounds = np.searchsorted(shard, np.arange(self.shards + 1))
        for s, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            some = np.flatnonzero(hit[a:b]) + a
            if len(some):
                out[some] = array(self.folder, name.format(s), kind)[at[some]]
        return out

    def score(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per row: log10 probability, base log10 probability, known tokens."""
        prior = before(words, counts)
        kinds, where = np.unique(words, return_inverse=True)
        # Every context but END is a word of the batch too.
        contexts = np.append(kinds, U64(END)) if END not in kinds else kinds
        contexts.sort()
        shard = shard_of(contexts, self.shards)
        hit, at = self.found(contexts, shard, "words-{:05d}-keys")
        info = {n: self.taken(hit, at, shard, "words-{:05d}-" + n, kind)
                for n, kind in KINDS.items()}
        d, e = self.pair_discounts, self.word_discounts
        # The lower order: how many different words precede a word, interpolated with even odds.
        pre = info["preceded"]
        kept = pre - np.select([pre >= 3, pre == 2, pre == 1], [e[2], e[1], e[0]], 0.0)
        spare = sum(x * y for x, y in zip(e, self.lower)) / max(self.pairs, 1) if self.pairs else 1.0
        lower = np.maximum(kept, 0) / max(self.pairs, 1) + spare / (self.words + 1)
        total = info["count"].astype(np.float64)
        spared = d[0] * info["once"] + d[1] * info["twice"] + d[2] * info["more"]
        base = np.log10((total + BASE) / (self.tokens + BASE * (self.words + 1)))

        word_at = np.searchsorted(contexts, kinds)[where]
        prior_at = np.searchsorted(contexts, prior)
        keys = pair_keys(prior, words)
        order = np.argsort(keys)
        keys, pair_shard = keys[order], shard_of(prior, self.shards)[order]
        n = np.zeros(len(words), dtype=np.int64)
        hit, _ = self.found(keys, pair_shard, "pairs-{:05d}-once")
        n[order[hit]] = 1
        hit, at = self.found(keys, pair_shard, "pairs-{:05d}-keys")
        n[order] += self.taken(hit, at, pair_shard, "pairs-{:05d}-counts", "<u4")

        seen, low = total[prior_at], lower[word_at]
        off = np.select([n >= 3, n == 2, n == 1], [d[2], d[1], d[0]], 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            high = (np.maximum(n - off, 0) + spared[prior_at] * low) / seen
        logs = np.log10(np.where(seen > 0, high, low))
        starts = np.cumsum(counts) - counts
        return (np.add.reduceat(logs, starts), np.add.reduceat(base[word_at], starts),
                np.add.reduceat((info["count"][word_at] > 0).astype(np.int64), starts))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts, kept within 0 and the count."""
    if not n1:
        return 0.5, 1.0, 1.5  # nothing occurs once: any valid discounts will do
    y = n1 / (n1 + 2 * n2)
    parts = []
    for i, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        parts.append(min(max(i - (i + 1) * y * high / low if low else 0.5 * i, 0.0), float(i)))
    return parts[0], parts[1], parts[2]


def learn(texts: DataFrame, text: str = "text", shards: int | None = None) -> Model:
    """Count a model over all rows; its arrays go to the cluster's shared folder.

    There are as many shards as the texts' bytes ask for, up to 65,536, so that a shard's size does
    not follow the input.
    """
    spark = texts.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    shards = min(1 << 16, shards or shards_for(texts, body, 1.0, SHARD_BYTES))
    folder = qualified(spark, shared_folder(spark))
    pairs = texts.select(body.alias("text")).mapInArrow(released(_pairs(shards)), PAIRS)
    words = pairs.groupBy("shard").applyInArrow(_add_pairs(folder, shards), WORDS)
    sums = words.groupBy("shard").applyInArrow(_add_words(folder), TOTALS).collect()  # a row a shard
    row = {n.split()[0]: sum(r[n.split()[0]] for r in sums) for n in TOTALS.split(", ")}
    lower = [row["m1"], row["m2"], row["words"] - row["m1"] - row["m2"]]
    return Model(folder, shards, discounts(*(row[f"n{i}"] for i in (1, 2, 3, 4))),
                 discounts(*(row[f"m{i}"] for i in (1, 2, 3, 4))), row["pairs"], row["words"],
                 row["tokens"], tuple(lower), frozenset(r["shard"] for r in sums),
                 frozenset(r["shard"] for r in sums if r["paired"]))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add n_tokens, n_known, base_score, score to all rows (columns of these names are replaced).

    A null or empty text is scored as its end alone; texts of any length are scored whole.
    """
    @F.arrow_udf("n_tokens long, n_known long, base_score double, score double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [(counts, *model.score(words, counts)) for _, words, counts in tokens_of(texts)]
        counts, logs, base, known = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0)] * 4
        return pa.StructArray.from_arrays(
            [pa.array(counts.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base),
             pa.array(logs)], names=["n_tokens", "n_known", "base_score", "score"])

    new = ("n_tokens", "n_known", "base_score", "score")
    kept = ["`" + c.replace("`", "``") + "`" for c in docs.columns if c.lower() not in new]
    return docs.select(*kept, score(F.col(text).cast("string")).alias("_s")).select(
        *kept, *(F.col(f"_s.{n}").alias(n) for n in new))


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 10) == 0


def perplexities(docs: DataFrame) -> DataFrame:
    """Contract of op4: every document's score by the model of those that are not held out.

    Repeated rows count, and are scored, as often as they occur. An empty table gives no rows;
    if nothing is left to learn from, each token has even odds.
    """
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model = learn(rows.where(~F.col("held_out")))
    return scored(rows, model).select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
