"""Language identification by rank-ordered n-gram profiles (out-of-place distance).

A profile is the list of a text's most frequent character n-grams, most frequent first. A
document's profile is compared to one profile per language: each of its n-grams costs the
difference between its ranks in both, or the profile length if the language lacks it. The
nearest language wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm.common import column, fresh, remainder
from flatweave.llm.text import release, released

#: N-grams per profile, the longest n-gram in characters (1 to 3), and most languages told apart.
PROFILE = 300
LONGEST = 3
MOST_LANGUAGES = 10_000

UNKNOWN = "und"
#: Characters counted at a time, so that memory does not follow the length of a text.
CHARS_AT_ONCE = 1 << 18
#: Distinct n-grams a task may hold before it passes them on, of one language and of all.
GRAMS_HELD = 400_000
ALL_GRAMS_HELD = 1_000_000

#: A blank within an n-gram's code; not 0, or " a" would have the code of "a".
BLANK = 1

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For every code point its lower-case letter, or 0 where it is none."""
    if not _letters:
        made = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
        for point in range(sys.maxunicode + 1):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                made[point] = ord(low) if len(low) == 1 else point
        _letters.append(made)
    return _letters[0]


def grams_of(text: str, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of 1 to longest letters, and how often each occurs in the whole text.

    Runs of other characters count as one blank; n-grams of blanks alone are left out. An
    n-gram is its code points, 21 bits each.
    """
    points = letter_table()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    letters = points != 0
    if not letters.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    points = points[keep]
    if points[0] != 0:
        points = np.concatenate([np.zeros(1, np.uint32), points])
    if points[-1] != 0:
        points = np.append(points, np.uint32(0))
    points = points.astype(np.int64)
    points[points == 0] = BLANK
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for low in range(0, len(points), CHARS_AT_ONCE):
        part = points[low:low + CHARS_AT_ONCE + longest - 1]
        first = min(CHARS_AT_ONCE, len(part))
        codes = [part[:first][part[:first] != BLANK]]
        gram = part
        for n in range(2, longest + 1):
            gram = (gram[:-1] << 21) | part[n - 1:]
            codes.append(gram[:first])
        found.append(_counted(np.concatenate(codes)))
    if len(found) == 1:
        return found[0]
    return _merged([f[0] for f in found], [f[1] for f in found])


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes.sort()
    first = np.empty(len(codes), dtype=bool)
    first[:1] = True
    np.not_equal(codes[1:], codes[:-1], out=first[1:])
    at = np.flatnonzero(first)
    return codes[at], np.diff(np.append(at, len(codes)))


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate(codes), return_inverse=True)
    return codes, np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)


def profile_of(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties to the smaller code."""
    if len(codes) > size:
        least = -np.partition(-counts, size - 1)[size - 1]
        at = np.flatnonzero(counts >= least)
        codes, counts = codes[at], counts[at]
    return codes[np.argsort(-counts, kind="stable")][:size]


def gram_counts(texts: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows; each task adds up before it sends."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out(name: str) -> pa.RecordBatch:
            codes, counts = _merged(*held.pop(name)[:2])
            return pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(codes), pa.string()),
                                               "gram": codes, "n": counts})

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes, counts = grams_of(body.as_py())
                mine = held.setdefault(name, [[], [], 0])
                mine[0].append(codes)
                mine[1].append(counts)
                mine[2] += len(codes)
                if mine[2] > GRAMS_HELD:
                    codes, counts = _merged(mine[0], mine[1])
                    if len(codes) > GRAMS_HELD // 2:
                        held[name] = [[codes], [counts], 0]
                        yield out(name)
                    else:
                        held[name] = [[codes], [counts], len(codes)]
            while sum(m[2] for m in held.values()) > ALL_GRAMS_HELD:
                yield out(max(held, key=lambda name: held[name][2]))
        for name in list(held):
            yield out(name)

    rows = texts.select(column(texts, lang).alias("lang"), column(texts, text).alias("text")).where(
        "lang is not null and text is not null")
    counted = rows.mapInArrow(released(count), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(texts: DataFrame, text: str = "text", lang: str = "lang",
                   size: int = PROFILE) -> dict[str, np.ndarray]:
    """The profile of every language in the rows. Bounded by languages times profile size."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # The best of each part of the grams come first, so that no task ranks all of a language.
    part = Window.partitionBy("lang", "part").orderBy(F.desc("n"), "gram")
    counts = gram_counts(texts, text, lang).withColumn("part", F.pmod(F.hash("gram"), F.lit(64)))
    best = (counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= size)
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
            .select("lang", "gram", "rank").orderBy("lang", "rank")
            .limit(MOST_LANGUAGES * size + 1).toArrow())
    if len(best) > MOST_LANGUAGES * size:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    grams: dict[str, list[int]] = {}
    for name, gram in zip(best.column("lang").to_pylist(), best.column("gram").to_pylist()):
        grams.setdefault(name, []).append(gram)
    return {name: np.array(mine, dtype=np.int64) for name, mine in grams.items()}


class Ranks:
    """All profiles as one sorted list of n-grams with their ranks by language."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.names = sorted(profiles)
        self.size = size
        parts = [profiles[n] for n in self.names]
        self.codes = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(parts)), size, dtype=np.int32)
        for i, grams in enumerate(parts):
            self.ranks[np.searchsorted(self.codes, grams), i] = np.arange(len(grams))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties to the first by name), and 1 - distance / worst distance."""
        if not text or not self.names:
            return UNKNOWN, 0.0
        mine = profile_of(*grams_of(text), self.size)
        if not len(mine):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, mine)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != mine)] = \
            len(self.codes)
        ranks, own = self.ranks[at], np.arange(len(mine), dtype=np.int32)[:, None]
        away = np.where(ranks == self.size, self.size, np.abs(ranks - own)).sum(axis=0)
        best = int(away.argmin())
        return self.names[best], float(1 - away[best] / (self.size * len(mine)))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text",
             lang_pred: str = "lang_pred", score: str = "score", size: int = PROFILE) -> DataFrame:
    """All columns of the rows, with the predicted language and its score in 0 to 1.

    Null, empty and letterless texts give `und` and 0.0; every other text, of any length, gives
    a learned language. Without any learned language all rows are `und`. Repeated rows get the
    same answer. Columns of the input named like the two new ones are replaced.
    """
    known = Ranks(profiles, size)

    @F.arrow_udf("pred string, score double")
    def nearest(texts: pa.Array) -> pa.Array:
        found = [known.predict(t.as_py()) for t in texts]
        release()
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()),
                                           pa.array([f[1] for f in found], pa.float64())],
                                          names=["pred", "score"])

    kept = [c for c in docs.columns if c.lower() not in (lang_pred.lower(), score.lower())]
    found = fresh("_is", kept)
    return (docs.select(*(column(docs, c) for c in kept),
                        nearest(column(docs, text).cast("string")).alias(found))
            .select(*("`" + c.replace("`", "``") + "`" for c in kept),
                    F.col(f"{found}.pred").alias(lang_pred), F.col(f"{found}.score").alias(score)))


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def predictions(docs: DataFrame) -> DataFrame:
    """Contract of op1: doc_id, held_out, lang_pred, score of every document.

    Profiles are learned from the documents with a language that are not held out.
    """
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    profiles = learn_profiles(rows.where(~F.col("held_out")))
    return identify(rows.select("doc_id", "held_out", "text"), profiles).select(
        "doc_id", "held_out", "lang_pred", "score")
