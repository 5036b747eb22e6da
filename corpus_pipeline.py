"""The corpus pipeline: documents through five stages, each calling one training-data operator.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents. A stage adds
columns only under names that clash with none, so any further columns pass as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatweave.llm import jaccard, language, mixing, packing, substrings
from flatweave.llm.bloom import split_by_keys
from flatweave.llm.common import column, fresh, stored, table
from flatweave.llm.text import release

#: A text whose profile agrees less than this with every language is no language.
LEAST_SCORE = 0.2
#: Tokens of the mixture as a share of the input's, and how often a document is taken at most.
FRACTION, EPOCHS = 1.0, 2


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or whose profile is near that of no language.

    If no row has a language to learn, only those without a letter go.
    """
    profiles = language.learn_profiles(docs)
    if not profiles:
        return docs.where(column(docs, "text").cast("string").rlike(r"\p{L}"))
    pred, score = (fresh(n, docs.columns) for n in ("_lang_pred", "_score"))
    marked = language.identify(docs, profiles, lang_pred=pred, score=score)
    return marked.where((F.col(pred) != language.UNKNOWN)
                        & (F.col(score) >= LEAST_SCORE)).drop(pred, score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest id stays, and of repeated rows one.

    A document is a distinct pair of id and text. Those without an id come last; among equals
    a hash of id and text decides. Rows are repeated if they are equal in id and text; the one
    that stays is told by a hash of all its columns.
    """
    name = fresh("_key", docs.columns)
    text, doc_id = column(docs, "text").cast("string"), column(docs, "doc_id").cast("long")
    keyed = docs.withColumn(name, jaccard.document_key(doc_id, text))
    rows = keyed.select(F.col(name).alias("key"), doc_id.alias("doc_id"), text.alias("text"))
    _, found = jaccard.linked_components(rows)
    names = stored(rows.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")))
    placed = found.join(names, "key")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = placed.groupBy("component").agg(F.min(rank).alias("first"))
    gone = stored(placed.join(first, "component").where("key <> first.key").select("key"))
    repeated = names.where("n > 1").select("key")
    # Only rows that go, or are repeated, are shuffled with their texts.
    alone, perhaps = split_by_keys(keyed, F.col(name), gone.unionAll(repeated).distinct())
    kept = perhaps.join(gone, F.col(name) == F.col("key"), "left_anti")
    row = F.struct(*(column(kept, c).alias(c) for c in docs.columns))
    one = (kept.groupBy(name).agg(F.max_by(row, F.xxhash64(F.to_json(row))).alias("_row"))
           .select("_row.*"))
    return alone.drop(name).unionByName(one)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes go that an earlier text holds too; a text of which nothing is left goes whole."""
    names = [fresh(n, docs.columns) for n in ("_doc", "_tie", "_runs")]
    doc, tie = substrings.keyed(column(docs, "doc_id"), column(docs, "text").cast("string"))
    rows = docs.withColumns(dict(zip(names, (doc, tie))))
    runs = stored(substrings.repeated_runs(rows.select(
        F.col(names[0]).alias("doc"), F.col(names[1]).alias("tie"),
        column(rows, "text").cast("string").alias("text")))
        .groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "windows")).alias("runs")))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        done = pa.array([_cut(t.as_py(), some.as_py()) for t, some in zip(texts, found)], pa.string())
        release()
        return done

    # Only texts that may hold a repeat are shuffled.
    alone, perhaps = split_by_keys(rows, F.xxhash64(*names[:2]),
                                   runs.select(F.xxhash64("doc", "tie").alias("key")).distinct())
    # Merged, so that no task needs a worker for the filter and another one for the cut.
    joined = perhaps.join(runs.toDF(*names).hint("merge"), names[:2], "left")
    found, text = F.col(names[2]), column(joined, "text").cast("string")
    after = fresh("_cut", [*docs.columns, *names])
    joined = joined.withColumn(after, F.when(found.isNull(), text).otherwise(
        cut.asNondeterministic()(text, found)))  # else the filter would cut once more, in a second worker
    joined = joined.where(found.isNull() | (F.length(F.trim(after)) > 0))
    new = {"text": F.col(after), "n_chars": F.when(found.isNull(), F.col("n_chars")).otherwise(
        F.length(after)).cast("long")}
    return alone.drop(*names[:2]).unionByName(
        joined.select(*(new.get(c, column(joined, c)).alias(c) for c in docs.columns)))


def _cut(text: str | None, runs: list | None) -> str | None:
    if text is None or runs is None:
        return text
    body = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    gone = substrings.removed_bytes(len(body), np.array([r["start"] for r in runs]),
                                    np.array([r["windows"] for r in runs]))
    return body[~gone].tobytes().decode("utf-8", "ignore")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture has as many tokens as its input, dealt by the weights.

    A document of a scarce leaf comes as a row for every epoch that takes it; the last one that
    a leaf takes is cut at the token where the leaf's budget ends, and is then named by its
    own n_chars.
    """
    return mixing.taken_texts(docs, fraction=FRACTION, epochs=EPOCHS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens."""
    return packing.packed(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_languages),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
