"""Nested tables derived from the flat test tables.

Every list comes from within one row, so none is gathered from a group of unknown
size, and nothing is merged: an element for every piece of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in TABLES}


def lines_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, one element per line of its text; every bin is represented."""
    return table(spark, sf_dir, "documents").selectExpr(
        "*", "coalesce(split(text, '\n'), array()) as cut").selectExpr(
        "doc_id as event_id", "cast(n_chars as double) as met", "source as status",
        "array(cast(n_chars as double)) as vtx",
        "transform(cut, l -> cast(length(l) as double)) as qty",
        "transform(cut, (l, i) -> i + 1) as line",
        "transform(cut, l -> if(length(l) > 80, 'R', if(length(l) > 20, 'A', 'N'))) as flag",
        "cast(array() as array<float>) as gone",
        "transform(cut, l -> array(cast(length(l) as double), cast(size(split(l, ' ')) as double)))"
        " as pairs",
        "struct(source as origin, date_add(date'2024-01-01', cast(doc_id as int)) as day) as info",
        "map('source', source, 'lang', lang) as attrs")


def documents_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, its text cut into words, lines and sentences."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang", "source", "split(text, ' ') as words",
        "transform(split(text, ' '), w -> length(w)) as word_len",
        "split(text, '\n') as lines",
        "transform(split(text, '\n'), l -> split(l, ' ')) as line_words",
        "transform(split(text, '\n'), l -> transform(split(l, '[.] '), s -> split(s, ' ')))"
        " as sentence_words")


def turns_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn of a conversation, with its words and its words per line."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "array(role) as speaker", "split(text, ' ') as words",
        "transform(split(text, '\n'), l -> split(l, ' ')) as line_words")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")
