"""List-length statistics, all derived from one length histogram."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.functions.lists import length_source, list_length, longest_list
from flatweave.functions.names import quoted
from flatweave.operators.shapes import ColumnShape, column_shapes

HISTOGRAM_SCHEMA = "name string, axis int, len bigint, n bigint"


def list_columns(shapes: list[ColumnShape]) -> list[ColumnShape]:
    return [s for s in shapes if s.readable and s.ndim > 1]


def list_lengths(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Length of each list column, row by row, next to the ``keep`` columns."""
    fields = {f.name: f for f in df.schema.fields}
    lengths = [f"{list_length(length_source(fields[s.name]))} as {quoted(s.name)}"
               for s in list_columns(column_shapes(df.schema))]
    return df.selectExpr(*map(quoted, keep or []), *lengths)


def length_histogram(df: DataFrame, deep: bool = True) -> DataFrame:
    """Rows per (column, axis, length).

    Axis 1 is the list itself; on deeper axes a row counts once, under its
    longest list at that depth. The rows reaching the shuffle are the distinct
    lengths each task saw, whatever the size of the table: every length is
    keyed by two integers and counted on the map side. The table is read once, however many
    lists it has.
    """
    fields = {f.name: f for f in df.schema.fields}
    # Deep columns last: their inner loops are interpreted and kept apart from the rest.
    listed = sorted(list_columns(column_shapes(df.schema)), key=lambda s: s.ndim > 2)
    entries = [(s.name, axis) for s in listed for axis in range(1, s.ndim if deep else 2)]
    if not entries:
        return df.sparkSession.createDataFrame([], HISTOGRAM_SCHEMA)

    lengths = [list_length(length_source(fields[name])) if axis == 1
               else longest_list(quoted(name), axis) for name, axis in entries]
    labels = F.from_json(
        F.lit(json.dumps([{"name": name, "axis": axis} for name, axis in entries])),
        "array<struct<name:string,axis:int>>")
    names = [f"len{i}" for i in range(len(entries))]
    # Measured first and exploded after, so that exploding and counting compile
    # together even where measuring is interpreted.
    measured = df.selectExpr(*[f"{x} as {name}" for x, name in zip(lengths, names)])
    counted = (measured.selectExpr(f"posexplode(array({', '.join(names)})) as (pos, len)")
                 .groupBy("pos", "len").agg(F.count(F.lit(1)).alias("n")))
    label = F.get(labels, F.col("pos"))
    # Never NULL, so no null check on names is pushed below the counting.
    return counted.select(F.coalesce(label["name"], F.lit("")).alias("name"), label["axis"].alias("axis"),
                          F.col("len").cast("bigint").alias("len"), "n")


def length_stats(histogram: DataFrame) -> DataFrame:
    """Minimum, median, p95, maximum, fill fraction and spacers per column and axis.

    Percentiles are exact and interpolate linearly. The input is the histogram,
    so the work depends on distinct lengths and not on rows.
    """
    # Grouped by name up front: nothing per column is shuffled a second time. A task holds the
    # distinct lengths of its columns, bounded by the longest list and not by rows.
    grouped = histogram.repartition("name").groupBy("name", "axis").agg(*map(F.expr, (
        "sum(n) as n_events",
        "cast(min(len) as int) as len_min",
        "percentile(len, array(0.5, 0.95), n) as pct",
        "cast(max(len) as int) as len_max",
        "sum(if(len > 0, n, 0)) / sum(n) as fill_frac",
        "max(len) * sum(n) - sum(len * n) as n_spacers")))
    return grouped.selectExpr("name", "axis", "n_events", "len_min", "pct[0] as len_med",
                              "pct[1] as len_p95", "len_max", "fill_frac", "n_spacers")
