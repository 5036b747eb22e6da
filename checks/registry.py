"""One query per operator; each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import (documents_nested, embeddings, lines_nested, table, tables,
                             turns_nested)
from flatweave.operators import summary
from flatweave.operators.census import census
from flatweave.operators.lengths import length_histogram, length_stats, list_lengths
from flatweave.operators.samples import sample_values
from flatweave.plans.report import fingerprint
from flatweave.plans.workflows import flat_from_scan, quick_flat, scan
from flatweave.session import shared_folder
from flatweave.sources.canonical import read_canonical
from flatweave.sources.discovery import largest_table
from flatweave.sources.flat_csv import CSV_OPTIONS
from flatweave.sources.manifest import set_policies

Query = Callable[[SparkSession, str], DataFrame]

WIDE_LIST = "word_len"


# Sources and sinks

def q_largest_table(spark, sf_dir):
    return largest_table(tables(spark, sf_dir))


def q_canonical_roundtrip(spark, sf_dir):
    out = shared_folder(spark)
    stored = scan(lines_nested(spark, sf_dir), out, "lines", samples=0, tags={"is_document": 1})
    copy = read_canonical(spark, stored.meta["canonical_parquet"])
    return copy.select(
        "event_id", "met", "status", "is_document",
        F.array_join(F.col("vtx").cast("array<string>"), "|").alias("vtx"),
        F.array_join(F.col("qty").cast("array<bigint>").cast("array<string>"), "|").alias("qty"),
        F.array_join(F.col("line").cast("array<string>"), "|").alias("line"),
        F.array_join("flag", "|").alias("flag"),
        F.to_json("pairs").alias("pairs"), F.to_json("info").alias("info"),
        F.lit(len(copy.columns)).alias("n_columns"))


def q_from_manifest_flat(spark, sf_dir):
    out = shared_folder(spark)
    scan(lines_nested(spark, sf_dir), out, "lines", samples=0, tags={"is_document": 1, "year": 1})
    set_policies(spark, out, {"qty": "first:3", "flag": "drop"})
    flat = flat_from_scan(spark, out, tags=["year=2"], fill="-1")
    return flat.frame()


def q_csv_roundtrip(spark, sf_dir):
    flat = quick_flat(lines_nested(spark, sf_dir))
    out = shared_folder(spark)
    flat.write(out, compression="gzip")
    return spark.read.schema(flat.frame().schema).options(**CSV_OPTIONS).csv(out)


def q_wide_csv_lines(spark, sf_dir):
    """Thousands of columns, one per word of the longest document, most of them fill cells."""
    documents = documents_nested(spark, sf_dir).select("doc_id", WIDE_LIST)
    out = shared_folder(spark)
    quick_flat(documents).write(out, wide_threshold=0, compression="gzip")
    return (spark.read.text(out).where(~F.col("value").startswith("doc_id"))
            .select(F.substring_index("value", ",", 1).cast("bigint").alias("doc_id"),
                    F.col("value").alias("line")))


def q_csv_roundtrip_one_column(spark, sf_dir):
    """A table of one column with blank cells: a row each, none skipped by the reader."""
    blank = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, F.col("lang"))
    out = shared_folder(spark)
    quick_flat(table(spark, sf_dir, "documents").select(blank.alias("lang"))).write(out)
    read = spark.read.schema("lang string").options(**CSV_OPTIONS).csv(out)
    return read.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(
        F.count(F.lit(1)).alias("n_rows"))


# Profiling

def q_list_lengths(spark, sf_dir):
    return list_lengths(documents_nested(spark, sf_dir), keep=["doc_id"])


def q_list_lengths_lines(spark, sf_dir):
    return list_lengths(lines_nested(spark, sf_dir), keep=["event_id"])


def q_length_histogram(spark, sf_dir):
    return length_histogram(lines_nested(spark, sf_dir))


def q_length_histogram_documents(spark, sf_dir):
    return length_histogram(documents_nested(spark, sf_dir))


def stats_of(nested):
    return length_stats(length_histogram(nested))


def q_length_stats(spark, sf_dir):
    return stats_of(documents_nested(spark, sf_dir)).select(
        "name", "axis", "len_min", F.round("len_med", 6).alias("len_med"),
        F.round("len_p95", 6).alias("len_p95"), "len_max")


def q_fill_fraction(spark, sf_dir):
    return stats_of(lines_nested(spark, sf_dir)).select(
        "name", "axis", F.round("fill_frac", 6).alias("fill_frac"))


def q_spacer_count(spark, sf_dir):
    return (stats_of(lines_nested(spark, sf_dir)).where("axis = 1")
            .select("name", "n_events", "n_spacers"))


def q_classify_columns(spark, sf_dir):
    return census(lines_nested(spark, sf_dir)).select("name", "category")


def q_fanout(spark, sf_dir):
    return census(lines_nested(spark, sf_dir)).select("name", "max_len", "fanout")


def inventory(nested):
    return summary.deep_inventory(census(nested)).select(
        "name", "ndim", F.array_join(F.col("axis_max_lens").cast("array<string>"), "x").alias("axes"),
        F.col("dtype").alias("leaf"))


def q_deep_axes(spark, sf_dir):
    return inventory(documents_nested(spark, sf_dir))


def q_deep_axes_lines(spark, sf_dir):
    return inventory(lines_nested(spark, sf_dir))


def q_deep_fanout(spark, sf_dir):
    return (census(documents_nested(spark, sf_dir)).where("category = 'jagged_deep'")
            .select("name", "hypo_cols", "fanout"))


def q_sample_values(spark, sf_dir):
    found = sample_values(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars"),
                          order_by=["doc_id"])
    return found.select("name", F.get("samples", F.lit(0)).alias("first"),
                        F.get("samples", F.lit(1)).alias("second"))


def census_view(nested):
    """The census with its lists as text and its fractions rounded, for comparison."""
    return census(nested).select(
        "name", "category", "policy", "type", "dtype", "ndim", "max_len", "len_min",
        F.round("len_med", 6).alias("len_med"), F.round("len_p95", 6).alias("len_p95"), "len_max",
        F.round("fill_frac", 6).alias("fill_frac"), "n_spacers", "fanout",
        F.array_join(F.col("axis_max_lens").cast("array<string>"), "x").alias("axes"),
        "hypo_cols", "reason")


def q_census(spark, sf_dir):
    return census_view(lines_nested(spark, sf_dir))


def q_census_documents(spark, sf_dir):
    return census_view(documents_nested(spark, sf_dir))


def q_census_turns(spark, sf_dir):
    return census_view(turns_nested(spark, sf_dir))


def q_census_embeddings(spark, sf_dir):
    return census_view(embeddings(spark, sf_dir))


def q_bin_summary(spark, sf_dir):
    return summary.bin_summary(census(lines_nested(spark, sf_dir)))


def q_projected_columns(spark, sf_dir):
    return summary.projected_columns(census(lines_nested(spark, sf_dir)), n_tags=1)


def q_projected_spacers(spark, sf_dir):
    return summary.projected_spacers(census(documents_nested(spark, sf_dir)))


def q_column_audit(spark, sf_dir):
    return summary.column_audit(census(lines_nested(spark, sf_dir)))


def q_outlier_signal(spark, sf_dir):
    found = summary.outlier_signal(census(documents_nested(spark, sf_dir)))
    return found.select("name", *[F.round(c, 6).alias(c) for c in found.columns if c != "name"])


# Flattening

def q_flat_scalar(spark, sf_dir):
    nested = lines_nested(spark, sf_dir).select("status", "event_id", "met")
    return quick_flat(nested).frame()


def q_flat_struct(spark, sf_dir):
    return quick_flat(lines_nested(spark, sf_dir).select("event_id", "info")).frame()


def q_flat_vec1(spark, sf_dir):
    return quick_flat(turns_nested(spark, sf_dir).select("conv_id", "turn", "speaker")).frame()


def q_flat_pad_max(spark, sf_dir):
    return quick_flat(lines_nested(spark, sf_dir).select("event_id", "qty", "line")).frame()


def q_flat_first_n(spark, sf_dir):
    nested = documents_nested(spark, sf_dir).select("doc_id", "words", "word_len", "lines")
    policies = {"words": "first: 4", "word_len": "first:+2", "lines": "first:-1"}
    return quick_flat(nested, policies=policies).frame()


def q_flat_drop(spark, sf_dir):
    nested = lines_nested(spark, sf_dir).select("event_id", "vtx", "qty", "flag")
    # On anything but a variable list the policy has no effect.
    return quick_flat(nested, policies={"qty": "drop", "vtx": "drop", "event_id": "drop"}).frame()


def q_flat_bad_policy(spark, sf_dir):
    nested = lines_nested(spark, sf_dir).select("event_id", "line", "flag")
    return quick_flat(nested, policies={"line": "first:many", "flag": "widest"}).frame()


def q_flat_fill_nan(spark, sf_dir):
    nested = lines_nested(spark, sf_dir).select("event_id", "qty", "line")
    flat = quick_flat(nested, fill="NaN").frame()
    return flat.select("event_id", *[F.when(~F.isnan(c), F.col(c)).alias(c)
                                     for c in flat.columns if c != "event_id"])


def q_flat_fill_x(spark, sf_dir):
    nested = lines_nested(spark, sf_dir).select("event_id", "line", "flag")
    return quick_flat(nested, fill="X").frame()


def q_flat_tags(spark, sf_dir):
    nested = lines_nested(spark, sf_dir).select("event_id", "status")
    return quick_flat(nested, tags=["is_document=1", "era = -7"]).frame()


def q_flat_embeddings(spark, sf_dir):
    return quick_flat(embeddings(spark, sf_dir)).frame()


def q_quick_flat(spark, sf_dir):
    return quick_flat(lines_nested(spark, sf_dir), tags={"is_document": 1}).frame()


def q_padded_arrays(spark, sf_dir):
    nested = lines_nested(spark, sf_dir).select("event_id", "qty", "line", "flag")
    padded = quick_flat(nested).frame("arrays")
    return (padded.select("event_id", F.posexplode(F.arrays_zip("qty", "line", "flag")).alias("slot", "cells"))
            .select("event_id", "slot", "cells.qty", "cells.line", "cells.flag"))


def q_build_report(spark, sf_dir):
    flat = quick_flat(lines_nested(spark, sf_dir), tags={"is_document": 1},
                      policies={"flag": "drop", "line": "first:0"})
    return flat.write(shared_folder(spark), name="lines").select(
        "name", "n_columns", "n_rows", "fill", "n_dropped",
        F.array_join("dropped", ",").alias("dropped"), F.array_join("tags", ",").alias("tags"))


def q_invariant_check(spark, sf_dir):
    """Default policies: one build or two, the same table, as wide and as padded as projected."""
    nested, out = lines_nested(spark, sf_dir), shared_folder(spark)
    stored = scan(nested, out, "lines", samples=0)
    quick, rebuilt = quick_flat(nested), flat_from_scan(spark, out)
    flat, again = quick.frame("arrays"), rebuilt.frame("arrays")
    fills = F.expr("sum(" + " + ".join(f"size(filter({c}, x -> x = -999))" for c in ("qty", "line"))
                   + ")").alias("fill_cells")
    spacers = sum(r["n_spacers"] for r in stored.columns if r["name"] in ("qty", "line"))
    projected = sum(r["fanout"] for r in stored.columns
                    if r["category"] in ("scalar", "vec1", "jagged"))
    # A row of arrays has the print of the wide row, and wide names come from the layout.
    prints = fingerprint(flat, fills).unionAll(fingerprint(again, fills))
    return prints.agg(
        F.max("n_rows").alias("n_rows"),
        (F.countDistinct("n_rows", "print_a", "print_b", "fill_cells") == 1).alias("same_rows"),
        F.lit(quick.frame().columns == rebuilt.frame().columns).alias("same_columns"),
        F.lit(len(quick.frame().columns) == projected).alias("as_projected"),
        F.max("fill_cells").alias("fill_cells"), F.lit(spacers).cast("bigint").alias("n_spacers"))


def queries() -> dict[str, Query]:
    return {name.removeprefix("q_"): f for name, f in globals().items() if name.startswith("q_")}
