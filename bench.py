"""Time the headline queries and print one JSON line.

Every query runs twice on the whole tables of $BENCH_SF_DIR and the better time
counts; results go to a sink that computes every row and keeps none, except for
queries that write files themselves. Nested tables are made and stored before the clock starts.

Two cases more: one list column per word of a text, nearly all fill; and a dense table of the
published shape, 423 rows and 62 lists of 400 elements, all there, cut from the texts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from checks import registry  # noqa: E402
from checks.fixtures import documents_nested, lines_nested, turns_nested  # noqa: E402
from flatweave import census, quick_flat  # noqa: E402
from flatweave.session import configured, shared_folder  # noqa: E402

HEADLINE = ("largest_table", "list_lengths", "length_histogram", "length_stats", "census",
            "census_documents", "bin_summary", "outlier_signal", "sample_values", "flat_struct",
            "flat_pad_max", "flat_first_n", "flat_fill_x", "flat_embeddings", "quick_flat",
            "padded_arrays", "canonical_roundtrip", "from_manifest_flat", "csv_roundtrip",
            "build_report", "invariant_check")
RUNS = 2
WORDS = registry.WIDE_LIST


def session(cpus: str) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("flatweave-bench")
               .config("spark.sql.shuffle.partitions", cpus)
               .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    spark = configured(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored(frame: DataFrame) -> DataFrame:
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def dense(documents: DataFrame, rows: int = 423, lists: int = 62, length: int = 400) -> DataFrame:
    """Whole runs of so many words, one row each, their lengths as so many columns."""
    runs = documents.selectExpr("doc_id", WORDS + " as words").selectExpr(
        "doc_id", f"posexplode(transform(sequence(0, cast(size(words) / {length} as int)), "
                  f"i -> slice(words, i * {length} + 1, {length}))) as (run, words)")
    return (runs.where(f"size(words) = {length}").orderBy("doc_id", "run").limit(rows)
            .selectExpr("doc_id", "run", *(f"transform(words, w -> cast(w * {k} as double)) as list{k}"
                                           for k in range(1, lists + 1))))


def best(action) -> float:
    times = []
    for _ in range(RUNS):
        started = time.monotonic()
        action()
        times.append(time.monotonic() - started)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    for make in (documents_nested, lines_nested, turns_nested):
        made = stored(make(spark, sf_dir))
        setattr(registry, make.__name__, lambda spark, sf_dir, made=made: made)
    known, seconds = registry.queries(), {}
    for name in HEADLINE:
        seconds[name] = best(lambda: known[name](spark, sf_dir)
                             .write.format("noop").mode("overwrite").save())

    # Census, then flatten and write, as separate steps: on the widest column, and a dense table.
    nested, cases = registry.documents_nested(spark, sf_dir), {}
    for case, frame in (("wide", nested.select("doc_id", WORDS)), ("dense", stored(dense(nested)))):
        seconds[f"{case}_census"] = best(lambda: census(frame).collect())
        flat, out, report = quick_flat(frame), shared_folder(spark), {}
        seconds[f"{case}_csv"] = best(lambda: report.update(flat.write(out).first().asDict()))
        cells = report["n_rows"] * report["n_columns"]
        cases[f"{case}_csv"] = {
            "rows": report["n_rows"], "columns": report["n_columns"], "bytes": report["bytes"],
            "bytes_per_cell": round(report["bytes"] / max(cells, 1), 2),
            "cells_per_sec": round(cells / seconds[f"{case}_csv"])}
    print(json.dumps({
        "metric": "total seconds of the headline queries, best of two runs each",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        **cases}))
    spark.stop()


if __name__ == "__main__":
    main()
