"""The commands: scan a table, flatten it at once, or flatten from a stored scan."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from flatweave.operators.census import census, census_rows
from flatweave.operators.flatten import flatten
from flatweave.operators.samples import SAMPLE_ROWS
from flatweave.plans.layout import FlatLayout, flat_layout
from flatweave.plans.policy import resolve_tags
from flatweave.plans.report import build_report, refuse_to_replace
from flatweave.sources.canonical import Canonical, read_canonical
from flatweave.sources.discovery import choose_table, largest_by_bytes, tables_in
from flatweave.sources.flat_csv import PLAIN, WIDE_THRESHOLD, write_flat
from flatweave.sources.manifest import (Manifest, canonical_path, manifest_path, read_census,
                                        read_manifest, write_census, write_meta)

Tags = Mapping[str, int] | Iterable[str] | None
Policies = Mapping[str, str] | DataFrame | None


@dataclass(frozen=True)
class Flat:
    """A flat table still to be computed, with the table and layout it comes from."""
    table: DataFrame
    layout: FlatLayout

    def frame(self, form: str = "columns") -> DataFrame:
        return flatten(self.table, self.layout, form)

    def write(self, path: str, name: str = "flat", wide_threshold: int = WIDE_THRESHOLD,
              compression: str = PLAIN) -> DataFrame:
        """Write as CSV; store and return the one-row build report.

        Only a missing or empty folder, or that of another flat table, is written to.
        ``compression`` is a codec of Spark's text files, such as gzip.
        """
        refuse_to_replace(self.table.sparkSession, path)
        facts = write_flat(self.table, self.layout, path, wide_threshold, compression)
        return build_report(self.table.sparkSession, name, path, self.layout, facts)


def count_rows(df: DataFrame, columns: list) -> int:
    """Rows of a profiled table, from its census where a list column counted them."""
    counted = [r["n_events"] for r in columns if r["n_events"] is not None]
    return counted[0] if counted else df.count()


def scan(df: DataFrame, out_dir: str, name: str, *, tags: Tags = None, note: str | None = None,
         write_parquet: bool = True, samples: int = SAMPLE_ROWS, deep_profile: bool = True,
         order_by: list[str] | None = None, source: str | None = None,
         table: str | None = None, all_tables: list[str] | None = None) -> Manifest:
    """Profile ``df`` and store its census, and its lists-intact copy, in ``out_dir``.

    With a copy, the source is computed once: the copy is written first and then profiled.
    """
    stamped = resolve_tags(tags)
    path = manifest_path(out_dir, name)
    copy = Canonical(df, canonical_path(out_dir, name), stamped) if write_parquet else None
    measured, started = copy.measured if copy else df, time.monotonic()
    write_census(census(measured, deep_profile, samples, order_by), path)
    columns = read_census(df.sparkSession, path)
    seconds = time.monotonic() - started
    rows = count_rows(measured, columns)
    meta = {"name": name, "source": source, "table": table, "all_tables": all_tables,
            "n_events": rows, "note": note, "generated": datetime.now(), "census_seconds": seconds,
            "canonical_parquet": copy.finish(columns) if copy else None, "tags": stamped}
    write_meta(df.sparkSession, meta, path)
    return read_manifest(df.sparkSession, out_dir, name)


def table_name(path: str, format: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1].removesuffix(f".{format}")


def scan_path(spark: SparkSession, path: str, out_dir: str, name: str | None = None, *,
              table: str | None = None, format: str = "parquet", by: str = "rows",
              **options) -> Manifest:
    """Scan one table of a directory, or the table at ``path`` itself.

    In a directory that is the named table, or else the one with most rows;
    ``by="bytes"`` takes the one whose files are largest in sum instead.
    """
    if by not in ("rows", "bytes"):
        raise ValueError(f"by must be rows or bytes, got: {by}")
    tables = tables_in(spark, path, format)
    if by == "bytes" and table is None and tables:
        table = largest_by_bytes(spark, path, format)
    if not tables:
        tables = {table_name(path, format): spark.read.format(format).load(path)}
    chosen, df = choose_table(tables, table)
    return scan(df, out_dir, name or chosen, source=path, table=chosen,
                all_tables=sorted(tables), **options)


def quick_flat(df: DataFrame, *, tags: Tags = None, fill: float | str | None = None,
               policies: Policies = None) -> Flat:
    """Profile and lay out in one call. Only the census comes to the driver."""
    rows = census_rows(census(df))
    return Flat(df, flat_layout(df.schema, rows, policies=policies, tags=tags, fill=fill))


def quick_path(spark: SparkSession, path: str, out_dir: str, name: str | None = None, *,
               tags: Tags = None, fill: float | str | None = None, policies: Policies = None,
               **options) -> Flat:
    """Scan a path and lay out the stored copy, in one call.

    Manifest and copy stay, also if the flat table cannot be written. ``options`` are those of
    ``scan_path``.
    """
    stored = scan_path(spark, path, out_dir, name, tags=tags, **options)
    return flat_from_scan(spark, out_dir, fill=fill, policies=policies, name=stored.meta["name"])


def flat_from_scan(spark: SparkSession, scan_dir: str, *, tags: Tags = None,
                   fill: float | str | None = None, policies: Policies = None,
                   name: str = "*") -> Flat:
    """Lay out from a stored scan; neither the source nor a second profile is needed.

    Policies are those of the census, as ``set_policies`` left them, or overridden here; tags
    given here win over stored ones.
    """
    manifest = read_manifest(spark, scan_dir, name)
    table = read_canonical(spark, manifest.meta["canonical_parquet"],
                           canonical_path(scan_dir, manifest.meta["name"]))
    merged = {**manifest.tags, **resolve_tags(tags)}
    layout = flat_layout(table.schema, manifest.columns, policies=policies, tags=merged, fill=fill)
    return Flat(table, layout)
