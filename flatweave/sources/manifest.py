"""A stored census: one JSON line per column, its policies editable, plus one row of facts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from flatweave.operators.census import CENSUS_SCHEMA

VERSION = "0.1.0"

META_SCHEMA = (
    "name string, source string, table string, all_tables array<string>, n_events bigint, "
    "note string, generated timestamp, census_seconds double, canonical_parquet string, "
    "tool_version string, tags array<struct<name:string,value:int>>")


EDIT_SCHEMA = "name string, policy string, edited timestamp"


@dataclass(frozen=True)
class Manifest:
    meta: Row
    tags: dict[str, int]
    columns: list[Row]
    path: str

    @property
    def readable(self) -> list[Row]:
        return [r for r in self.columns if r["category"] != "unreadable"]

    @property
    def unreadable(self) -> list[Row]:
        return [r for r in self.columns if r["category"] == "unreadable"]

    def census(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.columns, CENSUS_SCHEMA)


def manifest_path(scan_dir: str, name: str) -> str:
    return f"{scan_dir.rstrip('/')}/{name}_manifest"


def canonical_path(scan_dir: str, name: str) -> str:
    return f"{scan_dir.rstrip('/')}/{name}_canonical.parquet"


def write_census(census: DataFrame, path: str) -> None:
    """Store a census; edits of an earlier one go."""
    # One row per column of the profiled table.
    census.coalesce(1).write.mode("overwrite").json(f"{path}/census")
    store_edits(census.sparkSession, [], path, "overwrite")


def store_edits(spark: SparkSession, edits: list[tuple], path: str, mode: str) -> None:
    (spark.createDataFrame(edits, EDIT_SCHEMA)
     .coalesce(1).write.mode(mode).json(f"{path}/policies"))


def read_census(spark: SparkSession, path: str) -> list[Row]:
    """The stored census under the policies last set; a broken line fails."""
    reader = spark.read.option("mode", "FAILFAST")
    rows = reader.schema(CENSUS_SCHEMA).json(f"{path}/census").collect()
    try:  # one row per edit
        edits = reader.schema(EDIT_SCHEMA).json(f"{path}/policies").orderBy("edited", "name").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        edits = []
    policies = {e["name"]: e["policy"] for e in edits}
    return [Row(**(r.asDict() | {"policy": policies.get(r["name"], r["policy"])})) for r in rows]


def set_policies(spark: SparkSession, scan_dir: str, policies: Mapping[str, str],
                 name: str = "*") -> Manifest:
    """Change policies of a stored scan. They are added to it: nothing stored is rewritten."""
    stored = read_manifest(spark, scan_dir, name)
    unknown = sorted(set(policies) - {r["name"] for r in stored.columns})
    if unknown:
        raise ValueError(f"policies for columns that do not exist: {unknown}")
    now = datetime.now()
    store_edits(spark, [(k, v, now) for k, v in policies.items()], stored.path, "append")
    return read_manifest(spark, scan_dir, stored.meta["name"])


def write_meta(spark: SparkSession, meta: dict, path: str) -> None:
    """Store the facts of a scan; tags are a list, as their order is that of the columns."""
    stored = meta | {"tool_version": VERSION, "tags": list(meta["tags"].items())}
    (spark.createDataFrame([stored], META_SCHEMA)
     .coalesce(1).write.mode("overwrite").json(f"{path}/meta"))


def read_manifest(spark: SparkSession, scan_dir: str, name: str = "*") -> Manifest:
    """The manifest of that name, or the one manifest of a scan directory."""
    pattern = manifest_path(scan_dir, name)
    try:
        metas = (spark.read.schema(META_SCHEMA).json(f"{pattern}/meta")
                 .select("*", "_metadata.file_path").collect())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        metas = []
    if len(metas) != 1:
        raise ValueError(f"expected exactly one manifest in {scan_dir}, found {len(metas)}: "
                         f"{sorted(m['name'] for m in metas)}")
    path = manifest_path(scan_dir, metas[0]["name"])
    tags = {t["name"]: t["value"] for t in metas[0]["tags"] or []}
    return Manifest(metas[0], tags, read_census(spark, path), path)
