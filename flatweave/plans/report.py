"""Facts about a finished build, and checks that two builds agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from flatweave.functions.names import quoted
from flatweave.plans.layout import FlatLayout
from flatweave.sources.discovery import entries, folder_bytes
from flatweave.sources.flat_csv import WriteFacts

REPORT_SCHEMA = ("name string, path string, n_columns bigint, n_rows bigint, bytes bigint, "
                 "fill string, tags array<string>, n_dropped bigint, dropped array<string>, "
                 "seconds double")


def report_path(path: str) -> str:
    """The report lies in the folder of its table; readers skip names with an underscore."""
    return f"{path.rstrip('/')}/_report"


def build_report(spark: SparkSession, name: str, path: str, layout: FlatLayout,
                 facts: WriteFacts) -> DataFrame:
    """Store and return one row on a written flat table.

    Reads no data: rows were counted by the write.
    """
    report = spark.createDataFrame(
        [(name, path, layout.n_columns, facts.rows, folder_bytes(spark, path), str(layout.fill),
          list(layout.tags), len(layout.dropped), layout.dropped, facts.seconds)], REPORT_SCHEMA)
    report.coalesce(1).write.mode("overwrite").json(report_path(path))
    return report


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The stored report of the flat table at ``path``."""
    return spark.read.schema(REPORT_SCHEMA).option("mode", "FAILFAST").json(report_path(path))


def refuse_to_replace(spark: SparkSession, path: str) -> None:
    """A flat table may replace another one, and nothing else: no source, scan or copy."""
    held = [e.name for e in entries(spark, path)]
    if held and "_report" not in held:
        raise ValueError(f"{path} holds something else than a flat table, choose another folder")


def null_marks(expr: str, kind: DataType) -> str:
    """Which parts of a value are NULL, as booleans in the value's own shape."""
    if isinstance(kind, ArrayType):
        return f"transform({expr}, x -> {null_marks('x', kind.elementType)})"
    if isinstance(kind, StructType):
        parts = [null_marks(f"{expr}.{quoted(f.name)}", f.dataType) for f in kind]
        return f"named_struct('is', isnull({expr}){''.join(f', {chr(39)}p{i}{chr(39)}, {x}' for i, x in enumerate(parts))})"
    return f"isnull({expr})"


def row_print(df: DataFrame, salt: str) -> Column:
    """A hash of all cells of a row, values first and then what is NULL, as hashing skips NULLs.

    A list folds into the hash element by element, so a row of padded arrays has the print of the
    same row with a column per slot. Whole lists are told from NULL by `list_print`.
    """
    cells = [*(quoted(c) for c in df.columns),
             *(null_marks(quoted(f.name), f.dataType) for f in df.schema)]
    return F.expr(f"xxhash64('{salt}', {', '.join(cells)})")


def list_print(df: DataFrame) -> Column:
    """How many elements each list has, NULL lists apart; constant for a table of padded arrays."""
    lists = [f"coalesce(size({quoted(f.name)}), -1)" for f in df.schema if isinstance(f.dataType, ArrayType)]
    return F.expr(f"xxhash64({', '.join(lists)})") if lists else F.lit(0).cast("long")


def fingerprint(df: DataFrame, *more: Column) -> DataFrame:
    """A row-order-free print of a table: its count and two sums of row hashes.

    Equal tables have equal prints; two tables that differ in a row agree with a chance of about
    2^-64. Each task reduces its rows to one, so nothing wide is shuffled, and every cell is
    hashed once. Further aggregates are taken along in the same pass.
    """
    printed = df.select("*", row_print(df, "a").alias("_print"), list_print(df).alias("_lists"))
    total = lambda x: F.coalesce(F.sum(x.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return printed.agg(F.count(F.lit(1)).alias("n_rows"), total(F.col("_print")).alias("print_a"),
                       total(F.xxhash64(F.lit("b"), "_print", "_lists")).alias("print_b"), *more)


def same_table(left: DataFrame, right: DataFrame) -> bool:
    """Equal column names in order, and equal rows however ordered."""
    return left.columns == right.columns and fingerprint(left).first() == fingerprint(right).first()
