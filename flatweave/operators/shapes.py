"""What the schema alone says about each column. Runs no job."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHAPE_SCHEMA = ("array<struct<name:string,type:string,source_type:string,"
                "dtype:string,ndim:int,reason:string>>")

#: Types with no flat shape: neither one cell nor a list of cells.
UNREADABLE = (T.MapType, T.VariantType, T.BinaryType, T.CalendarIntervalType,
              T.NullType, T.UserDefinedType)


@dataclass(frozen=True)
class ColumnShape:
    name: str
    type: str
    source_type: str
    dtype: str
    ndim: int
    reason: str | None

    @property
    def readable(self) -> bool:
        return self.reason is None


def nesting(data_type: T.DataType) -> tuple[int, T.DataType]:
    """Number of list levels plus one, and the type below the last level."""
    ndim = 1
    while isinstance(data_type, T.ArrayType):
        data_type = data_type.elementType
        ndim += 1
    return ndim, data_type


def column_shape(field: T.StructField) -> ColumnShape:
    ndim, leaf = nesting(field.dataType)
    declared = field.dataType.simpleString()
    reason = None
    if isinstance(leaf, UNREADABLE):
        reason = f"{leaf.simpleString()} has no flat shape"
    return ColumnShape(field.name, declared, field.metadata.get("source_type", declared),
                       leaf.simpleString(), ndim, reason)


def column_shapes(schema: T.StructType) -> list[ColumnShape]:
    names = [f.name for f in schema.fields]
    repeated = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
    if repeated:
        raise ValueError(f"column names must be unique, repeated: {repeated}")
    return [column_shape(f) for f in schema.fields]


def constant(rows: list, schema: str) -> Column:
    """Rows known to the driver as one literal array, folded by the optimizer."""
    return F.from_json(F.lit(json.dumps(rows)), schema)


def constant_frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A frame of rows known to the driver; one task, however large the cluster."""
    return spark.range(0, 1, 1, 1).select(F.inline(constant(rows, schema)))


def shapes_frame(spark: SparkSession, shapes: list[ColumnShape]) -> DataFrame:
    """One row per column."""
    return constant_frame(spark, [asdict(s) for s in shapes], SHAPE_SCHEMA)


def described(df: DataFrame) -> DataFrame:
    """Shape facts of every column next to the table's row count."""
    shapes = column_shapes(df.schema)
    return (df.agg(F.count(F.lit(1)).alias("n_events"))
              .select("n_events", F.inline(constant([asdict(s) for s in shapes], SHAPE_SCHEMA))))


def unreadable_columns(df: DataFrame) -> DataFrame:
    """Columns that cannot be profiled, with the reason; never dropped silently."""
    return (described(df).where(F.col("reason").isNotNull())
            .select("name", "source_type", "reason", "n_events"))
