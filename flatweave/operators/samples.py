"""A few leading values of each column, for orientation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.functions.names import column, quoted
from flatweave.functions.text import plain_text
from flatweave.operators.shapes import column_shapes, constant_frame

SAMPLE_ROWS = 2
SAMPLE_WIDTH = 60


def cut(text: str, width: int) -> str:
    return f"concat(substring({text}, 1, {width}), if(length({text}) > {width}, '...', ''))"


def first_rows(df: DataFrame, k: int, order_by: list[str] | None) -> DataFrame:
    """The first ``k`` rows, by ``order_by`` if given.

    The ordering keys are found on their own first: that scan reads only the
    key columns, and the second one prunes row groups by the k keys found.
    """
    if not order_by:
        return df
    ordering = [column(o) for o in order_by]
    keys = df.select(*ordering).orderBy(*ordering).limit(k).collect()
    if not keys:
        return df.limit(0)
    wanted = [reduce(Column.__and__, [c.eqNullSafe(F.lit(v)) for c, v in zip(ordering, key)])
              for key in keys]
    return df.where(reduce(Column.__or__, wanted)).orderBy(*ordering)


def sample_values(df: DataFrame, k: int = SAMPLE_ROWS, width: int = SAMPLE_WIDTH,
                  order_by: list[str] | None = None) -> DataFrame:
    """One row per readable column with its first ``k`` values as cut text.

    The k rows are fetched, already cut, by a job that ends in the limit: it stops
    after the first partitions that hold enough, where a limit inside a larger
    plan would start a task for each.
    """
    readable = [s.name for s in column_shapes(df.schema) if s.readable]
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [f"coalesce({cut(plain_text(quoted(n), types[n]), width)}, 'null')" for n in readable]
    rows = []
    if readable:
        rows = (first_rows(df, k, order_by)
                .select(F.expr(f"array({', '.join(texts)})").alias("texts")).limit(k).collect())
    found = [{"name": n, "samples": [r["texts"][i] for r in rows]} for i, n in enumerate(readable)]
    return constant_frame(df.sparkSession, found, "array<struct<name:string,samples:array<string>>>")
