"""The lists-intact copy of a table, source of all later flattening."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatweave.functions.names import column
from flatweave.operators.shapes import column_shapes
from flatweave.plans.policy import resolve_tags
from flatweave.sources.discovery import replace_folder

# The bins worth keeping, and the codec of the copy.
KEPT = ("scalar", "vec1", "jagged", "jagged_deep")
CODEC = "snappy"


def refuse_clash(df: DataFrame, tags: Mapping[str, int]) -> None:
    clash = sorted(set(tags) & set(df.columns))
    if clash:
        raise ValueError(f"tags named like columns of the table: {clash}")


def write_copy(df: DataFrame, names: Iterable[str], path: str, tags: Mapping[str, int]) -> None:
    (df.select(*[column(n) for n in names],
               *[F.lit(v).cast("tinyint").alias(k) for k, v in tags.items()])
       .write.mode("overwrite").option("compression", CODEC).parquet(path))


def write_canonical(df: DataFrame, census: Iterable[Mapping], path: str,
                    tags: Mapping[str, int] | Iterable[str] | None = None) -> str:
    """Write every readable, non-empty column with its lists as lists, plus the tags."""
    stamped = resolve_tags(tags)
    refuse_clash(df, stamped)
    write_copy(df, [r["name"] for r in census if r["category"] in KEPT], path, stamped)
    return path


class Canonical:
    """A copy that is written before its census, so that the source is computed once.

    At first it has every readable column. ``measured`` has the columns of the source, read from
    the copy; unreadable ones are NULL there, as a census takes them from the schema. Once the
    census tells which columns are empty, ``finish`` writes the copy again without them, from
    itself; without empty columns it stays as it is.
    """

    def __init__(self, df: DataFrame, path: str, tags: Mapping[str, int]):
        refuse_clash(df, tags)
        self.path, self.tags = path, tags
        shapes = column_shapes(df.schema)
        write_copy(df, [s.name for s in shapes if s.readable], path, tags)
        copy = df.sparkSession.read.parquet(path)
        held = [column(s.name) if s.readable else F.lit(None).cast(f.dataType).alias(s.name)
                for s, f in zip(shapes, df.schema.fields)]
        measured = copy.select(*held)
        # Declared types and metadata are those of the source, not of the file.
        self.measured = measured.select(*(
            column(f.name).alias(f.name, metadata=f.metadata) if f.metadata else column(f.name)
            for f in df.schema.fields))

    def finish(self, census: Iterable[Mapping]) -> str:
        kept = [r["name"] for r in census if r["category"] in KEPT]
        spark = self.measured.sparkSession
        copy = spark.read.parquet(self.path)
        if len(kept) + len(self.tags) < len(copy.columns):
            draft = f"{self.path}.draft"
            write_copy(copy, kept, draft, self.tags)
            replace_folder(spark, draft, self.path)
        return self.path


def read_canonical(spark: SparkSession, *paths: str | None) -> DataFrame:
    """Read the copy from the first of ``paths`` that exists."""
    for path in filter(None, paths):
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no lists-intact copy at {list(paths)}: scan again with "
                            "write_parquet=True, or flatten the original table")
