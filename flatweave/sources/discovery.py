"""Finding the input: the tables of a folder, the one with most rows or bytes, the largest file."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: files of at most this many bytes hold no table.
SMALLEST_INPUT = 1000


#: Names that Spark gives to the parts of a table.
PART = re.compile(r"part-\d+-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\b.*")
#: Names without an ending that other writers give to parts, such as 000000_0.
BARE_PART = re.compile(r"\d+(_\d+)*")
#: Formats whose files tell their schema in a footer.
FOOTERS = ("parquet", "orc")


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    folder: bool

    @property
    def hidden(self) -> bool:
        return self.name.startswith((".", "_"))


def _at(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def entries(spark: SparkSession, path: str) -> Iterator[Entry]:
    """What lies in a folder, at that level only and one after the other; nothing if it is none."""
    fs, place = _at(spark, path)
    if not fs.exists(place) or not fs.getFileStatus(place).isDirectory():
        return
    found = fs.listStatusIterator(place)
    while found.hasNext():
        status = found.next()
        at = status.getPath()
        yield Entry(at.toString(), at.getName(), status.isDirectory())


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put a folder in the place of another one."""
    fs, target = _at(spark, old)
    fs.delete(target, True)
    if not fs.rename(_at(spark, new)[1], target):
        raise OSError(f"{new} could not be renamed to {old}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, summed by the file system."""
    fs, place = _at(spark, path)
    return fs.getContentSummary(place).getLength()


def listed(spark: SparkSession, pattern: str) -> DataFrame | None:
    """Path and size of the files under a pattern, or None if nothing matches.

    Only file status is read: the content column is pruned.
    """
    try:
        return spark.read.format("binaryFile").load(pattern).select("path", "length")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def largest_input(spark: SparkSession, path: str, suffix: str = ".parquet",
                  smallest: int = SMALLEST_INPUT) -> DataFrame:
    """The largest file with the suffix in a directory or one level below it.

    For inputs that are single files; of tables in several parts see ``tables_in``. Files of at
    most ``smallest`` bytes hold no table. A path to a file is taken as it is.
    """
    path = path.rstrip("/")
    found = [f for f in (listed(spark, f"{path}/*{suffix}"), listed(spark, f"{path}/*/*{suffix}"))
             if f is not None]
    if not found:
        direct = listed(spark, path)
        if direct is None:
            raise FileNotFoundError(f"no such input: {path}")
        single = direct.where(F.col("path").endswith(path.split(":", 1)[-1]))
        if single.isEmpty():
            raise FileNotFoundError(f"no {suffix} files under {path}")
        return single
    candidates = (reduce(DataFrame.unionAll, found).distinct()
                  .where(F.col("length") > smallest))
    largest = candidates.orderBy(F.desc("length"), "path").limit(1)
    if largest.isEmpty():
        raise FileNotFoundError(f"no {suffix} files under {path}")
    return largest


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table. Parquet answers from its footers; no column is read."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def largest_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The table with most rows; of equals the first by name."""
    return table_sizes(tables).orderBy(F.desc("n_rows"), "name").limit(1)


def choose_table(tables: Mapping[str, DataFrame], name: str | None = None) -> tuple[str, DataFrame]:
    """A table by name, or the one with most rows."""
    if not tables:
        raise ValueError("no tables found")
    if name is None:
        name = next(iter(tables)) if len(tables) == 1 else largest_table(tables).first()["name"]
    if name not in tables:
        raise ValueError(f"no table {name}, available: {sorted(tables)}")
    return name, tables[name]


def _holds_table(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether a folder has parts of a table: files with the suffix, or folders ``key=value``."""
    return any(("=" in e.name) if e.folder else e.name.endswith(suffix) or BARE_PART.fullmatch(e.name)
               for e in entries(spark, path) if not e.hidden)


def _pattern(name: str) -> str:
    """A file name with every number in it as one mark."""
    return re.sub(r"\d+", "#", name)


def one_schema(spark: SparkSession, paths: Sequence[str], format: str) -> bool:
    """Whether files can be parts of one table: no footer has a column that the first one lacks.

    The footers are read and merged by Spark's own job. Formats without a footer say yes.
    """
    if format not in FOOTERS:
        return True
    first = spark.read.format(format).load(paths[0]).schema
    try:
        merged = spark.read.format(format).option("mergeSchema", True).load(list(paths)).schema
    except (PySparkException, Py4JJavaError):  # columns of one name and different types
        return False
    names = lambda schema: [(f.name, f.dataType) for f in schema]
    return names(merged) == names(first)


def _grouped(spark: SparkSession, files: list[Entry], format: str) -> dict[str, tuple[str, ...]]:
    """Name and paths of the tables that some files of a folder are.

    Files whose names differ in numbers only, such as part-0 and part-1, are one table if their
    schemas allow it; it is named by what the names share. Any other file is a table.
    """
    suffix, alike = f".{format}", {}
    for e in files:
        alike.setdefault(_pattern(e.name.removesuffix(suffix)), []).append(e)
    names: dict[str, tuple[str, ...]] = {}
    for pattern, some in sorted(alike.items()):
        shared = pattern.replace("#", "").strip(" -_.")
        paths = tuple(e.path for e in sorted(some, key=lambda e: e.name))
        if len(some) > 1 and one_schema(spark, paths, format):
            names[shared if shared and shared not in names and shared not in alike else pattern] = paths
        else:
            names |= {e.name.removesuffix(suffix): (e.path,) for e in some}
    return names


def table_paths(spark: SparkSession, path: str, format: str = "parquet") -> dict[str, tuple[str, ...]]:
    """Name and paths of each table in a folder; none if the path is a table itself.

    A table is a file or folder named ``<table>.<format>``, a folder of such files or of
    partitions, or several files whose names differ in numbers only and whose schemas agree. A
    folder is a table itself if its name ends so, if it holds the marker of a finished write or
    partitions, or if all its files are parts of one table. Folders are looked into one level
    deep, and only as far as their first part.
    """
    path, suffix = path.rstrip("/"), f".{format}"
    if path.endswith(suffix):
        return {}
    inside = list(entries(spark, path))
    if any(e.name == "_SUCCESS" or (e.folder and "=" in e.name) for e in inside):
        return {}
    shown = [e for e in inside if not e.hidden]
    files = [e for e in shown if not e.folder and (
        e.name.endswith(suffix) or BARE_PART.fullmatch(e.name))]
    if files and all(PART.fullmatch(e.name) for e in files):
        return {}
    folders = [e for e in shown if e.folder and (
        e.name.endswith(suffix) or _holds_table(spark, e.path, suffix))]
    names = _grouped(spark, files, format)
    if len(names) == 1 and len(files) > 1 and not folders:
        return {}
    for e in sorted(folders, key=lambda e: e.name):
        short = e.name.removesuffix(suffix)
        names[e.name if short in names else short] = (e.path,)
    return dict(sorted(names.items()))


def tables_in(spark: SparkSession, path: str, format: str = "parquet") -> dict[str, DataFrame]:
    """The tables of ``table_paths``, each loaded by itself with its own partitions."""
    return {name: spark.read.format(format).load(list(at))
            for name, at in table_paths(spark, path, format).items()}


def largest_by_bytes(spark: SparkSession, path: str, format: str = "parquet") -> str:
    """The name of the table in a folder whose files sum to most bytes; of equals the first."""
    sizes = {n: sum(folder_bytes(spark, p) for p in at)
             for n, at in table_paths(spark, path, format).items()}
    return min(sizes, key=lambda n: (-sizes[n], n))
