"""Flat CSV output: a directory of part files, each with a header."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flatweave.functions.names import quoted
from flatweave.functions.text import writable
from flatweave.operators.flatten import flatten, header_line
from flatweave.plans.layout import FlatLayout

#: Rows are written as rendered lines. A caller may ask for one expression per cell instead, up to
#: so many flat columns; the cells are the same.
WIDE_THRESHOLD = 0
#: Part files are plain text. A caller may name a codec of Spark's text files instead: a run of fill
#: cells takes a few bytes of gzip, so the disk follows the elements and not the width.
PLAIN = "none"
#: A compressed part file is read by one task, so it holds so many cells (some 40 MB of short ones), or
#: so many rows where they are wide, as its header compresses less than they do. Plain files are split
#: by the reader and hold their whole partition.
FILE_CELLS, FILE_ROWS = 1 << 23, 1000

# Quotes are doubled, empty strings are blank, spaces are kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "maxRecordsPerFile": 0,
}

# Rows of one partition are numbered in the low 33 bits of the generated id.
FIRST_OF_PARTITION = (1 << 33) - 1


@dataclass(frozen=True)
class WriteFacts:
    rows: int
    seconds: float


def csv_cells(flat: DataFrame) -> DataFrame:
    return flat.selectExpr(*[f"{writable(quoted(f.name), f.dataType)} as {quoted(f.name)}"
                             for f in flat.schema.fields])


def rows_per_file(n_columns: int, compression: str) -> int:
    """How many rows a part file holds; 0 for all of its partition."""
    return 0 if compression == PLAIN else max(FILE_ROWS, FILE_CELLS // max(1, n_columns))


def with_header(lines: DataFrame, header: str, file_rows: int = 0) -> DataFrame:
    """Put the header before the first line of each file: of a partition, and after every ``file_rows``."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(FIRST_OF_PARTITION))
    starts = (place % file_rows if file_rows else place) == 0
    return lines.select(F.when(starts, F.concat(F.lit(header + "\n"), "value"))
                        .otherwise(F.col("value")).alias("value"))


def write_flat(df: DataFrame, layout: FlatLayout, path: str, wide_threshold: int = WIDE_THRESHOLD,
               compression: str = PLAIN) -> WriteFacts:
    """Flatten and write; the rows are counted by the same job.

    Both ways give the same cells. Partitions are written where they are read:
    nothing is shuffled or gathered.
    """
    counter, started = Observation(), time.monotonic()
    total = F.count(F.lit(1)).alias("rows")
    file_rows = rows_per_file(layout.n_columns, compression)
    if 1 < layout.n_columns <= wide_threshold:
        cells = csv_cells(flatten(df, layout)).observe(counter, total)
        writer = cells.write.mode("overwrite").options(**CSV_OPTIONS)
        writer.option("maxRecordsPerFile", file_rows).csv(path, compression=compression)
        rows = counter.get["rows"]
    else:
        lines = flatten(df, layout, "lines").observe(counter, total)
        if layout.n_columns == 1:  # readers skip blank lines
            lines = lines.withColumn("value", F.when(F.col("value") == "", '""')
                                     .otherwise(F.col("value")))
        writer = with_header(lines, header_line(layout), file_rows).write.mode("overwrite")
        writer.option("maxRecordsPerFile", file_rows).text(path, compression=compression)
        rows = counter.get["rows"]
        if rows == 0:
            spark = df.sparkSession
            (spark.createDataFrame([(header_line(layout),)], "value string").coalesce(1)
             .write.mode("overwrite").text(path, compression=compression))
    return WriteFacts(rows, time.monotonic() - started)
