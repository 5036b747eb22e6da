"""Session settings and the shared folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Names are told apart by case, and times are rendered in UTC.
SETTINGS = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
}

SHARED_FOLDER = "spark.checkpoint.dir"
APPLICATION = "spark.app.id"
WAREHOUSE = "spark.sql.warehouse.dir"


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings the library expects to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def run_folder(spark: SparkSession) -> str:
    """Where the intermediate tables of this application lie, below a folder that the cluster shares.

    That is the folder of spark.checkpoint.dir or, where it is unset, the warehouse.
    """
    base = spark.conf.get(SHARED_FOLDER, None) or spark.conf.get(WAREHOUSE)
    return f"{base.rstrip('/')}/flatweave/{spark.conf.get(APPLICATION)}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder for an intermediate table of this application."""
    return f"{run_folder(spark)}/{uuid.uuid4().hex}"


def table_prefix(spark: SparkSession) -> str:
    """How the names of this application's intermediate tables in the session's catalog begin."""
    return "flatweave_" + re.sub(r"\W", "_", spark.conf.get(APPLICATION)).lower() + "_"


def cleanup(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once its results are written.

    Frames that were made of them can be read no longer.
    """
    for found in spark.catalog.listTables(pattern=f"{table_prefix(spark)}*"):
        spark.sql(f"drop table if exists `{found.name}`")
    place = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
