"""Reports over a census. Their input has one row per profiled column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.operators.census import CATEGORIES, FLATTENABLE


def bin_summary(census: DataFrame) -> DataFrame:
    """Columns in total, readable, and in each bin."""
    return census.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("category") != "unreadable").alias("readable"),
        *[F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES])


def projected_columns(census: DataFrame, n_tags: int = 0) -> DataFrame:
    """Flat columns the default policies make, tags included."""
    width = F.when(F.col("category").isin(*FLATTENABLE), F.col("fanout")).otherwise(0)
    return census.agg((F.coalesce(F.sum(width), F.lit(0)) + n_tags).alias("projected_columns"))


def projected_spacers(census: DataFrame) -> DataFrame:
    """Fill cells the default policies write."""
    spacers = F.when(F.col("category") == "jagged", F.col("n_spacers")).otherwise(0)
    return census.agg(F.coalesce(F.sum(spacers), F.lit(0)).alias("projected_spacers"))


def column_audit(census: DataFrame) -> DataFrame:
    """Whether each column reaches the flat table under the default policies."""
    reached = F.col("category").isin(*FLATTENABLE)
    return (census.select("name", F.when(reached, "flattened").otherwise("unreadable").alias("label"))
            .orderBy("name"))


def deep_inventory(census: DataFrame) -> DataFrame:
    """Structure of the columns too deep to flatten."""
    return (census.where(F.col("category") == "jagged_deep")
            .select("name", "source_type", "type", "ndim", "axis_max_lens", "dtype", "hypo_cols"))


def outlier_signal(census: DataFrame) -> DataFrame:
    """What one needs to judge a wide column: the maximum against typical lengths.

    A large ``max_over_med`` speaks for ``first:N`` near the p95, a low
    ``fill_frac`` for ``drop``. The choice stays with the user.
    """
    return (census.where(F.col("category") == "jagged")
            .select("name", "len_med", "len_p95", "len_max", "fill_frac",
                    F.try_divide("len_max", "len_med").alias("max_over_med"),
                    (F.col("len_max") - F.col("len_p95")).alias("columns_above_p95"),
                    F.try_divide(F.col("n_spacers"), F.col("n_events") * F.col("len_max"))
                     .alias("spacer_share")))
