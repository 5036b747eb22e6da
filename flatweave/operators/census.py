"""The census: one row per column with its bin, statistics and default policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.operators.lengths import length_histogram, length_stats
from flatweave.operators.samples import sample_values
from flatweave.operators.shapes import column_shapes, shapes_frame

# Bin names, and the policy each bin starts with.
CATEGORIES = ("scalar", "vec1", "jagged", "jagged_deep", "empty", "unreadable")
DEFAULT_POLICY = {
    "scalar": "direct",
    "vec1": "collapse",
    "jagged": "pad_max",
    "jagged_deep": "parquet_only",
    "empty": "skip",
}
FLATTENABLE = ("scalar", "vec1", "jagged")

CENSUS_SCHEMA = (
    "name string, category string, policy string, type string, source_type string, "
    "dtype string, ndim int, max_len int, len_min int, len_med double, len_p95 double, "
    "len_max int, fill_frac double, n_spacers bigint, fanout bigint, "
    "axis_max_lens array<int>, hypo_cols bigint, samples array<string>, reason string, "
    "n_events bigint")


# The six bins, from the schema facts and the length extremes.
CATEGORY = """
    case when reason is not null then 'unreadable'
         when ndim = 1 then 'scalar'
         when ndim > 2 then 'jagged_deep'
         when coalesce(len_max, 0) = 0 then 'empty'
         when len_min = 1 and len_max = 1 then 'vec1'
         else 'jagged' end"""

# Axis maxima up to the first depth that holds no list, reported as 0.
REACHED_AXES = """
    case when category <> 'jagged_deep' or not {deep_profile} then null
         when maxima is null then array(0)
         when array_contains(maxima, 0) then slice(
           maxima, 1, least(cast(array_position(maxima, 0) as int) + 1, size(maxima)))
         else maxima end"""

# An overflowing or unprofiled product is reported as -1, unknown.
HYPOTHETICAL = """
    case when category = 'jagged_deep' then coalesce(aggregate(
      axis_max_lens, 1L, (product, n) -> try_multiply(product, greatest(n, 1L))), -1L) end"""


def column_stats(stats: DataFrame) -> DataFrame:
    """One row per column: its axis-1 statistics and the maxima of all axes."""
    return (stats.groupBy("name").agg(
        F.expr("max(if(axis = 1, struct(n_events, len_min, len_med, len_p95, len_max, fill_frac, "
               "n_spacers), null)) as outermost"),
        # One entry per nesting level of the type.
        F.expr("sort_array(collect_list(struct(axis, len_max))) as axes"))
        .selectExpr("name", "outermost.*", "axes.len_max as maxima"))


def census(df: DataFrame, deep_profile: bool = True, samples: int = 0,
           order_by: list[str] | None = None) -> DataFrame:
    """Profile every column of ``df`` in one pass over its list columns.

    Scalar columns are classified from the schema and not read at all. What is
    joined and broadcast below has one row per column of the schema.
    """
    shapes = column_shapes(df.schema)
    stats = column_stats(length_stats(length_histogram(df, deep=deep_profile)))
    found = shapes_frame(df.sparkSession, shapes).join(F.broadcast(stats), "name", "left")
    if samples:
        taken = sample_values(df, samples, order_by=order_by)
        found = found.join(F.broadcast(taken), "name", "left")
    else:
        found = found.withColumn("samples", F.lit(None).cast("array<string>"))
    return classified(found, deep_profile)


def classified(found: DataFrame, deep_profile: bool = True) -> DataFrame:
    """Assign bins and derive the per-bin fields of the census."""
    policies = ", ".join(f"'{k}', '{v}'" for k, v in DEFAULT_POLICY.items())
    only_counted = [f"if(category in ('vec1', 'jagged'), {s}, null) as {s}"
                    for s in ("len_min", "len_med", "len_p95", "len_max", "fill_frac")]
    return (found
            .selectExpr("*", f"{CATEGORY} as category")
            .selectExpr("*", f"{REACHED_AXES.format(deep_profile=deep_profile)} as axis_max_lens")
            .selectExpr("*", f"{HYPOTHETICAL} as hypo_cols")
            .selectExpr(
                "name", "category", f"try_element_at(map({policies}), category) as policy",
                "type", "source_type",
                f"""case when category = 'jagged' then 'object' when category = 'empty' then 'none'
                    when category = 'jagged_deep' and not {deep_profile} then 'unprofiled'
                    else dtype end as dtype""",
                "ndim",
                """case when category in ('scalar', 'vec1') then 1 when category = 'empty' then 0
                   when category = 'jagged' then len_max
                   when category = 'jagged_deep' then -1 end as max_len""",
                *only_counted,
                """case when category = 'jagged' then n_spacers
                   when category <> 'unreadable' then 0L end as n_spacers""",
                """case when category in ('scalar', 'vec1') then 1L when category = 'empty' then 0L
                   when category = 'jagged' then len_max else hypo_cols end as fanout""",
                "axis_max_lens", "hypo_cols",
                "if(category <> 'unreadable', samples, null) as samples", "reason", "n_events"))


def census_rows(frame: DataFrame) -> list:
    """The census on the driver: one row per column of the profiled table."""
    return frame.collect()
