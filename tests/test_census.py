"""Bins, statistics and summaries."""

import math

import numpy as np
import pytest

from flatweave.operators import summary
from flatweave.operators.census import CATEGORIES, census
from flatweave.operators.lengths import length_histogram, list_lengths
from flatweave.operators.samples import sample_values
from flatweave.operators.shapes import column_shapes, unreadable_columns


def record(spark, values, type_, **options):
    df = spark.createDataFrame([(v,) for v in values], f"c {type_}")
    return census(df, **options).first()


def by_name(frame):
    return {r["name"]: r for r in frame.collect()}


def test_scalar_bin(spark):
    r = record(spark, [0, 1, 2, 3, 4], "int")
    assert (r.category, r.policy, r.dtype, r.ndim, r.max_len, r.fanout, r.n_spacers) == (
        "scalar", "direct", "int", 1, 1, 1, 0)
    assert r.len_max is None


def test_vec1_bin(spark):
    r = record(spark, [[1.0], [2.0], [3.0]], "array<double>")
    assert (r.category, r.policy, r.dtype, r.max_len, r.fanout) == ("vec1", "collapse", "double", 1, 1)
    assert (r.len_min, r.len_med, r.len_p95, r.len_max, r.fill_frac) == (1, 1.0, 1.0, 1, 1.0)


def test_jagged_bin(spark):
    r = record(spark, [[1, 2], [], [3, 4, 5]], "array<int>")
    assert (r.category, r.policy, r.dtype, r.max_len, r.n_spacers, r.fanout) == (
        "jagged", "pad_max", "object", 3, 1 + 3 + 0, 3)
    assert r.fill_frac == pytest.approx(2 / 3)


@pytest.mark.parametrize("values", [[[1], []], [[1], [2, 3]], [[1], None]])
def test_one_row_off_makes_a_column_jagged(spark, values):
    assert record(spark, values, "array<int>").category == "jagged"


def test_fixed_length_lists_are_jagged_without_spacers(spark):
    r = record(spark, [[1, 2], [3, 4]], "array<int>")
    assert (r.category, r.n_spacers, r.fanout) == ("jagged", 0, 2)


def test_deep_bin(spark):
    r = record(spark, [[[1.0, 2.0], [3.0]], [], [[4.0]]], "array<array<double>>")
    assert (r.category, r.policy, r.ndim, r.axis_max_lens, r.hypo_cols, r.fanout, r.max_len, r.dtype) == (
        "jagged_deep", "parquet_only", 3, [2, 2], 4, 4, -1, "double")


def test_deep_without_profile(spark):
    r = record(spark, [[[1.0]]], "array<array<double>>", deep_profile=False)
    assert (r.category, r.axis_max_lens, r.hypo_cols, r.fanout, r.dtype) == (
        "jagged_deep", None, -1, -1, "unprofiled")


@pytest.mark.parametrize("type_, values, axes", [
    ("array<array<int>>", [[], []], [0, 0]),
    ("array<array<array<int>>>", [[], []], [0, 0]),
    ("array<array<array<int>>>", [[[]], []], [1, 0, 0]),
    ("array<array<array<int>>>", [[[[]]], []], [1, 1, 0]),
    ("array<array<array<int>>>", [[[[1], [2, 3]], [[4]]], [[], None]], [2, 2, 2]),
    ("array<array<int>>", [None, [None]], [1, 0]),
    ("array<array<int>>", [], [0]),
    ("array<array<array<int>>>", [], [0]),
])
def test_axes_stop_after_the_first_depth_without_lists(spark, type_, values, axes):
    r = record(spark, values, type_)
    assert r.axis_max_lens == axes
    assert r.hypo_cols == math.prod(max(a, 1) for a in axes)


@pytest.mark.parametrize("values", [[[], [], []], [None, []], []])
def test_empty_bin(spark, values):
    r = record(spark, values, "array<float>")
    assert (r.category, r.policy, r.dtype, r.max_len, r.fanout) == ("empty", "skip", "none", 0, 0)


def test_scalar_of_no_rows(spark):
    assert record(spark, [], "int").category == "scalar"


@pytest.mark.parametrize("type_", ["map<string,int>", "binary", "array<map<string,int>>",
                                   "array<array<binary>>", "variant", "interval", "void"])
def test_unreadable_types(spark, type_):
    df = spark.range(3).selectExpr("id", f"cast(null as {type_}) as c")
    r = by_name(census(df, samples=2))["c"]
    assert (r.category, r.policy, r.max_len, r.n_spacers, r.fanout, r.samples) == (
        "unreadable", None, None, None, None, None)
    assert r.reason.endswith(" has no flat shape")
    found = unreadable_columns(df).collect()
    assert [(f.name, f.n_events) for f in found] == [("c", 3)]


def test_long_reason_is_whole(spark):
    fields = ",".join(f"field_{i}:int" for i in range(40))
    df = spark.createDataFrame([], f"m map<string,struct<{fields}>>")
    reason = column_shapes(df.schema)[0].reason
    assert "field_39:int" in reason and reason.endswith(" has no flat shape")


def test_dtype_of_a_jagged_column_is_object_and_type_is_exact(reco):
    rows = by_name(census(reco))
    assert {n: r.category for n, r in rows.items()} == {
        "eventNumber": "scalar", "met": "scalar", "jet_pt": "jagged", "track_d0": "jagged",
        "msvtx_eta": "vec1", "empty_b": "empty"}
    assert rows["jet_pt"].type == "array<float>" and rows["jet_pt"].dtype == "object"
    assert rows["msvtx_eta"].dtype == "float"


def test_source_type_from_metadata(spark):
    df = spark.range(2)
    tagged = df.select(df.id.alias("id", metadata={"source_type": "uint64_t"}))
    r = census(tagged).first()
    assert (r.type, r.source_type) == ("bigint", "uint64_t")


def test_statistics_equal_numpy(spark):
    rng = np.random.default_rng(7)
    lengths = rng.integers(0, 30, 500)
    df = spark.createDataFrame([(list(range(n)),) for n in lengths.tolist()], "c array<int>")
    r = census(df).first()
    assert (r.len_min, r.len_max, r.n_events) == (lengths.min(), lengths.max(), 500)
    assert r.len_med == pytest.approx(np.median(lengths))
    assert r.len_p95 == pytest.approx(np.percentile(lengths, 95))
    assert r.fill_frac == pytest.approx((lengths > 0).mean())
    assert r.n_spacers == (lengths.max() - lengths).sum()


def test_percentiles_interpolate(spark):
    r = record(spark, [[0] * n for n in (1, 2, 4, 9)], "array<int>")
    assert r.len_med == pytest.approx(3.0)
    assert r.len_p95 == pytest.approx(8.25)


def test_many_lists_are_measured_by_one_scan(spark, folder):
    path, columns = f"{folder}/many", ", ".join(f"c{k} array<int>" for k in range(100))
    spark.range(30).selectExpr(*[f"sequence(0, cast(id % {k + 2} as int)) as c{k}" for k in range(100)]
                               ).write.json(path)
    counted = length_histogram(spark.read.schema(columns).json(path))
    plan = counted._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan json") == 1
    found = {(r.name, r.len): r.n for r in counted.collect()}
    assert found["c0", 1] == found["c0", 2] == 15 and found["c98", 30] == 1


def test_list_of_structs_reads_one_field(spark, folder):
    path = f"{folder}/structs"
    spark.range(20).selectExpr(
        "id", "transform(sequence(1, cast(id % 4 as int) + 1), i -> "
        "named_struct('name', cast(i as string), 'in', named_struct('x', i * 2), 'n', i)) as ls"
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    lengths = list_lengths(stored, keep=["id"])
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,ls:array<struct<n:int>>>" in plan
    assert {(r.id, r.ls) for r in lengths.collect()} == {(i, i % 4 + 1) for i in range(20)}


def test_census_reads_list_columns_only(spark, reco, folder):
    path = f"{folder}/reco"
    reco.write.parquet(path)
    plan = census(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "eventNumber" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_odd_names_and_repeated_names(spark, odd):
    rows = by_name(census(odd, samples=2, order_by=["id"]))
    assert rows["met.x"].category == "scalar" and rows["b`s"].category == "jagged"
    assert rows["ls"].category == "jagged" and rows["m"].category == "unreadable"
    cased = spark.createDataFrame([(1, [2, 3])], "a int, A array<int>")
    assert {r.name: r.category for r in census(cased).collect()} == {"a": "scalar", "A": "jagged"}
    with pytest.raises(ValueError, match="unique"):
        census(spark.range(1).selectExpr("id", "id"))


def test_samples(odd):
    rows = {r["name"]: r["samples"] for r in sample_values(odd, order_by=["id"]).collect()}
    assert rows["id"] == ["1", "2"]
    assert rows["j"] == ["[1,2,3]", "[]"]
    assert rows["met.x"] == ["2.5", "NaN"]
    assert rows["b"] == ["true", "null"]
    assert "m" not in rows


def test_samples_are_cut_and_ordered(spark):
    df = spark.createDataFrame([(3, "c"), (1, "x" * 61), (2, "y" * 60)], "k int, t string")
    rows = {r["name"]: r["samples"] for r in sample_values(df, k=5, order_by=["k"]).collect()}
    assert rows["t"] == ["x" * 60 + "...", "y" * 60, "c"]
    assert {r["name"]: len(r["samples"]) for r in sample_values(df, k=2).collect()} == {"k": 2, "t": 2}


def test_samples_with_equal_and_missing_keys(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "b")], "k int, t string")
    rows = {r["name"]: r["samples"] for r in sample_values(df, k=3, order_by=["k"]).collect()}
    assert rows["t"] == ["a", "a", "b"]


def test_every_column_is_in_exactly_one_bin(odd):
    found = census(odd)
    total = summary.bin_summary(found).first()
    assert total.total == len(odd.columns) == sum(total[c] for c in CATEGORIES)
    assert total.readable == total.total - total.unreadable
    labels = {r.name: r.label for r in summary.column_audit(found).collect()}
    assert labels["deep"] == labels["e"] == labels["m"] == "unreadable"
    assert labels["j"] == labels["v1"] == labels["st"] == "flattened"


def test_projections(reco):
    found = census(reco)
    assert summary.projected_columns(found, n_tags=2).first()[0] == 2 + 2 + 1 + 5 + 3
    expected = sum(5 - i % 6 for i in range(40)) + sum(3 - (i % 3 + 1) for i in range(40))
    assert summary.projected_spacers(found).first()[0] == expected


def test_projection_of_nothing(spark):
    found = census(spark.createDataFrame([], "m map<string,int>"))
    assert summary.projected_columns(found).first()[0] == 0
    assert summary.projected_spacers(found).first()[0] == 0


def test_outlier_signal(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in [1] * 99 + [400]], "c array<int>")
    r = summary.outlier_signal(census(df)).first()
    assert (r.max_over_med, r.len_p95, r.columns_above_p95) == (400.0, 1.0, 399.0)
    assert r.spacer_share == pytest.approx(99 * 399 / (100 * 400))


def test_deep_inventory(odd):
    r = summary.deep_inventory(census(odd)).collect()
    assert [(d.name, d.ndim, d.axis_max_lens, d.dtype, d.hypo_cols) for d in r] == [
        ("deep", 3, [2, 2], "int", 4)]


def test_hypothetical_columns_beyond_a_long_are_unknown(spark):
    wide = spark.range(1).selectExpr(
        "transform(sequence(1, 3), a -> sequence(1, 4)) as c")
    assert census(wide).first().hypo_cols == 12
    from flatweave.operators.census import HYPOTHETICAL
    huge = spark.range(1).selectExpr("'jagged_deep' as category",
                                     "array(2000000000, 2000000000, 2000000000) as axis_max_lens")
    assert huge.selectExpr(f"{HYPOTHETICAL} as h").first().h == -1
