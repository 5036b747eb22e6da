"""Flattening under policies, fills and tags."""

import math

import pytest
from pyspark.errors import PySparkException

from flatweave import flat_layout, flatten, quick_flat
from flatweave.operators.census import census
from flatweave.plans.policy import resolve_fill, resolve_tags, slots_for


def cells(frame, key="id"):
    return {r[key]: r for r in frame.collect()}


def test_fill_values():
    assert resolve_fill() == -999.0
    assert resolve_fill("x") == resolve_fill(" X ") == "x"
    assert math.isnan(resolve_fill("NaN"))
    assert resolve_fill("-1") == -1.0 and resolve_fill(3) == 3.0
    assert resolve_fill("none") == "none" and resolve_fill("1-2") == "1-2"
    assert resolve_fill("+1.5E3") == 1500.0 and resolve_fill(".5") == 0.5 and resolve_fill("7.") == 7.0
    assert resolve_fill("-inf") == -math.inf and math.isnan(resolve_fill(math.nan))


def test_tags():
    assert resolve_tags(["a=1", " b = -2 "]) == {"a": 1, "b": -2}
    assert resolve_tags({"a": 127}) == {"a": 127}
    assert resolve_tags(None) == {}
    for bad in (["a"], ["a=x"], ["a=1.5"], {"a": 128}, {"a": -129}):
        with pytest.raises(ValueError):
            resolve_tags(bad)


@pytest.mark.parametrize("policy, slots", [
    ("pad_max", 5), (None, 5), ("drop", 0), ("first:2", 2), ("first: 3", 3), ("first:+1", 1),
    ("first:9", 5), ("first:0", 0), ("first:-4", 0)])
def test_policies(policy, slots):
    assert slots_for(policy, 5, "c") == slots


@pytest.mark.parametrize("policy", ["first:", "first:x", "first:1.5", "widest", ""])
def test_unknown_policy_falls_back_with_a_warning(policy):
    with pytest.warns(UserWarning, match="unknown policy"):
        assert slots_for(policy, 5, "c") == 5


def test_quick_flat(reco):
    flat = quick_flat(reco, tags={"is_test": 1})
    frame = flat.frame()
    assert frame.columns == (["is_test", "eventNumber"] + [f"jet_pt_{j}" for j in range(5)]
                             + ["met", "msvtx_eta"] + [f"track_d0_{j}" for j in range(3)])
    assert frame.columns == flat.layout.names and flat.layout.n_columns == 12
    rows = cells(frame, "eventNumber")
    assert len(rows) == 40
    for i, r in rows.items():
        assert r["is_test"] == 1 and r["msvtx_eta"] == pytest.approx(i / 8)
        for j in range(5):
            expected = i + j / 10 if j < i % 6 else -999.0
            assert r[f"jet_pt_{j}"] == pytest.approx(expected, rel=1e-6)


def test_a_float_list_widens_to_the_same_double(spark):
    df = spark.createDataFrame([([45.2],), ([],)], "c array<float>")
    frame = quick_flat(df).frame()
    assert dict(frame.dtypes) == {"c_0": "double"}
    assert {r.c_0 for r in frame.collect()} == {45.20000076293945, -999.0}


def test_slots_are_padded_by_length_and_not_by_null(odd):
    rows = cells(quick_flat(odd).frame())
    assert [rows[4][f"j_{k}"] for k in range(3)] == [None, 7, -999]
    assert [rows[3][f"j_{k}"] for k in range(3)] == [-999] * 3
    assert [rows[2][f"f_{k}"] for k in range(2)] == [1.5, None]
    assert math.isnan(rows[1]["f_0"]) and rows[4]["f_0"] == -999.0


def test_slot_types(odd):
    def types(fill):
        return {n: t for n, t in quick_flat(odd, fill=fill).frame().dtypes}
    by_number, by_fraction, by_nan, by_text = types(-1), types(0.5), types("nan"), types("x")
    assert [t["j_0"] for t in (by_number, by_fraction, by_nan, by_text)] == [
        "bigint", "double", "double", "string"]
    assert [t["f_0"] for t in (by_number, by_nan, by_text)] == ["double", "double", "string"]
    assert {t[n] for t in (by_number, by_text) for n in ("s_0", "ls_0", "b`s_0")} == {"string"}


def test_text_slots(odd):
    rows = cells(quick_flat(odd).frame())
    assert [rows[1][f"ls_{k}"] for k in range(2)] == ['{"a":1,"b":"p"}', '{"a":2}']
    assert rows[2]["ls_0"] == "-999.0"
    assert [rows[1][f"b`s_{k}"] for k in range(2)] == ["true", "false"]
    assert rows[3]["b`s_0"] is None and rows[1]["st"] == '{"p":"x,y","q":1}'


def test_nan_among_text_is_missing(spark, odd):
    rows = cells(quick_flat(odd, fill="x").frame())
    assert [rows[1][f"f_{k}"] for k in range(2)] == [None, "2.0"]
    rows = cells(quick_flat(odd, fill="nan").frame())
    assert rows[3]["s_0"] is None and rows[2]["ls_0"] is None
    single = spark.createDataFrame([([45.2],), ([],)], "c array<float>")
    assert {r.c_0 for r in quick_flat(single, fill="x").frame().collect()} == {"45.20000076293945", "x"}


def test_only_flattenable_bins_appear(odd):
    names = quick_flat(odd).frame().columns
    assert not [n for n in names if n.startswith(("e_", "deep", "m_")) or n in ("e", "m")]
    assert "v1" in names and "v1_0" not in names


def test_policies_apply_to_jagged_columns_only(odd):
    flat = quick_flat(odd, policies={"j": "first:1", "s": "drop", "f": "first:0", "v1": "drop",
                                     "id": "drop", "deep": "first:1"})
    names = flat.frame().columns
    assert flat.layout.dropped == ["f", "s"]
    assert [n for n in names if n.startswith("j_")] == ["j_0"]
    assert "v1" in names and "id" in names
    assert not [n for n in names if n.startswith(("s_", "f_", "deep"))]


def test_policies_from_a_frame(spark, odd):
    edits = spark.createDataFrame([("j", "first:1"), ("s", "drop")], "name string, policy string")
    assert quick_flat(odd, policies=edits).layout.dropped == ["s"]


def test_dropped_columns_are_not_read(spark, reco, folder):
    path = f"{folder}/reco"
    reco.write.parquet(path)
    frame = quick_flat(spark.read.parquet(path), policies={"jet_pt": "drop"}).frame()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "jet_pt" not in plan and "empty_b" not in plan
    assert "Exchange" not in plan and "Python" not in plan


def test_rejected_settings(spark, reco, odd):
    with pytest.raises(ValueError, match="do not exist"):
        quick_flat(reco, policies={"jet": "drop"})
    with pytest.raises(ValueError, match="named like columns"):
        quick_flat(reco, tags={"met": 1})
    with pytest.raises(ValueError, match="named like columns"):
        quick_flat(odd, tags={"m": 1})
    clash = spark.createDataFrame([([1, 2], 3)], "a array<int>, a_0 int")
    with pytest.raises(ValueError, match="clash"):
        quick_flat(clash)
    with pytest.raises(ValueError, match="form"):
        quick_flat(reco).frame("rows")


def test_stored_types_and_bins_are_checked(reco):
    rows = [r.asDict() for r in census(reco).collect()]
    wrong = [r | {"type": "array<double>"} if r["name"] == "jet_pt" else r for r in rows]
    with pytest.raises(ValueError, match="census says"):
        flat_layout(reco.schema, wrong)
    short = [r | {"max_len": 0} if r["name"] == "jet_pt" else r for r in rows]
    with pytest.raises(ValueError, match="longest list"):
        flat_layout(reco.schema, short)
    with pytest.raises(ValueError, match="not in the table"):
        flat_layout(reco.drop("met").schema, rows)


@pytest.mark.parametrize("form", ["columns", "arrays", "lines"])
def test_lists_longer_than_profiled_fail_instead_of_losing_values(spark, form):
    profiled = spark.createDataFrame([([1, 2],)], "c array<int>")
    grown = spark.createDataFrame([([1, 2, 3],)], "c array<int>")
    layout = quick_flat(profiled).layout
    with pytest.raises(PySparkException, match="longer than its profiled length"):
        flatten(grown, layout, form).collect()


def test_arrays_hold_the_same_cells_as_columns(odd):
    flat = quick_flat(odd, policies={"s": "first:2"}, fill="0")
    wide, packed = cells(flat.frame()), cells(flat.frame("arrays"))
    for key, row in packed.items():
        for c in flat.layout.columns:
            if c.category == "jagged":
                assert len(row[c.name]) == c.width
                assert repr(row[c.name]) == repr([wide[key][n] for n in c.names])


def test_no_rows(spark):
    df = spark.createDataFrame([], "a int, b array<int>, c array<array<int>>")
    flat = quick_flat(df)
    assert flat.frame().columns == ["a"] and flat.frame().count() == 0
