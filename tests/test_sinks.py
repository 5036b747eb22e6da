"""CSV output, the lists-intact copy, stored scans and rebuilds."""

import csv
import glob
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.registry import q_csv_roundtrip, q_wide_csv_lines
from flatweave import flat_from_scan, quick_flat, quick_path, scan, scan_path
from flatweave.operators.census import census
from flatweave.plans.report import fingerprint, read_report, row_print, same_table
from flatweave.session import cleanup, shared_folder, table_prefix
from flatweave.sources import flat_csv
from flatweave.sources.discovery import choose_table, largest_input, largest_table, tables_in
from flatweave.sources.manifest import read_manifest, set_policies


def written(path):
    """All rows of all part files, each file with its own header."""
    header, rows = None, []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, newline="") as f:
            lines = list(csv.reader(f))
        if lines:
            assert header in (None, lines[0])
            header = lines[0]
            rows += lines[1:]
    return header, sorted(rows)


@pytest.mark.parametrize("fill", [None, "nan", "x", 'a,"b'])
def test_both_sinks_write_the_same_cells(odd, folder, fill):
    flat = quick_flat(odd.repartition(2), tags={"t": 1}, fill=fill)
    flat.write(f"{folder}/columns")
    flat.write(f"{folder}/lines", wide_threshold=0)
    columns, lines = written(f"{folder}/columns"), written(f"{folder}/lines")
    assert columns == lines
    assert columns[0] == flat.layout.names and len(columns[1]) == 4


def test_csv_text(odd, folder):
    quick_flat(odd).write(f"{folder}/flat")
    header, rows = written(f"{folder}/flat")
    by_id = {dict(zip(header, r))["id"]: dict(zip(header, r)) for r in rows}
    assert by_id["2"]["met.x"] == "" and by_id["1"]["f_0"] == ""
    assert by_id["1"]["s_0"] == "a,b" and by_id["1"]["s_1"] == "" and by_id["1"]["s_2"] == 'q"'
    assert by_id["1"]["s_3"] == " pad "
    assert by_id["2"]["s_1"] == "line\nbreak" and by_id["2"]["s_2"] == "cr\rhere"
    assert by_id["3"]["f_0"] == "-999.0" and by_id["3"]["j_0"] == "-999"


@pytest.mark.parametrize("threshold", [0, 2000])
def test_a_compressed_table_has_the_same_lines(spark, reco, folder, threshold):
    flat = quick_flat(reco.repartition(3))
    flat.write(f"{folder}/plain", wide_threshold=threshold)
    flat.write(f"{folder}/packed", wide_threshold=threshold, compression="gzip")
    quick_flat(reco.where("false")).write(f"{folder}/none", wide_threshold=threshold, compression="gzip")
    plain, packed, none = (sorted(r.value for r in spark.read.text(f"{folder}/{n}").collect())
                           for n in ("plain", "packed", "none"))
    assert plain == packed and len(packed) == 43 and len(none) == 1
    for n in ("packed", "none"):
        assert all(f.endswith(".gz") for f in glob.glob(f"{folder}/{n}/part-*"))


def test_fill_cells_of_the_wide_table_take_no_disk(spark, folder):
    words = F.when(F.col("id") == 7, F.repeat(F.lit("w "), 4000)).otherwise(F.lit("one two"))
    spark.range(0, 300, 1, 2).select(F.col("id").alias("doc_id"), words.alias("text"),
                                     F.lit("en").alias("lang"), F.lit("s").alias("source"),
                                     F.lit(7).alias("n_chars")).write.parquet(f"{folder}/documents.parquet")
    lines = q_wide_csv_lines(spark, folder)
    facts = lines.agg(F.count("line").alias("n"), F.sum(F.length("line")).alias("chars"),
                      F.min(F.size(F.split("line", ","))).alias("narrow")).first()
    assert facts.n == 300 and facts.narrow == 4002 and facts.chars > 4_000_000
    assert sum(Path(f.removeprefix("file:")).stat().st_size for f in lines.inputFiles()) < facts.chars / 50


def test_fill_cells_of_the_roundtrip_take_no_disk(spark, folder):
    lines = (F.when(F.col("id") == 7, F.repeat(F.lit("n\n"), 200)).when(F.col("id") == 8, F.lit(None))
             .otherwise(F.lit("one\ntwo and a line of more than twenty letters")))
    spark.range(0, 600, 1, 2).select(F.col("id").alias("doc_id"), lines.alias("text"),
                                     F.lit("en").alias("lang"), F.lit('s,"').alias("source"),
                                     F.lit(7).alias("n_chars")).write.parquet(f"{folder}/documents.parquet")
    read = q_csv_roundtrip(spark, folder)
    rows = {r.event_id: r for r in read.collect()}
    assert len(rows) == read.count() == 600 and len(read.columns) == 3 * 201 + 5
    for i, n in ((0, 2), (7, 201), (8, 0), (599, 2)):
        assert [rows[i][f"line_{j}"] for j in range(201)] == [*range(1, n + 1)] + [-999] * (201 - n)
    assert (rows[0].qty_0, rows[0].qty_1, rows[0].qty_2, rows[0].flag_1, rows[0].flag_2) == (3, 42, -999, "A", "-999.0")
    assert rows[599].status == 's,"' and rows[599].met == rows[599].vtx == 7
    cells = sum(len(str(c)) + 1 for r in rows.values() for c in r)  # as characters of plain text
    assert sum(Path(f.removeprefix("file:")).stat().st_size for f in read.inputFiles()) < cells / 40


@pytest.mark.parametrize("threshold", [0, 2000])
def test_a_compressed_part_file_is_bounded(spark, reco, folder, monkeypatch, threshold):
    flat = quick_flat(reco.repartition(2))
    flat.write(f"{folder}/whole", wide_threshold=threshold, compression="gzip")
    monkeypatch.setattr(flat_csv, "FILE_ROWS", 1)
    monkeypatch.setattr(flat_csv, "FILE_CELLS", 3 * flat.layout.n_columns + 1)
    flat.write(f"{folder}/parts", wide_threshold=threshold, compression="gzip")
    flat.write(f"{folder}/plain", wide_threshold=threshold)
    monkeypatch.setattr(flat_csv, "FILE_CELLS", 1)
    flat.write(f"{folder}/rows", wide_threshold=threshold, compression="gzip")
    monkeypatch.setattr(flat_csv, "FILE_ROWS", 5)
    flat.write(f"{folder}/wide", wide_threshold=threshold, compression="gzip")
    header = ",".join(flat.layout.names)

    def files(name):
        found = [gzip.open(f, "rt").read().splitlines() for f in glob.glob(f"{folder}/{name}/part-*")]
        assert all(lines[0] == header and header not in lines[1:] for lines in found)
        return sorted(len(lines) - 1 for lines in found), sorted(x for lines in found for x in lines[1:])

    (whole, rows), (parts, cut), (single, each), (wide, five) = map(files, ("whole", "parts", "rows", "wide"))
    assert rows == cut == each == five and len(rows) == 40 and max(wide) == 5
    assert len(whole) == 2 and len(parts) == sum(-(-n // 3) for n in whole)
    assert max(parts) == 3 and single == [1] * 40
    assert len(glob.glob(f"{folder}/plain/part-*")) == 2


def test_dates_times_and_decimals_have_one_text(spark, folder):
    df = spark.sql("""select date'2024-01-02' as d, timestamp'2024-01-02 03:04:05.678901' as t,
                      cast(0.0000001 as decimal(20, 9)) as n, array(date'2024-05-06') as v,
                      array(timestamp'2024-01-02 00:00:00', null) as a, interval '3' day as i""")
    flat = quick_flat(df)
    flat.write(f"{folder}/columns")
    flat.write(f"{folder}/lines", wide_threshold=0)
    columns = written(f"{folder}/columns")
    assert columns == written(f"{folder}/lines")
    row = dict(zip(columns[0], columns[1][0]))
    assert row["t"] == "2024-01-02 03:04:05.678901" and row["n"] == "0.000000100"
    assert row["a_0"] == "2024-01-02 00:00:00" and row["a_1"] == "" and row["v"] == "2024-05-06"


def test_each_part_file_starts_with_the_header(reco, folder):
    quick_flat(reco.repartition(3)).write(f"{folder}/lines", wide_threshold=0)
    starts = [open(f).readline() for f in glob.glob(f"{folder}/lines/part-*")]
    assert len(starts) == 3 and len(set(starts)) == 1 and starts[0].startswith("eventNumber,jet_pt_0")


@pytest.mark.parametrize("threshold", [0, 2000])
def test_no_rows_still_write_a_header(spark, folder, threshold):
    df = spark.createDataFrame([], "a int, `b,c` string")
    report = quick_flat(df).write(f"{folder}/none", wide_threshold=threshold).first()
    assert written(f"{folder}/none") == (["a", "b,c"], [])
    assert (report.n_rows, report.n_columns) == (0, 2)


def test_many_columns(spark, folder):
    names = [f"c{k:03d}" for k in range(60)]
    df = spark.range(0, 30, 1, 2).selectExpr(
        "id", *[f"sequence(0, cast((id * {k + 1}) % 97 as int)) as {n}" for k, n in enumerate(names)])
    flat = quick_flat(df)
    report = flat.write(f"{folder}/wide").first()
    header, rows = written(f"{folder}/wide")
    assert report.n_columns == flat.layout.n_columns == len(header) > 2000
    assert report.n_rows == len(rows) == 30
    cells = dict(zip(header, rows[0]))
    spacers = sum(r["n_spacers"] for r in census(df).collect())
    assert sum(v == "-999" for r in rows for v in r) == spacers
    key = int(dict(zip(header, rows[7]))["id"])
    assert cells["c000_0"] == "0" and dict(zip(header, rows[7]))[f"c000_{key}"] == str(key)


def test_build_report(reco, folder):
    flat = quick_flat(reco, tags={"t": 1}, policies={"jet_pt": "drop", "track_d0": "first:0"}, fill="nan")
    r = flat.write(f"{folder}/flat", name="mine").first()
    assert (r.name, r.n_columns, r.n_rows, r.n_dropped, r.dropped, r.tags, r.fill) == (
        "mine", 4, 40, 2, ["jet_pt", "track_d0"], ["t"], "nan")
    assert r.bytes > 100 and r.seconds > 0
    assert read_report(flat.table.sparkSession, f"{folder}/flat").first() == r
    flat.write(f"{folder}/flat")  # a flat table may be replaced


def test_nothing_else_is_replaced(spark, reco, folder):
    scan(reco, f"{folder}/scan", "t1", samples=0)
    flat = flat_from_scan(spark, f"{folder}/scan")
    for place in ("scan", "scan/t1_canonical.parquet", "scan/t1_manifest"):
        with pytest.raises(ValueError, match="something else"):
            flat.write(f"{folder}/{place}")
    assert flat.write(f"{folder}/scan/flat").first().n_rows == 40


def test_a_census_that_lacks_a_column(spark, reco, folder):
    scan(reco, folder, "t1", samples=0, tags={"t": 1})
    stored = spark.read.json(f"{folder}/t1_manifest/census").where("name <> 'met'").collect()
    spark.createDataFrame(stored).write.mode("overwrite").json(f"{folder}/t1_manifest/census")
    with pytest.raises(ValueError, match="not in the census.*met"):
        flat_from_scan(spark, folder)


def test_quick_path_leaves_its_artifacts(spark, reco, folder):
    reco.write.parquet(f"{folder}/in/reco.parquet")
    flat = quick_path(spark, f"{folder}/in", f"{folder}/out", tags={"t": 1}, samples=0,
                      policies={"jet_pt": "drop"})
    assert same_table(flat.frame(), quick_flat(reco, tags={"t": 1}, policies={"jet_pt": "drop"}).frame())
    assert read_manifest(spark, f"{folder}/out").tags == {"t": 1}
    assert spark.read.parquet(f"{folder}/out/reco_canonical.parquet").count() == 40


def test_scan_stores_census_copy_and_facts(spark, reco, folder):
    stored = scan(reco, folder, "t1", tags=["is_test=1"], note="a sample", source="made here",
                  order_by=["eventNumber"])
    assert stored == read_manifest(spark, folder)
    m = stored.meta
    assert (m.name, m.note, m.source, m.n_events, stored.tags) == ("t1", "a sample", "made here", 40, {"is_test": 1})
    rows = {r.name: r for r in stored.columns}
    assert rows["jet_pt"].policy == "pad_max" and rows["jet_pt"].len_p95 is not None
    assert rows["eventNumber"].samples == ["0", "1"] and not stored.unreadable
    copy = spark.read.parquet(m.canonical_parquet)
    assert "empty_b" not in copy.columns and dict(copy.dtypes)["is_test"] == "tinyint"
    assert dict(copy.dtypes)["msvtx_eta"] == "array<float>"
    assert same_table(copy.drop("is_test"), reco.drop("empty_b").select(*copy.columns[:-1]))
    assert {r.name for r in stored.census(spark).collect()} == set(reco.columns)
    assert glob.glob(f"{m.canonical_parquet}/*.snappy.parquet")


def test_scan_without_copy(spark, reco, folder):
    stored = scan(reco, folder, "t1", write_parquet=False, samples=0)
    assert stored.meta.canonical_parquet is None
    with pytest.raises(FileNotFoundError, match="scan again"):
        flat_from_scan(spark, folder)


def test_deep_and_unreadable_columns_in_a_scan(spark, odd, folder):
    stored = scan(odd, folder, "odd")
    assert [r.name for r in stored.unreadable] == ["m"] and len(stored.readable) == len(odd.columns) - 1
    copy = spark.read.parquet(stored.meta.canonical_parquet)
    assert set(copy.columns) == set(odd.columns) - {"m", "e"}
    assert same_table(quick_flat(odd).frame(), flat_from_scan(spark, folder).frame())


def test_rebuild_under_edited_policies(spark, reco, folder):
    scan(reco, folder, "t1", tags={"is_test": 1, "year": 1}, samples=0)
    set_policies(spark, folder, {"jet_pt": "drop", "track_d0": "drop"})
    stored = set_policies(spark, folder, {"jet_pt": "first:2"})
    assert {r.name: r.policy for r in stored.columns}["jet_pt"] == "first:2"
    with pytest.raises(ValueError, match="do not exist"):
        set_policies(spark, folder, {"none": "drop"})
    flat = flat_from_scan(spark, folder, fill="nan", tags=["year=2"])
    frame = flat.frame()
    assert frame.columns == ["is_test", "year", "eventNumber", "jet_pt_0", "jet_pt_1", "met", "msvtx_eta"]
    assert flat.layout.dropped == ["track_d0"] and dict(frame.dtypes)["jet_pt_1"] == "double"
    assert {(r.is_test, r.year) for r in frame.collect()} == {(1, 2)}
    r = flat.write(f"{folder}/t1_flat.csv").first()
    assert (r.n_rows, r.dropped, r.tags) == (40, ["track_d0"], ["is_test", "year"])
    again = flat_from_scan(spark, folder, policies={"jet_pt": "drop"})
    assert again.layout.dropped == ["jet_pt", "track_d0"]


def test_rebuild_finds_a_moved_scan(spark, reco, folder):
    import shutil
    scan(reco, f"{folder}/here", "t1", samples=0)
    before = fingerprint(flat_from_scan(spark, f"{folder}/here").frame()).first()
    shutil.copytree(f"{folder}/here", f"{folder}/there")
    [part] = glob.glob(f"{folder}/there/t1_manifest/meta/part-*")
    text = open(part).read().replace(f"{folder}/here", f"{folder}/nowhere")
    import os
    os.unlink(part.replace("part-", ".part-") + ".crc")
    with open(part, "w") as f:
        f.write(text)
    assert fingerprint(flat_from_scan(spark, f"{folder}/there").frame()).first() == before


def test_exactly_one_manifest(spark, reco, folder):
    with pytest.raises(ValueError, match="found 0"):
        read_manifest(spark, folder)
    scan(reco, folder, "a", samples=0, write_parquet=False)
    scan(reco, folder, "b", samples=0, write_parquet=False)
    with pytest.raises(ValueError, match="found 2"):
        read_manifest(spark, folder)


def test_unedited_rebuild_equals_quick_flat_and_projection(spark, reco, folder):
    stored = scan(reco, folder, "t1", samples=0)
    quick, rebuilt = quick_flat(reco), flat_from_scan(spark, folder)
    assert same_table(quick.frame(), rebuilt.frame())
    assert quick.layout.n_columns == sum(r.fanout for r in stored.columns)


def test_fingerprint_tells_tables_apart(spark):
    base = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert same_table(base, base.orderBy("b"))
    for other in ([(1, None), (1, None)], [(1, None)], [(None, 1), (None, 1)], [(1, 1), (None, None)]):
        assert not same_table(base, spark.createDataFrame(other, "a int, b int"))
    assert not same_table(base, base.select("b", "a"))


def test_largest_input(spark, folder):
    import os
    os.makedirs(f"{folder}/sub/deeper")
    for name, size in (("a.dat", 2000), ("sub/b.dat", 5000), ("sub/deeper/c.dat", 9000),
                       ("d.txt", 9000), ("e.dat", 10)):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"x" * size)
    found = largest_input(spark, folder, ".dat").first()
    assert found.path.endswith("/sub/b.dat") and found.length == 5000
    direct = largest_input(spark, f"{folder}/e.dat", ".dat").first()
    assert direct.path.endswith("/e.dat") and direct.length == 10
    for missing, suffix in ((f"{folder}/absent", ".dat"), (folder, ".orc")):
        with pytest.raises(FileNotFoundError):
            largest_input(spark, missing, suffix)


def test_only_tiny_inputs(spark, folder):
    with open(f"{folder}/a.dat", "wb") as f:
        f.write(b"x" * 1000)
    with pytest.raises(FileNotFoundError):
        largest_input(spark, folder, ".dat")


def test_largest_table_and_ties(spark, reco):
    small = spark.range(5)
    assert tuple(largest_table({"truth": small, "reco": reco}).first()) == ("reco", 40)
    assert largest_table({"b": small, "a": small.limit(5), "c": spark.range(0)}).first().name == "a"
    assert choose_table({"truth": small, "reco": reco})[0] == "reco"
    assert choose_table({"truth": small, "reco": reco}, "truth")[0] == "truth"
    with pytest.raises(ValueError, match=r"available: \['reco', 'truth'\]"):
        choose_table({"truth": small, "reco": reco}, "none")
    with pytest.raises(ValueError):
        choose_table({})


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_scan_path_chooses_the_table_with_most_rows(spark, reco, folder, format):
    reco.write.format(format).save(f"{folder}/in/reco.{format}")
    spark.range(5).selectExpr("25 as pdgId").write.format(format).save(f"{folder}/in/truth.{format}")
    assert sorted(tables_in(spark, f"{folder}/in", format)) == ["reco", "truth"]
    stored = scan_path(spark, f"{folder}/in", f"{folder}/out", format=format, samples=0)
    assert (stored.meta.name, stored.meta.table, stored.meta.all_tables) == ("reco", "reco", ["reco", "truth"])
    assert {r.name: r.category for r in stored.columns}["jet_pt"] == "jagged"
    named = scan_path(spark, f"{folder}/in", f"{folder}/named", "mine", table="truth", format=format)
    assert (named.meta.name, named.meta.table, named.meta.n_events) == ("mine", "truth", 5)
    single = scan_path(spark, f"{folder}/in/truth.{format}", f"{folder}/single", format=format)
    assert single.meta.table == "truth"
    spark.range(7).write.format(format).save(f"{folder}/plain")
    plain = scan_path(spark, f"{folder}/plain", f"{folder}/plain_out", format=format)
    assert (plain.meta.table, plain.meta.n_events) == ("plain", 7)
    assert flat_from_scan(spark, f"{folder}/out").frame().count() == 40


def test_no_table_is_dropped_by_its_name(spark, folder):
    import shutil
    spark.range(0, 10, 1, 1).write.parquet(f"{folder}/made/a")
    spark.range(0, 1000, 1, 1).write.parquet(f"{folder}/made/b")
    import os
    os.makedirs(f"{folder}/in")
    for table, name in (("a", "small"), ("b", "part-suppliers")):
        [part] = glob.glob(f"{folder}/made/{table}/part-*")
        shutil.copy(part, f"{folder}/in/{name}.parquet")
    assert sorted(tables_in(spark, f"{folder}/in")) == ["part-suppliers", "small"]
    assert scan_path(spark, f"{folder}/in", f"{folder}/out", samples=0).meta.n_events == 1000


def test_tables_with_different_partitions(spark, folder):
    rows = spark.range(60).selectExpr("id", "id % 3 as day", "id % 2 as shop")
    rows.write.partitionBy("day").parquet(f"{folder}/in/days")
    rows.limit(20).write.partitionBy("shop").parquet(f"{folder}/in/shops.parquet")
    found = tables_in(spark, f"{folder}/in")
    assert {n: df.count() for n, df in found.items()} == {"days": 60, "shops": 20}
    assert tables_in(spark, f"{folder}/in/days") == {}


def test_bytes_are_summed_per_table(spark, folder):
    spark.range(0, 200000, 1, 20).selectExpr("id as many").write.parquet(f"{folder}/in/big")
    spark.range(0, 30000, 1, 1).selectExpr("id as few").write.parquet(f"{folder}/in/small")
    stored = scan_path(spark, f"{folder}/in", f"{folder}/out", by="bytes", samples=0)
    assert (stored.meta.table, stored.meta.n_events) == ("big", 200000)


def test_scan_path_takes_the_largest_table(spark, folder):
    spark.range(0, 2000, 1, 1).selectExpr("id as few").write.parquet(f"{folder}/in/a")
    spark.range(0, 9000, 1, 1).selectExpr("id as many").write.parquet(f"{folder}/in/b")
    stored = scan_path(spark, f"{folder}/in", f"{folder}/out", "largest", by="bytes", samples=0)
    assert [r.name for r in stored.columns] == ["many"] and stored.meta.n_events == 9000
    assert stored.meta.table == "b"
    with pytest.raises(ValueError, match="rows or bytes"):
        scan_path(spark, f"{folder}/in", f"{folder}/out", by="age")


def test_numbered_files_are_one_table(spark, folder):
    import os
    import shutil
    spark.range(0, 3000, 1, 1).selectExpr("id", "array(id) as v").write.parquet(f"{folder}/made/a")
    spark.range(0, 2000, 1, 1).selectExpr("id", "array(id) as v").write.parquet(f"{folder}/made/b")
    spark.range(0, 400, 1, 1).selectExpr("cast(id as string) as id", "id as other").write.parquet(f"{folder}/made/c")

    def put(place, *names):
        os.makedirs(f"{folder}/{place}")
        for table, name in zip("abc", names):
            shutil.copy(glob.glob(f"{folder}/made/{table}/part-*")[0], f"{folder}/{place}/{name}")

    for place, names in (("one", ("part-0.parquet", "part-1.parquet")), ("two", ("data_0.parquet", "data_1.parquet")),
                         ("three", ("000000_0", "000001_0"))):
        put(place, *names)
        assert tables_in(spark, f"{folder}/{place}") == {}
        assert scan_path(spark, f"{folder}/{place}", f"{folder}/{place}_out", samples=0).meta.n_events == 5000
    # Next to another table; and of another schema, where each file is a table.
    put("mixed", "data_0.parquet", "data_1.parquet", "small.parquet")
    assert {n: df.count() for n, df in tables_in(spark, f"{folder}/mixed").items()} == {"data": 5000, "small": 400}
    stored = scan_path(spark, f"{folder}/mixed", f"{folder}/mixed_out", by="bytes", samples=0)
    assert (stored.meta.table, stored.meta.n_events) == ("data", 5000)
    put("apart", "x1.parquet", "y1.parquet", "x2.parquet")
    assert {n: df.count() for n, df in tables_in(spark, f"{folder}/apart").items()} == {"x1": 3000, "x2": 400, "y1": 2000}


def test_scan_computes_its_source_once(spark, odd, reco, folder):
    for df, name in ((reco, "reco"), (odd, "odd")):
        seen = spark.sparkContext.accumulator(0)

        def counted(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        plain = df.select(*(c for c in df.columns if c.isalnum() or "_" in c)).drop("m")
        source = plain.mapInArrow(counted, plain.schema)
        flat = scan(source, f"{folder}/{name}", name, order_by=None)
        assert seen.value == plain.count() and flat.meta.n_events == plain.count()
        assert same_table(flat_from_scan(spark, f"{folder}/{name}").frame(), quick_flat(plain).frame())
    assert "empty_b" not in spark.read.parquet(f"{folder}/reco/reco_canonical.parquet").columns


def test_a_row_of_arrays_has_the_print_of_the_wide_row(spark, reco, odd):
    for df in (reco, odd):
        flat = quick_flat(df, fill="nan")
        wide, arrays = flat.frame(), flat.frame("arrays")
        prints = [f.select(row_print(f, "a").alias("p")).collect() for f in (wide, arrays)]
        assert sorted(r.p for r in prints[0]) == sorted(r.p for r in prints[1])
    one, two, three = (spark.sql(f"select array({x}) as v") for x in ("1, null", "null, 1", "1"))
    assert not same_table(one, two) and not same_table(one, three)
    none = spark.sql("select cast(null as array<int>) as v")
    assert not same_table(none, spark.sql("select cast(array() as array<int>) as v"))


def test_cleanup_takes_only_this_applications_tables(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "flatweave"
    (folder / "other").mkdir(parents=True, exist_ok=True)
    name = table_prefix(spark) + "one"
    spark.range(3).write.bucketBy(2, "id").option("path", shared_folder(spark)).saveAsTable(name)
    assert spark.table(name).count() == 3 and len(list(folder.iterdir())) == 2
    cleanup(spark)
    assert [p.name for p in folder.iterdir()] == ["other"]
    assert not spark.catalog.tableExists(name)
