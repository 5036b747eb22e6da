"""The derived nested tables, and the folder for intermediate ones."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks.fixtures import lines_nested, table
from flatweave import quick_flat
from flatweave.session import shared_folder

SCALES = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")


@pytest.mark.skipif(not os.path.isdir(SCALES[0]), reason="no test tables")
def test_no_element_is_lost_and_the_width_follows_the_data(spark):
    widths = []
    for sf_dir in SCALES:
        pieces = table(spark, sf_dir, "documents").selectExpr(
            "sum(length(text) - length(replace(text, '\\n', '')) + 1) as n").first().n
        nested = lines_nested(spark, sf_dir).select("event_id", "qty", "line", "flag")
        assert nested.agg(F.sum(F.size("qty"))).first()[0] == pieces
        flat = quick_flat(nested)
        kept = flat.frame("arrays").selectExpr(
            "sum(size(filter(line, x -> x <> -999))) as n", "max(size(line)) as width").first()
        assert kept.n == pieces
        widths.append(kept.width)
    assert widths[0] < widths[1]


def test_shared_folder(spark):
    set_by_cluster = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second and first.startswith(set_by_cluster)
    warehouse = {"spark.sql.warehouse.dir": "file:/shared/warehouse"}
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: warehouse.get(key)))
    assert shared_folder(unset).startswith("file:/shared/warehouse/")
