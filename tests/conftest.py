import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flatweave.session import configured  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[4]").appName("flatweave-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))))
    session = configured(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def reco(spark):
    """40 rows with one column of each ordinary shape, lengths set by the row number."""
    return spark.range(0, 40, 1, 3).selectExpr(
        "id as eventNumber",
        "cast(id * 1.5 as float) as met",
        "slice(transform(sequence(0, 5), j -> cast(id + j / 10 as float)), 1, cast(id % 6 as int)) as jet_pt",
        "slice(transform(sequence(0, 2), j -> id - j * 0.25D), 1, cast(id % 3 + 1 as int)) as track_d0",
        "array(cast(id / 8 as float)) as msvtx_eta",
        "cast(array() as array<float>) as empty_b")


@pytest.fixture(scope="session")
def odd(spark):
    """Every unusual cell: NULL lists and elements, NaN, quotes, breaks, structs, odd names."""
    rows = [
        (1, 2.5, [1.0], [1, 2, 3], ["a,b", None, 'q"', " pad "], [], [[1, 2], [3]], ("x,y", 1), {"k": "v"},
         [float("nan"), 2.0], [(1, "p"), (2, None)], True, [True, False]),
        (2, float("nan"), [2.0], [], ["", "line\nbreak", "cr\rhere"], [], [], ('y"', 2), {"k": "v"},
         [1.5, None], [], None, []),
        (3, -1.0, [None], None, [], [], [[4]], ("z", None), None, [], [(3, "q")], False, [None]),
        (4, None, [float("nan")], [None, 7], None, [], None, None, {}, None, None, True, [True]),
    ]
    return spark.createDataFrame(rows, (
        "id long, `met.x` float, v1 array<double>, j array<int>, s array<string>, e array<float>, "
        "deep array<array<int>>, st struct<p:string,q:int>, m map<string,string>, f array<double>, "
        "ls array<struct<a:int,b:string>>, b boolean, `b``s` array<boolean>"))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
