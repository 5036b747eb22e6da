"""Random nested tables against a plain Python account of the same rules."""

import csv
import glob

import numpy as np
import pytest

from flatweave import census, quick_flat
from flatweave.operators import summary

WORDS = ["a", "b,c", 'd"e', "", " f ", "g\nh", "é", "NaN", "-999"]


def random_list(rng, longest, make):
    if rng.random() < 0.1:
        return None
    return [None if rng.random() < 0.1 else make() for _ in range(rng.integers(0, longest + 1))]


def random_rows(seed):
    rng = np.random.default_rng(seed)
    longest = {c: int(rng.integers(0, 7)) for c in ("i", "d", "s")}
    rows = []
    for key in range(int(rng.integers(1, 40))):
        rows.append((
            key,
            random_list(rng, longest["i"], lambda: int(rng.integers(-5, 5))),
            random_list(rng, longest["d"], lambda: float(rng.choice([0.5, -2.25, float("nan"), 1e3]))),
            random_list(rng, longest["s"], lambda: str(rng.choice(WORDS))),
            [float(key)],
            random_list(rng, 3, lambda: list(range(int(rng.integers(0, 4))))),
        ))
    return rows


SCHEMA = "key int, i array<int>, d array<double>, s array<string>, one array<double>, deep array<array<int>>"


def expected_record(lists):
    lengths = [len(v or []) for v in lists]
    top = max(lengths)
    if top == 0:
        return "empty", 0, 0
    if min(lengths) == 1 and top == 1:
        return "vec1", 1, 0
    return "jagged", top, sum(top - n for n in lengths)


def expected_text(value):
    if value is None or value != value:
        return ""
    return str(value)


@pytest.mark.parametrize("seed", range(6))
def test_random_table(spark, folder, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["name"]: r for r in census(df).collect()}
    header, spacers = [], 0
    for at, name in ((2, "d"), (1, "i"), (0, "key"), (4, "one"), (3, "s")):
        if name == "key":
            header.append("key")
            continue
        lists = [r[at] for r in rows]
        category, width, pads = expected_record(lists)
        record = found[name]
        assert (record.category, record.max_len, record.n_spacers) == (category, width, pads)
        if category != "empty":
            lengths = [len(v or []) for v in lists]
            assert record.len_p95 == pytest.approx(np.percentile(lengths, 95))
            header += [name] if category == "vec1" else [f"{name}_{j}" for j in range(width)]
            spacers += pads

    flat = quick_flat(df)
    assert flat.layout.names == header
    assert summary.projected_columns(census(df)).first()[0] == len(header)
    assert summary.projected_spacers(census(df)).first()[0] == spacers

    at = {"key": 0, "i": 1, "d": 2, "s": 3, "one": 4}
    fills = {"i": "-999", "d": "-999.0", "s": "-999.0"}
    table = []
    for r in rows:
        line = []
        for name in header:
            base, _, slot = name.partition("_")
            if not slot:
                value = r[at[base]]
                line.append(expected_text(value[0] if isinstance(value, list) else value))
            else:
                items = r[at[base]] or []
                line.append(expected_text(items[int(slot)]) if int(slot) < len(items) else fills[base])
        table.append(line)

    for kind, threshold in (("columns", 2000), ("lines", 0)):
        path = f"{folder}/{kind}"
        report = flat.write(path, wide_threshold=threshold).first()
        assert (report.n_rows, report.n_columns) == (len(rows), len(header))
        got = []
        for part in glob.glob(f"{path}/part-*"):
            with open(part, newline="") as f:
                lines = list(csv.reader(f))
            assert not lines or lines[0] == header
            got += lines[1:]
        assert sorted(got) == sorted(table)
