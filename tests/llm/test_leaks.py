"""Benchmark decontamination against a plain scan, and on odd texts and items."""

import hashlib
import re

import numpy as np
import pytest

from flatweave.llm import leaks

DOCS = "doc_id long, text string, words int, KEY0 int, at string, gram_id int, `a.b` map<string,int>"
ITEMS = "item_id long, text string, words int, length string"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def windows(items):
    found = {}
    for item, text in items:
        some = words(text)
        n = min(10, len(some))
        for i in range(len(some) - n + 1 if n else 0):
            found.setdefault(tuple(some[i:i + n]), set()).add(item)
    return found


def hit_words(text, found):
    some = words(text)
    hit, items = set(), set()
    for n in {len(g) for g in found}:
        for i in range(len(some) - n + 1):
            if tuple(some[i:i + n]) in found:
                hit.update(range(i, i + n))
                items |= found[tuple(some[i:i + n])]
    return hit, {str(i) for i in items if i is not None}


def expected(doc_id, text, found):
    hit, items = hit_words(text, found)
    names = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return doc_id, len(words(text)), len(hit), len(items), names, bool(hit)


@pytest.fixture(scope="module")
def items():
    rng = np.random.default_rng(3)
    prose = [" ".join(f"w{j}" for j in rng.integers(0, 30, n)) for n in (10, 11, 25, 40, 9)]
    return [(1, prose[0]), (2, prose[1]), (10, prose[2]), (3, prose[3]), (4, prose[2].upper()),
            (5, "short item"), (6, "Ünique"), (7, None), (8, ""), (9, " .,;\x00 "), (None, prose[4]),
            (1, prose[3] + " w1"), (11, prose[0]), (-2, "a-b_c d"), (3, prose[3])]


@pytest.fixture(scope="module")
def texts(items):
    rng = np.random.default_rng(4)
    prose = [t for _, t in items if t and len(t) > 20]
    def other(n):
        return " ".join(f"v{j}" for j in rng.integers(0, 50, n))
    made = [None, "", "...", "w1", "short  ITEM!", "short-item short item", "ünique", "Ünique", "A;b'c\tD",
            other(9), other(10), other(300)]
    for text in prose:
        some = text.split(" ")
        made += [text, other(5) + "\n" + text + ". " + other(7), " ".join(some[:9]), " ".join(some[1:]),
                 "--".join(some) + "?" + text, other(2000) + " " + text + " " + other(900)]
    return made


@pytest.fixture(scope="module")
def tables(spark, texts, items):
    rows = [(None if i % 9 == 8 else i % 30, t, 0, 0, "x", 0, {"k": 1}) for i, t in enumerate(texts)]
    rows += [rows[20]] * 4
    return (spark.createDataFrame(rows, DOCS).repartition(3),
            spark.createDataFrame([(*i, 1, "y") for i in items], ITEMS).repartition(2))


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_equal_a_plain_scan(tables, items, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(leaks, "BROADCAST_WINDOWS", 0)
    docs, bench = tables
    found = windows(items)
    want = [expected(r.doc_id, r.text, found) for r in docs.collect()]
    assert ordered(leaks.contamination(docs, bench).collect()) == ordered(want)
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_documents_and_spans_leave(tables, items):
    docs, bench = tables
    found = windows(items)
    rows = docs.collect()
    kept = leaks.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert ordered(r[:2] for r in kept.collect()) == ordered(
        r[:2] for r in rows if not hit_words(r.text, found)[0])
    cut = leaks.decontaminated(docs, bench, remove="spans")
    assert cut.columns == docs.columns

    def without(text):
        if text is None:
            return None
        hit, number, out = hit_words(text, found)[0], -1, ""
        for piece in re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+|[^0-9A-Za-z\x80-\U0010FFFF]+", text):
            if re.match(r"[0-9A-Za-z\x80-\U0010FFFF]", piece):
                number += 1
                out += "" if number in hit else piece
            else:
                out += "" if number in hit and number + 1 in hit and same_run(hit, number) else piece
        return out

    def same_run(hit, number):  # runs that only touch are one
        return {number, number + 1} <= hit

    assert ordered(r[:2] for r in cut.collect()) == ordered((r.doc_id, without(r.text)) for r in rows)
    with pytest.raises(ValueError):
        leaks.decontaminated(docs, bench, remove="lines")


def test_empty_tables(spark, tables):
    docs, bench = tables
    nothing = spark.createDataFrame([], DOCS)
    assert leaks.contamination(nothing, bench).collect() == []
    none = spark.createDataFrame([], ITEMS)
    clean = leaks.contamination(docs, none).collect()
    assert len(clean) == docs.count() and not any(r.contaminated or r.n_hit or r.n_items for r in clean)
    assert leaks.decontaminated(docs, none).count() == docs.count()


def test_one_passage_in_a_third_of_all_rows(spark, items):
    text = items[3][1]
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) as doc_id",
                                        f"if(id % 3 = 0, 'x {text} y', concat('clean ', id)) as text")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = leaks.contamination(docs, bench).collect()
    assert len(rows) == 3000 and sum(r.contaminated for r in rows) == 1000
    assert {(r.doc_id, r.n_hit) for r in rows if r.contaminated} == {(None, 40)}
