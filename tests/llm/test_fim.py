"""Fill-in-the-middle against token lists, exact round trips, and odd texts."""

import hashlib
import re

import pytest

from flatweave.llm import fim

DOCS = "doc_id long, text string, FORM int, Output int, restored string, `a.b` map<string,int>"


def expected(doc_id, text):
    """The contract in plain Python."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = ("".join(x) for x in (tokens[:low], tokens[low:high], tokens[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(tokens), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts():
    return [None, "", "a", " ", "\n", "abc def", "Ää ß日本 x𝄞y", "<P>", "a <M> b", "<S", "P>x<P", "<<P <S<M",
            "x" * 3000, "ab1" * 4000, "\x00 b\x00", "same text", "same text", "é" * 50] + [
            f"Text {i}: some words, more; ünd <{'PSM'[i % 3]} end.\n" * (i % 7 + 1) for i in range(200)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(None if i in (3, 6, 12) else i - 5, t, 1, 2, "old", {"k": 1}) for i, t in enumerate(texts)]
    rows += [rows[30]] * 3
    return spark.createDataFrame(rows, DOCS).repartition(3)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_rows_equal_the_contract(docs):
    given = [(r.doc_id, r.text) for r in docs.collect()]
    found = fim.transformed(docs, check=True)
    want = [(*expected(*r), r[1] or "") for r in given]
    assert ordered(found.collect()) == ordered(want)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    hashed = [(*r[:5], *(hashlib.sha256(x.encode()).hexdigest() for x in r[5:])) for r in want]
    assert ordered(fim.digests(docs).collect()) == ordered(hashed)


def test_output_and_form_alone_restore_the_text(docs):
    made = fim.transformed(docs).drop("n", "prefix_chars", "middle_chars")
    back = fim.restored(made.withColumnRenamed("doc_id", "Restored")).collect()
    want = [(*expected(r.doc_id, r.text)[::5], r.text or "") for r in docs.collect()]
    assert ordered((r.output, r.restored) for r in back) == ordered(x[1:] for x in want)
    assert back[0].__fields__ == ["form", "output", "restored"]
    lost = made.selectExpr("cast(null as string) output", "form").limit(2)
    assert [r.restored for r in fim.restored(lost).collect()] == [None, None]


def test_rotation_moves_only_its_blocks_and_inverts():
    body = bytearray(b"0123456789")
    fim.rotate(body, 2, 5, 9)
    assert body == b"01" + b"5678" + b"234" + b"9"
    fim.rotate(body, 2, 6, 9)
    assert body == b"0123456789"
    for low, cut, high in ((0, 0, 10), (0, 10, 10), (4, 4, 4)):
        fim.rotate(body, low, cut, high)
        assert body == b"0123456789"


def test_every_cut_of_a_tricky_text_comes_back():
    text = "<P<S><".replace("<S>", "<S") + ">M>é<"
    raw = text.encode()
    places = [i for i in range(len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]
    for a in places:
        for b in (x for x in places if x >= a):
            for spm in (True, False):
                out = fim.forward(raw, a, b, spm)
                assert fim.backward(bytes(out), "spm" if spm else "psm") == raw


def test_empty_table_and_null_column(spark):
    assert fim.digests(spark.createDataFrame([], DOCS)).collect() == []
    void = spark.createDataFrame([(1,), (None,)], "doc_id int").selectExpr("doc_id", "null as text")
    assert [(r.n, r.form, r.output) for r in fim.transformed(void).collect()] == [(0, "plain", "")] * 2
