"""Fill-in-the-middle by in-place block rotation.

A text is cut twice at token borders. Sentinels go into a bytearray at the cuts, and two
neighbouring blocks change places by three reversals: reverse both, then each by itself. The same
rotation with the other length takes the output back. Cuts and form follow from the hash of the
document's id, so a run that is repeated after a lost executor gives the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import column, fresh
from flatweave.llm.text import bytes_of, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 documents so many stay plain; of 100 others so many put the suffix first.
PLAIN_PERCENT = 10
SPM_PERCENT = 20

IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[ord("A"):ord("Z") + 1] = IS_LETTER[ord("a"):ord("z") + 1] = True
#: Bytes that start no code point.
INSIDE = (np.arange(256) & 0xC0) == 0x80


def rotate(body: bytearray, low: int, cut: int, high: int) -> None:
    """Exchange body[low:cut] and body[cut:high] in place; no other byte moves."""
    view = np.frombuffer(body, dtype=np.uint8)
    for a, b in ((low, high), (low, low + high - cut), (low + high - cut, high)):
        view[a:b] = view[a:b][::-1]


def forward(text: bytes, first: int, second: int, spm: bool) -> bytearray:
    """The text cut at two byte places, with sentinels, in the order of its form."""
    body = bytearray(text)
    body[second:second] = SUFFIX
    body[first:first] = MIDDLE
    body[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(body, 0 if spm else middle, suffix, len(body))
    return body


def backward(output: bytes, form: str) -> bytes:
    """The text of an output: the rotation is inverted and the sentinels leave.

    A text that holds a sentinel stays plain, so each sentinel of an output occurs once; none can
    arise at a border, as all begin with `<` and end with `>`.
    """
    if form == "plain":
        return bytes(output)
    body = bytearray(output)
    start, tail = (0, body.find(PREFIX)) if form == "spm" else (body.find(SUFFIX), body.find(MIDDLE))
    rotate(body, start, tail, len(body))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        at = body.find(mark)
        del body[at:at + len(mark)]
    return bytes(body)


def draws(doc_id: int | None, seed: int) -> np.ndarray:
    """Four whole numbers of 32 bits from the id; a missing id counts as empty text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    return np.frombuffer(hashlib.sha256(name.encode()).digest()[:16], dtype=">u4").astype(np.int64)


def _formed(seed: int, check: bool):
    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for low, high in slices(offsets):
                part = offsets[low:high + 1]
                ids = batch.column(0)[low:high].to_pylist()
                made = _slice(data[part[0]:part[-1]], part - part[0], ids, seed)
                if check:
                    forms = made.column("form").to_pylist()
                    back = [backward(b.as_py(), f) for b, f in zip(made.column("output"), forms)]
                    made = made.append_column("restored", pa.array(back, pa.binary()))
                yield made
    return formed


def _slice(data: np.ndarray, offsets: np.ndarray, ids: list, seed: int) -> pa.RecordBatch:
    letter = IS_LETTER[data]
    begins = ~INSIDE[data]
    points = np.append(0, np.cumsum(begins))
    joined = np.append(False, letter[:-1]) & letter
    joined[offsets[:-1][offsets[:-1] < len(data)]] = False
    tokens = np.flatnonzero(begins & ~joined)
    first = np.searchsorted(tokens, offsets)
    text, rows = data.tobytes(), []
    for k, doc_id in enumerate(ids):
        start, end = int(offsets[k]), int(offsets[k + 1])
        n = int(first[k + 1] - first[k])
        body, h = text[start:end], draws(doc_id, seed)
        if not body or h[2] % 100 >= 100 - PLAIN_PERCENT or any(
                mark in body for mark in (PREFIX, SUFFIX, MIDDLE)):
            rows.append((n, "plain", None, None, body))
            continue
        form = "spm" if h[3] % 100 < SPM_PERCENT else "psm"
        cuts = [int(tokens[first[k] + c]) if c < n else end
                for c in sorted((h[0] % (n + 1), h[1] % (n + 1)))]
        rows.append((n, form, int(points[cuts[0]] - points[start]),
                     int(points[cuts[1]] - points[cuts[0]]),
                     bytes(forward(body, cuts[0] - start, cuts[1] - start, form == "spm"))))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def transformed(docs: DataFrame, seed: int = 1, check: bool = False) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output text of every row.

    With check, a column `restored` holds the text rebuilt from output and form alone.

    A text has n tokens: runs of A-Z and a-z, and any other code point by itself. Null counts as
    empty; an empty text, and one that holds a sentinel, stays plain. A text without doc_id is cut as
    the id of empty text says. Repeated rows give repeated results; other columns are ignored; an
    empty table gives no rows. Texts are worked on whole, a bounded slice of rows at a time.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = ["output", "restored"] if check else ["output"]
    made = rows.mapInArrow(_formed(seed, check), ", ".join(
        ["doc_id long, n long, form string, prefix_chars long, middle_chars long",
         *(f"{c} binary" for c in texts)]))
    return made.withColumns({c: F.col(c).cast("string") for c in texts})


def restored(frame: DataFrame, output: str = "output", form: str = "form",
             to: str = "restored") -> DataFrame:
    """All columns and the text rebuilt from output and form alone; null where either is null.

    A column of that name in another case or the same is replaced.
    """
    kept = [c for c in frame.columns if c.lower() != to.lower()]
    body, which = fresh("_output", kept), fresh("_form", kept)
    given = frame.select(*(column(frame, c) for c in kept), column(frame, output).cast("binary").alias(body),
                         column(frame, form).alias(which))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, forms = batch.columns[-2:]
            texts = [None if form is None or body is None else backward(body, form)
                     for body, form in zip((b.as_py() for b in bodies), forms.to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.binary())],
                                             names=[*batch.schema.names[:-2], to])

    schema = given.drop(body, which).schema.add(to, "binary")
    return given.mapInArrow(back, schema).withColumn(to, F.col(to).cast("string"))


def digests(docs: DataFrame) -> DataFrame:
    """Contract of op11: hashes of output and restored text in place of the texts."""
    return transformed(docs, check=True).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        *(F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")))


#: The same rows in DuckDB, by lists of tokens.
DIGESTS_SQL = """
with t as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as tokens,
         sha256('1:' || coalesce(doc_id::varchar, '')) as h
  from documents),
d as (
  select *, len(tokens) as n,
         ('0x' || h[1:8])::bigint % (len(tokens) + 1) as c1, ('0x' || h[9:16])::bigint % (len(tokens) + 1) as c2,
         ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
  from t),
f as (
  select *, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                      or h3 % 100 >= 90 then 'plain'
                 when h4 % 100 < 20 then 'spm' else 'psm' end as form,
         array_to_string(tokens[1:least(c1, c2)], '') as p,
         array_to_string(tokens[least(c1, c2) + 1:greatest(c1, c2)], '') as m,
         array_to_string(tokens[greatest(c1, c2) + 1:], '') as s
  from d)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then length(p) end::bigint as prefix_chars,
       case when form <> 'plain' then length(m) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from f
"""
