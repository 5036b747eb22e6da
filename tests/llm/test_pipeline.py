"""The pipeline's stages, and the entry point without the training-data folders."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from flatweave.llm import jaccard, mixing, packing, substrings
from flatweave.llm.common import stored

from test_operators import plain_grams, words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark):
    base = " ".join(f"word{i} of tongue{i % 7}" for i in range(60))
    near = base.replace("word30", "other")
    tail = " ".join(f"plain{i} text{i * 7 % 11}" for i in range(40))
    rows = [(1, base, "en", "a"), (2, near, "en", "a"), (3, base, "en", "b"), (3, base, "en", "b"),
            (4, tail + " " + base[:300], "en", "b"), (5, None, None, None), (6, "12 34", "en", "a"),
            (7, "short text here", "en", "c"), (None, tail[:90], "en", "a")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], COLUMNS)
    stages = dict(corpus_pipeline.STAGES)
    out = stages["language ID"](spark, docs, "")
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {1, 2, 3, 4, 7, None}
    out = stages["n-gram Jaccard join"](spark, out, "")
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 4, 7]
    out = stages["suffix-array dedup"](spark, out, "")
    kept = {r.doc_id: r for r in out.collect()}
    assert kept[1].text == base and kept[7].text == "short text here"
    assert kept[4].text == tail + " " and kept[4].n_chars == len(tail) + 1
    out = stages["mixing sources to target weights"](spark, out, "")
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} <= {1, 4, 7, None}
    assert stages["packing"](spark, out, "").count() >= out.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), "").count() == 0


def test_languages_that_cannot_be_learned_are_kept(spark):
    texts = ["plain words", "Ünïcode", "12 34 ...", "", None, "слово", "1a"]
    docs = spark.createDataFrame([(i, t, None, "a", 0) for i, t in enumerate(texts)], COLUMNS)
    out = corpus_pipeline.keep_languages(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [0, 1, 5, 6]


def test_near_copies_are_found_without_ids(spark):
    def text(word):
        return " ".join(f"{word}{i} of {word}{i % 7}" for i in range(60))

    def near(word):
        return text(word).replace(f"{word}30", "other")

    a, b, c, d = map(text, ("a", "b", "c", "d"))
    rows = [(5, a), (3, near("a")), (None, a), (None, b), (None, near("b")), (None, c), (None, c),
            (7, c), (8, d), (8, near("d")), (8, "short"), (8, "short"), (9, "short"), (None, None),
            (None, None), (None, "1 2")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], COLUMNS)
    out = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sum(r in ((None, b), (None, near("b"))) for r in out) == 1
    assert sum(r in ((8, d), (8, near("d"))) for r in out) == 1
    assert {r for r in out if r[1] not in (b, near("b"), d, near("d"))} == {
        (3, near("a")), (7, c), (8, "short"), (None, None), (None, "1 2")}
    assert len(out) == 7


def test_repeats_are_cut_only_where_they_are(spark):
    first = " ".join(f"word{i} of tongue{i % 7}" for i in range(40))
    clean = " ".join(f"plain{i} text{i * 7 % 11}" for i in range(40))
    rows = [(1, first), (None, first), (None, clean), (1, clean[:130])]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], COLUMNS)
    out = corpus_pipeline.cut_repeats(spark, docs, "").collect()
    assert sorted(((r.doc_id or 0), r.text) for r in out) == [
        (0, clean[130:]), (1, clean[:130]), (1, first)]


def test_near_copies_and_repeats_are_gone_after_run(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "").cache()
    found = jaccard.jaccard_components(docs)
    assert found.where("doc_id <> component_id").count() <= 0.02 * docs.count()
    assert substrings.deduplicated(docs).where("n_removed > 0").count() <= 0.02 * docs.count()


# The whole pipeline in plain Python. Spark's hashes of ids and texts, which only order what is
# otherwise equal, are taken as given.

def in_a_language(rows):
    def ranked(grams):
        code = lambda g: sum((1 if c == "\0" else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
        return sorted(grams, key=lambda g: (-grams[g], code(g)))[:300]

    learned = defaultdict(Counter)
    for r in rows:
        if r["lang"] and r["text"]:
            learned[r["lang"]] += plain_grams(r["text"])
    profiles = [{g: i for i, g in enumerate(ranked(grams))} for grams in learned.values()]

    def score(text):
        mine = ranked(plain_grams(text or ""))
        return max((1 - sum(abs(p[g] - i) if g in p else 300 for i, g in enumerate(mine)) / (300 * len(mine))
                    for p in profiles), default=0) if mine else -1

    return [r for r in rows if score(r["text"]) >= corpus_pipeline.LEAST_SCORE]


def without_near_copies(rows):
    one = {r["key"]: r for r in rows}
    sets = {}
    for key, r in one.items():
        some = words(r["text"])
        sets[key] = ({tuple(some[i:i + 5]) for i in range(len(some) - 4)} if len(some) >= 5
                     else {tuple(some)} if some else set())
    label = {key: key for key in one}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in one:
        for b in one:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    groups = defaultdict(list)
    for key, r in one.items():
        groups[find(key)].append(r)
    return [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["key"])) for g in groups.values()]


def without_repeats(rows):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r["doc"], r["tie"])):
        body = (r["text"] or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 99):
            if body[k:k + 100] in seen:
                gone[k:k + 100] = True
            seen.add(body[k:k + 100])
        text = np.frombuffer(body, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if not gone.any():
            out.append(r)
        elif text.strip(" "):
            out.append(r | {"text": text, "n_chars": len(text)})
    return out


COLUMNS_OUT = ("doc_id", "text", "lang", "source", "n_chars")


def content(rows):
    return Counter(tuple(r[c] for c in COLUMNS_OUT) for r in rows)


def test_all_stages_equal_plain_python(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 110").collect()
    rows = [tuple(r) for r in real]
    rows += [(None, rows[3][1], "en", "s9", 1), (None, rows[4][1] + " and more", None, "s9", 2), rows[7], rows[7],
             (500, "12 34 --", "en", "s1", 8), (501, None, None, None, None), (502, "", "en", "s1", 0),
             (None, "A short one without an id.", "en", "s9", 5), (503, "clean " + rows[9][1][:400], "en", "s1", 406)]
    docs = stored(spark.createDataFrame(rows, COLUMNS).repartition(3))

    def keyed(frame):
        doc, tie = substrings.keyed(F.col("doc_id"), F.col("text"))
        return [r.asDict() for r in frame.select("*", jaccard.document_key(F.col("doc_id"), F.col("text")).alias("key"),
                                                 doc.alias("doc"), tie.alias("tie")).collect()]

    plain = [in_a_language, without_near_copies, without_repeats]
    for (_, stage), brute in zip(corpus_pipeline.STAGES, plain):
        want = brute(keyed(docs))
        docs = stored(stage(spark, docs, ""))
        assert docs.columns == list(COLUMNS_OUT)
        assert content(docs.collect()) == content(want)
    before, sums = Counter(), Counter()
    placed = mixing.Mixture(docs, fraction=corpus_pipeline.FRACTION, epochs=corpus_pipeline.EPOCHS)
    leaf = {(r.domain, r.language, r.source): r.budget for r in placed.leaves.collect()}
    whole = {r.text: r for r in docs.collect()}
    domain = {(r.source or ""): f"d{zlib.crc32((r.source or '').encode()) % 3}" for r in whole.values()}
    docs = stored(corpus_pipeline.mix_sources(spark, docs, ""))
    taken = docs.collect()
    for r in taken:
        assert r.text in whole or any((t or "").startswith(r.text) for t in whole)
        sums[domain[r.source or ""], r.lang or "", r.source or ""] += len(words(r.text))
    assert {k: n for k, n in leaf.items() if n} == dict(+sums)
    own = Tokenizer.from_file(packing.vocabulary_path())
    ids = Counter(tuple([r.doc_id, *own.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in taken)
    pieces, filled = defaultdict(list), Counter()
    for r in corpus_pipeline.pack_windows(spark, docs, "").collect():
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens].append(r)
        filled[r.sequence_id] += r.length
        before[r.doc_id] += r.length
    want = Counter()
    for (doc_id, *text), n in ids.items():
        at = 0
        for length in packing.cut(len(text)):
            part = np.array(text[at:at + length], "<u4").tobytes()
            want[doc_id, at, length, zlib.crc32(part), len(text)] += n
            at += length
    assert Counter({k: len(v) for k, v in pieces.items()}) == want
    assert max(filled.values()) <= 1024 and len(filled) <= 1.02 * sum(filled.values()) / 1024 + 1
    assert before == sum((Counter({k[0]: (len(k) - 1) * n}) for k, n in ids.items()), Counter())


def test_clashing_names_and_maps_pass(spark):
    more = ", _key int, _score string, _lang_pred int, _doc int, _tie int, _runs int, _cut int, _part int, m map<string,int>"
    base = " ".join(f"word{i} of tongue{i % 7}" for i in range(60))
    rows = [(1, base, "en", "a", 9), (2, base.replace("word30", "x"), "en", "a", 9), (2, base, "en", "a", 9),
            (4, "plain other text here " + base[:150], "de", "b", 9), (4, "plain other text here " + base[:150], "de", "b", 9)]
    extra = (7, "s", 8, 1, 2, 3, 4, 5, {"k": 6})
    docs = spark.createDataFrame([(*r, *extra) for r in rows], COLUMNS + more)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, ""))
        assert all(tuple(r)[5:] == extra for r in docs.collect())
    assert docs.columns == [c.split()[0] for c in (COLUMNS + more).split(", ")]
    assert {r.doc_id for r in docs.collect()} == {1, 4}


def test_a_text_is_cut_once(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{i} {passage} {i}", "en", "s", 9) for i in range(3)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    frame = corpus_pipeline.cut_repeats(spark, docs, "")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"EvalPython \[cut\(", plan)) == 1
    assert sorted(len(r.text) < 60 for r in frame.collect()) == [False, True, True]
