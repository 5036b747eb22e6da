"""Each operator against a brute-force version, and on odd tables."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flatweave.llm import (ann, chat, common, jaccard, kneser, language, mixing, neardup, packing, sharding,
                           substrings, suffixes)

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `Lang_Pred` int, `a.b` int"
WORDS = [f"w{i}" for i in range(40)]


def rows_of(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [(i, t, ("en", "de", None)[k % 3], f"s{k % 4}", len(t or ""), 1, 2)
            for k, (i, t) in enumerate(zip(ids, texts))]


@pytest.fixture(scope="module")
def texts():
    """Nulls, empty, one word, white space, exact and near copies, shared passages, a long text."""
    rng = np.random.default_rng(5)
    def prose(n):
        return " ".join(f"{WORDS[i]}{j}" for i, j in rng.integers(0, 40, (n, 2)))
    base, passage = prose(90), prose(40)
    near = base.split(" ")
    near[3] = "Änderung"
    return [None, "", " \t\n", "Word", "ONE two", base, base, " ".join(near), base.upper(),
            prose(30) + " " + passage + " " + prose(20), passage + prose(50), prose(60) + passage,
            "aé" * 200, "aé" * 200 + "b", "x" * 350, prose(9000) + base, "1234 !!", prose(5), prose(4)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


# 1

def test_language_accuracy_and_odd_texts(spark, docs, nothing):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = language.predictions(real).join(real.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == real.count() and held
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    odd = {r.doc_id: r for r in language.predictions(docs).collect()}
    assert len(odd) == 19 and all(odd[i].lang_pred == "und" for i in (0, 1, 2, 16))
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert odd[5].lang_pred == odd[6].lang_pred in ("en", "de")
    assert language.predictions(nothing).count() == 0
    kept = language.identify(docs, {"x": np.array([97])})
    assert kept.columns.count("lang_pred") == 1 and "Lang_Pred" not in kept.columns


def plain_grams(text):
    """Letters lower-cased one by one, runs of others as one blank; n-grams of 1 to 3, none of blanks alone."""
    runs = re.sub(r"\0+", "\0", "\0" + "".join(
        (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else "\0" for c in text) + "\0")
    if len(runs) < 2:
        return Counter()
    return Counter(runs[i:i + n] for n in (1, 2, 3) for i in range(len(runs) - n + 1) if runs[i:i + n] != "\0")


def test_languages_equal_plain_out_of_place_distance(spark, docs):
    def ranked(grams, size=300):
        code = lambda g: sum((1 if c == "\0" else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
        return sorted(grams, key=lambda g: (-grams[g], code(g)))[:size]

    real = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 60")
    frame = real.select("doc_id", "text", "lang").unionByName(
        docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text", "lang"))
    rows = frame.collect()
    learned = defaultdict(Counter)
    for r in rows:
        if r.lang and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            learned[r.lang] += plain_grams(r.text)
    profiles = {lang: {g: i for i, g in enumerate(ranked(grams))} for lang, grams in learned.items()}
    got = {r.doc_id: r for r in language.predictions(frame).collect()}
    for r in rows:
        mine = ranked(plain_grams(r.text or ""))
        if not mine:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        away = {lang: sum(abs(known[g] - i) if g in known else 300 for i, g in enumerate(mine))
                for lang, known in profiles.items()}
        best = min(sorted(away), key=away.get)
        assert got[r.doc_id].lang_pred == best, r.doc_id
        assert got[r.doc_id].score == pytest.approx(1 - away[best] / (300 * len(mine)))


def test_profiles_rank_by_count():
    codes, counts = language.grams_of("aab aab", 2)
    assert counts.sum() == 6 + 8 and language.profile_of(codes, counts, 1)[0] == ord("a")
    long = "ab cd " * 90000
    one = language.grams_of(long)
    assert dict(zip(*map(np.ndarray.tolist, one)))[ord("a")] == 90000


# 2 and 8

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 16))
    x[50:60] = x[50]
    x[60:80] = x[60] + rng.normal(scale=0.05, size=(20, 16))
    x[80] = 2 * x[50]
    rows = [(i, [float(v) for v in r], i % 3, 7) for i, r in enumerate(x)]
    for i in range(50, 81):
        rows[i] = (i, rows[i][1], 1, 7)
    bad = [(400, None, 1, 7), (401, [0.0] * 16, 1, 7), (402, [float("nan")] + [1.0] * 15, 1, 7),
           (403, [1.0, None], 1, 7), (404, [], None, 7), (405, rows[50][1], None, 7),
           (406, [1.0, 2.0], 1, 7), (450, [float("inf")] * 16, 1, 7)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int, id int")
    return frame.repartition(3), {i: np.array(v) for i, v, *_ in rows}


def test_nearest_recall_order_and_odd_vectors(spark, vectors):
    frame, known = vectors
    known = known | {405: known[50]}
    got = defaultdict(list)
    for r in sorted(ann.nearest(frame).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in known if i % 50 == 0}
    hits = 0
    for q, found in got.items():
        cosine = {i: v @ known[q] / (np.linalg.norm(v) * np.linalg.norm(known[q]))
                  for i, v in known.items() if i != q}
        best = sorted(cosine, key=lambda i: (-round(cosine[i], 12), i))[:5]
        hits += len({i for i, _ in found} & set(best))
        assert len(found) == 5 and all(abs(cosine[i] - s) < 1e-12 for i, s in found)
    assert hits >= 0.9 * 5 * len(got)
    assert [i for i, _ in got[50]] == [51, 52, 53, 54, 55]
    assert ann.nearest(frame.where("false")).count() == 0
    few = frame.where("vec_id in (0, 3, 7)")
    assert ann.nearest(few).count() == 2


def test_an_id_with_several_vectors_has_its_best(spark):
    rng = np.random.default_rng(11)
    rows = [(i % 20, rng.normal(size=6)) for i in range(60)] + [(100, rng.normal(size=6)) for _ in range(3)]
    frame = spark.createDataFrame([(i, v.tolist(), None) for i, v in rows] * 2,
                                  "vec_id long, embedding array<double>, label string")
    got = defaultdict(list)
    for r in sorted(ann.nearest(frame).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    for q in (0, 100):
        best = {}
        for a in (v for i, v in rows if i == q):
            for i, b in rows:
                if i != q:
                    best[i] = max(best.get(i, -2), a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
        assert {i: s for i, s in got[q]}.items() <= {i: round(s, 9) for i, s in best.items()}.items()
        assert len(got[q]) == 5 and len({i for i, _ in got[q]}) == 5
    assert set(got) == {0, 100}


def test_rotations_keep_lengths():
    x = np.random.default_rng(0).normal(size=(5, 12))
    for y in ann.Rotations(2).coordinates(x):
        assert np.allclose((y * y).sum(axis=1), (x * x).sum(axis=1))


def test_near_duplicates(spark, vectors):
    frame, known = vectors
    got = {r.vec_id: r for r in neardup.near_duplicates(frame).collect()}
    label = {r.vec_id: r.label for r in frame.collect()}
    links = {i: {j for j in known if j != i and label[i] == label[j] and known[i] @ known[j]
                 / (np.linalg.norm(known[i]) * np.linalg.norm(known[j])) >= 0.93} for i in known}
    component = {i: i for i in known}
    for _ in known:
        component = {i: min([component[i], *(component[j] for j in links[i])]) for i in known}
    assert len(got) == 408
    for i, r in got.items():
        assert (r.n_links, r.component_id) == (len(links.get(i, ())), component.get(i, i)), i
        assert r.kept == (r.component_id == i)
    assert neardup.near_duplicates(frame.where("false")).count() == 0


# 3

def test_chat_against_sql(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"),
             (2, 2, "user", "c"), (3, 0, "user", "a"), (3, 1, "assistant", None), (4, 0, "user", ""),
             (5, 0, "user", None), (6, 0, "user", "a"), (6, 1, "assistant", "b"), (6, 2, "user", "c"),
             (7, 3, "user", "a"), (7, 9, "assistant", "b"), (8, None, None, None), (None, 0, "user", "z"),
             (9, 0, "user", "a"), (9, 0, "user", "a"), (9, 1, "user", "x" * 9000),
             # A null role before a text, and that text as a role before a null: no equals.
             (21, 0, None, "user"), (22, 0, "user", None), (23, 0, None, "user"), (23, 1, "x", "y")]
    frame = spark.createDataFrame([(*t, 1) for t in turns],
                                  "conv_id long, turn long, role string, text string, position int")
    con = duckdb.connect()
    con.register("conversations", frame.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    columns = ["conv_id", "position", "n_turns", "n_snapshots", "chat"]
    want = sorted(con.sql(f"select {', '.join(columns)} from ({chat.RENDERED_SQL})").fetchall())
    got = chat.rendered(frame)
    assert sorted(tuple(r) for r in got.select(columns).collect()) == want
    assert {r[0] for r in want} == {2, 3, 4, 5, 8, 9, 23} and 5 in {r[0] for r in want}
    assert chat.rendered(frame.where("false")).count() == 0


# 4

def test_kneser_ney_against_dictionaries(spark, docs, texts, nothing):
    lists = {i: [*words(t), None] for i, t in enumerate(texts)}
    train = [lists[i] for i in lists if zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([None, *t], t))
    before, after = Counter(b for _, b in pairs), defaultdict(lambda: [0, 0, 0])
    for (a, _), n in pairs.items():
        after[a][min(n, 3) - 1] += 1

    def discounts(values):
        c = Counter(values)
        return kneser.discounts(*(c[i] for i in (1, 2, 3, 4)))

    d, e = discounts(pairs.values()), discounts(before.values())
    low = [sum(v == 1 for v in before.values()), sum(v == 2 for v in before.values())]
    spare = (e[0] * low[0] + e[1] * low[1] + e[2] * (len(before) - sum(low))) / len(pairs)

    def less(n, off):
        return n - off[min(n, 3) - 1] if n else 0

    def lower(w):
        return less(before[w], e) / len(pairs) + spare / (len(count) + 1)

    assert abs(sum(map(lower, count)) + spare / (len(count) + 1) - 1) < 1e-12

    def chance(a, b):
        if not count[a]:
            return lower(b)
        return (less(pairs[a, b], d) + sum(x * y for x, y in zip(d, after[a])) * lower(b)) / count[a]

    total = sum(count.values())
    for r in kneser.perplexities(docs).collect():
        t = lists[r.doc_id]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in t)
        score = sum(math.log10(chance(*p)) for p in zip([None, *t], t))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[w] > 0 for w in t), total)
        assert abs(r.base_score - base) < 1e-7 and abs(r.score - score) < 1e-7
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    assert kneser.perplexities(nothing).count() == 0


# 5

def filled(total, nodes):
    """Share total by weight among (name, weight, cap), giving what does not fit to the others."""
    out, open_ = dict.fromkeys((n for n, _, _ in nodes), 0.0), list(nodes)
    while open_ and total > 1e-9:
        weights = sum(w for _, w, _ in open_)
        full = [(n, w, c) for n, w, c in open_ if total * w / weights >= c]
        if not full:
            return out | {n: total * w / weights for n, w, _ in open_}
        for n, _, c in full:
            out[n], total = c, total - c
        open_ = [x for x in open_ if x not in full]
    return out


def test_budgets_fill_siblings_first(spark):
    supply = {("d0", "en", "a"): 100, ("d0", "en", "b"): 10, ("d0", "de", "c"): 5, ("d1", "en", "d"): 7,
              ("d1", "fr", "e"): 400, ("d2", "", ""): 0}
    leaves = spark.createDataFrame([(*k, v, 1) for k, v in supply.items()],
                                   "domain string, language string, source string, supply long, docs long")
    got = {(r.domain, r.language, r.source): r.budget
           for r in mixing.leaf_budgets(leaves, 0.7, 1, {"d0": 3.0}, {"en": 2.0}).collect()}
    cap = lambda *key: sum(v for k, v in supply.items() if k[:len(key)] == key)
    top = filled(0.7 * 522, [("d0", 3, cap("d0")), ("d1", 1, cap("d1")), ("d2", 1, 0)])
    for d, given in top.items():
        langs = filled(given, [(x, 2 if x == "en" else 1, cap(d, x)) for x in {k[1] for k in supply if k[0] == d}])
        for x, more in langs.items():
            for s, want in filled(more, [(k[2], 1, v) for k, v in supply.items() if k[:2] == (d, x)]).items():
                assert abs(got[d, x, s] - want) <= 1
    assert sum(got.values()) == pytest.approx(0.7 * 522, abs=3)


def test_mixture_takes_prefixes(spark, docs, nothing):
    rows = mixing.mixed(docs.unionByName(docs.where("doc_id = 5"))).collect()
    assert len(rows) == 20
    leaves = defaultdict(list)
    for r in rows:
        leaves[r.domain, r.language, r.source].append(r)
    for leaf in leaves.values():
        assert sum(r.tokens_taken for r in leaf) == leaf[0].budget
        cut = [r for r in leaf if r.tokens_taken not in (r.tokens * r.epoch_copies,)]
        assert len(cut) <= 1 and all(0 < r.tokens * r.epoch_copies - r.tokens_taken < r.tokens for r in cut)
    assert mixing.mixed(nothing).count() == 0


def test_texts_are_the_prefix_of_the_epochs(spark, docs, texts):
    """Which documents are taken, by a plain walk over the hash order of every leaf."""
    rows = spark.createDataFrame(
        [(None if i % 5 == 3 else i, " ".join(f"w{j}" for j in range(i % 13)) + " " * (i % 2), "en" if i % 3 else None,
          f"s{i % 2}", 7, 1, 2) for i in range(120)] + [(7, "same text of five words", "en", "s1", 7, 1, 2)] * 40
        + [(None, "x y z", "en", "s0", 7, 1, 2)] * 50, DOCS).repartition(3)
    for fraction, epochs in ((0.7, 2), (1.0, 2), (0.3, 1), (2.0, 2), (0.0, 1)):
        mixture = mixing.Mixture(rows, fraction=fraction, epochs=epochs)
        info = mixture.placed.collect()
        leaves = defaultdict(list)
        for r in info:
            leaves[r.domain, r.language, r.source].append(r)
        want = Counter()
        for leaf in leaves.values():
            left = leaf[0].budget
            supply = sum(r._n * r._tokens for r in leaf)
            whole = left // supply if supply else 0
            left -= whole * supply
            for r in sorted(leaf, key=lambda r: (r._order, r._id is not None, r._id or 0, r._tie)):
                for _ in range(r._n):
                    taken = min(left, r._tokens)
                    if left > 0 and (taken or not r._tokens):
                        want[r._id, r.domain, taken, r._tokens] += 1
                    left -= taken
                want[r._id, r.domain, r._tokens, r._tokens] += whole * r._n
        got = mixture.texts()
        assert got.columns == rows.columns
        held = got.collect()
        assert Counter((r.doc_id, len(words(r.text))) for r in held) == sum(
            (Counter({(k[0], k[2]): n}) for k, n in want.items() if n), Counter())
        assert all(r.n_chars in (7, len(r.text)) for r in held)
        sums = mixture.rows().collect()
        assert len(sums) == rows.count()
        assert sum(r.tokens_taken for r in sums) == sum(len(words(r.text)) for r in held)


# 6

def test_suffix_arrays():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lanes = [np.append(np.tile(rng.integers(1, rng.integers(2, 6), rng.integers(0, 20)),
                                   rng.integers(1, 3)), 0) for _ in range(rng.integers(1, 6))]
        lengths = np.array([len(x) for x in lanes])
        found = suffixes.suffix_arrays(np.concatenate(lanes).astype(np.int64), lengths)
        for lane, start in zip(lanes, np.cumsum(lengths) - lengths):
            assert (found[start:start + len(lane)] - start).tolist() == suffixes.naive(lane)


def decided_rows(batches):
    return [r for b in substrings._decided(iter(batches)) for r in b.to_pylist()]


def place_batches(rows, size):
    rows = sorted(rows, key=lambda r: (r[5], *r[:5]))
    names = [n.split()[0] for n in substrings.PLACES.split(", ")]
    for low in range(0, len(rows), size):
        cells = list(zip(*rows[low:low + size]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "kind" else pa.int64())
                                          for n, c in zip(names, cells)], names=names)


def test_places_are_decided_alike_in_any_batches():
    rng = np.random.default_rng(2)
    rows = []
    for gram in range(60):
        for _ in range(int(rng.integers(1, 120)) if gram % 3 == 0 else int(rng.integers(1, 5))):
            rows.append((gram, int(rng.integers(0, 50 if gram % 2 else 3)), int(rng.integers(0, 9)), 0,
                         int(rng.integers(0, 40)) << 16 | 1 << 8, 0))
    rows += [(7, substrings.LARGE, 0, 0, 0, 0), (200, 5, 1, 0, 1 << 8, substrings.HASHED),
             (201, 5, 1, 0, 1 << 8, substrings.REPEATED)]
    known = defaultdict(set)
    for gram, context, *_, kind in rows:
        if kind == 0 and context != substrings.LARGE:
            known[gram].add(context)
    want, seen, first = Counter(), set(), set()
    for gram, context, doc, tie, place, kind in sorted(rows, key=lambda r: (r[5], *r[:5])):
        if kind:
            want[gram, doc, tie, place, kind] += 1
        elif context != substrings.LARGE and (gram, context, doc, tie, place >> 16) not in seen:
            large = len(known[gram]) > substrings.CONTEXTS or gram == 7
            here = substrings.HASHED if large else substrings.SORTED if len(known[gram]) > 1 else 0
            here = substrings.REPEATED if (gram, context) in first else here
            want[gram, doc, tie, place, here] += here > 0
            seen.add((gram, context, doc, tie, place >> 16))
            first.add((gram, context))
    for size in (1, 7, 100, 10_000):
        got = Counter(tuple(r.values()) for r in decided_rows(place_batches(rows, size)))
        assert got == +want, size


def test_one_gram_of_four_million_rows_needs_no_memory():
    import tracemalloc

    def batches():
        for k in range(400):
            n = np.arange(10_000) + 10_000 * k
            zero = np.zeros(10_000, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(zero + 5), pa.array(zero + 9), pa.array(n), pa.array(zero), pa.array(zero + 256),
                 pa.array(zero.astype(np.int32))], names=["gram", "context", "doc", "tie", "place", "kind"])

    tracemalloc.start()
    rows = sum(b.num_rows for b in substrings._decided(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4_000_000 - 1 and peak < 16 << 20


def test_repeats_against_brute_force(spark, docs, texts, nothing):
    seen, want = set(), {}
    for i, text in enumerate(texts):
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 99):
            window = body[k:k + 100]
            if window in seen:
                gone[k:k + 100] = True
            seen.add(window)
        spans = int(np.diff(np.append(0, gone.astype(int))).clip(0).sum())
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
        want[i] = (len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in substrings.deduplicated(docs).collect()}
    assert got == want and want[6][1] == len(texts[6])
    twice = substrings.deduplicated(docs.where("doc_id in (5, 11)").unionByName(docs.where("doc_id = 5")))
    assert sum(r.n_removed for r in twice.collect()) == 0
    none = spark.createDataFrame([(None, texts[5]), (9, texts[5])], "doc_id long, text string")
    assert {r.doc_id: r.n_removed > 0 for r in substrings.deduplicated(none).collect()} == {None: True, 9: False}
    assert substrings.deduplicated(nothing).count() == 0


def test_texts_that_share_an_id_are_told_apart(spark):
    rng = np.random.default_rng(8)

    def noise(n):
        return "".join(map(chr, rng.integers(97, 123, n)))

    first, clean, other, short = noise(400), noise(400), noise(300), noise(40)
    rows = [(1, first), (None, first), (None, clean), (None, short), (None, clean), (2, clean[:150] + other),
            (2, first[50:250]), ((1 << 63) - 1, other + first[:120])]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in substrings.deduplicated(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter([(1, 400, 0), (None, 400, 400), (None, 400, 150), (None, 40, 0), (None, 400, 150),
                           (2, 450, 0), (2, 200, 200), ((1 << 63) - 1, 420, 420)])
    # More contexts than one array takes, of rows that all lack an id.
    passage = noise(300)
    texts = [noise(150) + passage + noise(150) for _ in range(45)]
    many = spark.createDataFrame([(None, t) for t in texts for _ in range(3)], "doc_id long, text string")
    removed = Counter(r.n_removed >= 300 for r in substrings.deduplicated(many).collect())
    assert removed == {True: 132, False: 3}


def test_many_contexts_go_by_window_hash(spark, monkeypatch):
    rng = np.random.default_rng(2)
    passage = "".join(map(chr, rng.integers(97, 123, 300)))
    texts = ["".join(map(chr, rng.integers(97, 123, 150))) + passage
             + "".join(map(chr, rng.integers(97, 123, 150))) for _ in range(45)]
    got = substrings.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for r in got.collect():
        assert 0 <= r.n_removed - (300 if r.doc_id else 0) <= 4


# 7

def test_shards(spark, docs, nothing):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sharding.sharded(real.unionByName(real.limit(5)), 6).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    sizes = [sum(r.size for r in part) for part in by.values()]
    largest = max(r.size for r in rows)
    assert len(rows) == real.count() + 5 and set(by) == set(range(6))
    assert max(sizes) - min(sizes) <= 2 * largest
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())
    odd = {r.doc_id: r for r in sharding.sharded(docs, 4).collect()}
    assert odd[0].size == odd[1].size == 8 and odd[0].text_crc32 == 0 and odd[0].grown_shard is None
    assert odd[12].size == 608 and odd[12].text_crc32 == zlib.crc32(("aé" * 200).encode())
    assert sharding.sharded(nothing).count() == 0


def test_cuts_equal_a_plain_tree(spark):
    """The same points cut by sorting whole nodes: what passes the weighted median goes right."""
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ["by_lang", "by_size", "by_source"]
    place = F.xxhash64("doc_id")
    points = real.select("doc_id", (F.octet_length("text") + 8).cast("long").alias("size"), "source", "lang")
    found = sharding.dimensions(points)
    points = points.select("doc_id", "size", *(sharding.spread(found[n], F.xxhash64(F.lit(n), place), F.col("doc_id"))
                                               .alias(n) for n in names)).cache()
    rows = [r.asDict() for r in points.collect()]
    whole = {n: max(r[n] for r in rows) - min(r[n] for r in rows) for n in names}
    want = {}

    def cut(part, first, shards):
        if shards == 1:
            want.update((r["doc_id"], first) for r in part)
            return
        width = {n: (max(r[n] for r in part) - min(r[n] for r in part)) / whole[n] for n in names}
        axis = max(names, key=lambda n: width[n])
        aim, total, left = sum(r["size"] for r in part) * (shards // 2) / shards, 0, []
        for r in sorted(part, key=lambda r: r[axis]):
            total += r["size"]
            if total > aim:
                break
            left.append(r)
        kept = {r["doc_id"] for r in left}
        cut(left, first, shards // 2)
        cut([r for r in part if r["doc_id"] not in kept], first + shards // 2, shards - shards // 2)

    cut(rows, 0, 7)
    assert {r.doc_id: r.shard for r in sharding.shard_points(points, names, 7, tolerance=0.0).collect()} == want


def test_many_equal_rows_are_dealt_out(spark):
    docs = spark.range(8000).selectExpr(
        "if(id < 4000, null, id) as doc_id", "if(id < 4000, 'the same text', repeat('x', int(id % 97))) as text",
        "'s' as source", "'en' as lang")
    sizes = defaultdict(list)
    for r in sharding.sharded(docs).collect():
        sizes[r.shard].append((r.size, r.slot))
    sums = [sum(s for s, _ in part) for part in sizes.values()]
    assert set(sizes) == set(range(24)) and max(sums) - min(sums) <= 2 * 105
    assert all(sorted(s for _, s in part) == list(range(len(part))) for part in sizes.values())


# 9

def test_a_hundred_thousand_equal_rows_are_packed(spark):
    docs = spark.range(100_000).selectExpr("cast(null as long) as doc_id",
                                           "if(id % 2 = 0, null, 'five words are in here') as text")
    rows = packing.packed(docs).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k"))
    made = rows.agg(F.sum("n").alias("tokens"), F.sum("k").alias("pieces"), F.max("n").alias("most"),
                    F.count("*").alias("windows")).first()
    assert made.pieces == 100_000 and made.most <= 1024
    assert made.tokens / 1024 / made.windows >= 0.99


def test_packing(spark, docs, texts, nothing):
    from tokenizers import Tokenizer

    path = packing.vocabulary_path()
    own = Tokenizer.from_file(path)
    more = docs.unionByName(spark.createDataFrame(
        rows_of(["a <|endoftext|> b", "  naïve\n\n 12²"], [50, 51]), DOCS))
    known = dict(enumerate(texts)) | {50: "a <|endoftext|> b", 51: "  naïve\n\n 12²"}
    rows = packing.packed(more).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(known)
    for i, part in pieces.items():
        ids = np.array([*own.encode(known[i] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(part, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for part in sequences.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(sequences) <= 1.1 * sum(r.length for r in rows) / 1024 + 2
    assert packing.packed(nothing).count() == 0


def test_classes_of_equal_sizes_spread_as_well_as_differencing():
    rng = np.random.default_rng(6)
    for sizes in (np.full(1000, 7), rng.integers(1, 257, 900), np.append(np.full(500, 256), rng.integers(1, 99, 80))):
        windows = -(-int(sizes.sum()) // 1024)
        found = packing.spread(sizes, windows)
        assert ((0 <= found) & (found < windows)).all()
        sums = np.bincount(found, weights=sizes, minlength=windows)
        plain = np.bincount(packing.differencing(sizes, windows), weights=sizes, minlength=windows)
        assert np.ptp(sums) <= max(np.ptp(plain), sizes.max())


def test_differencing_is_near_equal():
    sizes = np.sort(np.random.default_rng(0).integers(1, 256, 400))[::-1]
    sums = np.bincount(packing.differencing(sizes, 40), weights=sizes, minlength=40)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() <= 8
    assert np.bincount(packing.packed_windows(sizes), weights=sizes).max() <= 1024


# 10

def test_jaccard_against_brute_force(spark, docs, texts, nothing):
    sets = {}
    for i, t in enumerate(texts):
        w = words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    component = {i: i for i in sets}
    for _ in sets:
        component = {i: min(component[j] for j in sets if i == j or sets[i] and 100 * len(sets[i] & sets[j])
                            >= 75 * len(sets[i] | sets[j]) and sets[j]) for i in sets}
    got = jaccard.jaccard_components(docs.unionByName(docs.where("doc_id = 7"))).collect()
    assert len(got) == 20 and component[8] == component[7] == 5
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), component[r.doc_id])
    none = spark.createDataFrame([(None, texts[5])], "doc_id long, text string")
    assert [tuple(r) for r in jaccard.jaccard_components(none).collect()] == [(None, len(sets[5]), None)]
    assert jaccard.jaccard_components(nothing).count() == 0


def test_jaccard_of_shared_and_missing_ids(spark):
    def text(word):
        return " ".join(f"{word}{i}" for i in range(60))

    def near(word):
        return text(word).replace(f"{word}30", "other")

    # Id 6 is linked by both of its texts, id 9 by its first; rows without an id by their own.
    rows = [(4, text("a")), (6, near("a")), (6, text("b")), (8, near("b")), (None, text("b")),
            (None, text("c")), (None, near("c")), (9, text("d")), (9, text("e")), (3, near("d")),
            (5, "one"), (5, "two"), (None, None)]
    got = Counter((r.doc_id, r.component_id) for r in jaccard.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(4, 4): 1, (6, 4): 2, (8, 4): 1, (None, 4): 1, (None, None): 3, (9, 3): 2,
                           (3, 3): 1, (5, 5): 2})


def test_tree_links_what_brute_force_links():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 1 << 48, 60).astype(np.uint64)) for _ in range(12)]
    sets = [np.sort(rng.permutation(base[k % 12])[:rng.integers(40, 61)]) for k in range(120)]
    parent = list(range(120))
    for i, j in jaccard.tree_links(sets, list(range(120))):
        assert jaccard.similar(sets[i], sets[j])
        parent = [parent[i] if p == parent[j] else p for p in parent]
    for i in range(120):
        for j in range(i):
            if jaccard.similar(sets[i], sets[j]):
                assert parent[i] == parent[j]


def test_texts_go_to_a_worker_some_mb_at_a_time(spark):
    rows = spark.range(0, 300, 1, 1).select("id", F.repeat(F.lit("some text "), 10_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    before = spark.conf.get(common.BATCH_SETTING)
    with common.small_batches(spark):
        got = common.stored(rows.mapInArrow(sizes, "n long, size long")).collect()
    assert spark.conf.get(common.BATCH_SETTING) == before
    assert sum(r.n for r in got) == 300
    assert max(r.size for r in got) < 2 * common.BATCH_BYTES


def test_texts_of_the_suffix_stage_go_in_small_batches(spark, monkeypatch):
    seen, stored = [], substrings.stored
    monkeypatch.setattr(substrings, "stored", lambda f: (
        seen.append(spark.conf.get(common.BATCH_SETTING)), stored(f))[1])
    docs = spark.createDataFrame([(1, -1, "a" * 300), (2, -1, "b" * 300)], "doc long, tie long, text string")
    assert substrings.repeated_runs(docs).count() > 0
    assert seen == [str(common.BATCH_BYTES)] * 2


@pytest.mark.parametrize("work, most", [(substrings._sorted, 45), (substrings._windows, 25)])
def test_contexts_take_bounded_memory(work, most):
    rng = np.random.default_rng(5)
    bodies = [rng.integers(97, 123, 168).astype(np.uint8).tobytes() for _ in range(10_000)]
    places = np.zeros(10_000, np.int64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(10_000) // 3), pa.array(np.arange(10_000)), pa.array(places - 1), pa.array(places),
         pa.array(places), pa.array(bodies, pa.binary())], names=["gram", "doc", "tie", "place", "kind", "body"])
    list(work(iter([batch])))  # tables that are kept
    tracemalloc.start()
    for _ in work(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < most * 1e6
