"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Every run of ten words of a benchmark item is a window, held by its 64-bit hash. The documents'
words are scanned in place: one row per word position, the hash of the run that starts there, a
probe of the set, and for a hit the comparison of the words themselves. All of it is one pass of
DataFrame expressions over the texts without an exchange; only hits, and one row per document,
are shuffled.

The set is broadcast while it has no more windows than a stated bound. A larger benchmark is
joined by Spark's own choice of join, which gives the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm.common import column, fresh, stored

WORDS = 10
#: Windows that are broadcast at most; with ten words each they take some 200 bytes.
BROADCAST_WINDOWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII that is neither digit nor letter ends a word.
BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null has none."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER + BREAKS,
                        LOWER + " " * len(BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def window_hash(words: Column, at: Column, length: int) -> Column:
    """64 bits that stand for so many words from a place on."""
    return F.xxhash64(F.lit(length), *(F.get(words, at + i) for i in range(length)))


def windows_of(items: DataFrame, length: int = WORDS) -> DataFrame:
    """(item_id, length, gram): every window of every item, as an array of words.

    An item of fewer words than a window, but not none, is one window.
    """
    words = items.select(F.col("item_id"), words_of(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 0).withColumn(
        "length", F.least(F.size("words"), F.lit(length)))
    return (words.select("item_id", "words", "length", F.explode(
                F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at"))
            .select("item_id", "length", F.slice("words", F.col("at"), F.col("length")).alias("gram")))


def scan(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits of the documents (doc_id, key0, key1, words) among grams (gram_id, length, gram).

    (doc_id, key0, key1, n_words, mark, at, length, gram_id): mark is true in one row of every
    document, which has no gram_id unless it is a hit as well; other rows are hits.
    """
    kept = ["doc_id", "key0", "key1", "n_words", "mark", "at", "length", "gram_id"]
    rows = docs.select("doc_id", "key0", "key1", "words", F.size("words").alias("n_words"),
                       F.posexplode_outer("words").alias("at", "_word")).drop("_word")
    rows = rows.withColumn("at", F.coalesce("at", F.lit(0)))
    if not lengths:
        return rows.where("at = 0").withColumns({
            "mark": F.lit(True), "length": F.lit(0), "gram_id": F.lit(None).cast("long")}).select(kept)
    hashed = [F.struct(F.lit(n).alias("length"), window_hash(F.col("words"), F.col("at"), n).alias("hash"))
              for n in lengths]
    if len(lengths) == 1:
        rows = rows.select("*", F.lit(lengths[0]).alias("length"), hashed[0]["hash"].alias("hash"))
    else:
        rows = rows.select("*", F.explode(F.array(*hashed)).alias("_w")).select("*", "_w.*").drop("_w")
    rows = rows.withColumn("mark", F.expr(f"at = 0 and length = {lengths[0]}"))
    rows = rows.where("mark or at + length <= n_words")
    pairs = grams.select(
        "gram_id", F.col("gram").alias("_gram"),
        reduce(lambda other, n: F.when(F.col("length") == n, window_hash(F.col("gram"), F.lit(0), n))
               .otherwise(other), lengths, F.lit(None).cast("long")).alias("_hash"))
    if grams.count() <= BROADCAST_WINDOWS:
        pairs = F.broadcast(pairs)
    same = ((F.col("hash") == F.col("_hash"))
            & (F.slice("words", F.col("at") + 1, F.col("length")) == F.col("_gram")))
    return rows.join(pairs, same, "left").where("mark or gram_id is not null").select(kept)


def spans_of(hits: DataFrame) -> DataFrame:
    """(key0, key1, low, high): maximal runs of hit words, from low up to before high."""
    order = Window.partitionBy("key0", "key1").orderBy("at", "high")
    ahead = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (hits.select("key0", "key1", "at", (F.col("at") + F.col("length")).alias("high")).distinct()
            .withColumn("_new", F.coalesce((F.col("at") > ahead).cast("int"), F.lit(1)))
            .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    return (runs.groupBy("key0", "key1", "_run").agg(F.min("at").alias("low"), F.max("high").alias("high"))
            .drop("_run"))


def document_keys(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that stand for a distinct pair of id and text, either of which may be null."""
    return [F.xxhash64(F.lit(seed), doc_id.isNull(), doc_id, text.isNull(), text).alias(f"key{i}")
            for i, seed in enumerate(("a", "b"))]


class Findings:
    """What some documents share with a benchmark. The texts are scanned once and the hits stored.

    `marks` (doc_id, key0, key1, n_words) has a row per document; `hits` (key0, key1, at, length,
    gram_id), `items` (gram_id, item_id) and `spans` (key0, key1, low, high) are distinct. Hits and
    spans are places in words.
    """

    KEYS = ("key0", "key1")

    def __init__(self, docs: DataFrame, benchmark: DataFrame, length: int = WORDS):
        pairs = stored(windows_of(benchmark, length).distinct())
        grams = stored(pairs.select("length", "gram").distinct()
                       .withColumn("gram_id", F.monotonically_increasing_id()))
        self.items = pairs.join(grams, ["length", "gram"]).select("gram_id", "item_id")
        lengths = sorted(r[0] for r in grams.select("length").distinct().collect())  # at most `length`
        doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
        rows = docs.select(doc_id.alias("doc_id"), *document_keys(doc_id, text),
                           words_of(text).alias("words"))
        rows = stored(scan(rows, grams, lengths))
        self.marks = rows.where("mark").select("doc_id", *self.KEYS, "n_words")
        self.hits = (rows.where("gram_id is not null")
                     .select(*self.KEYS, "at", "length", "gram_id").distinct())
        self.spans = spans_of(self.hits)

    def per_key(self) -> DataFrame:
        """key0, key1, n_hit, n_items, items_sha256 of the documents that have a hit."""
        words = self.spans.groupBy(*self.KEYS).agg(F.sum(F.col("high") - F.col("low")).alias("n_hit"))
        names = (self.hits.select(*self.KEYS, "gram_id").distinct().join(self.items, "gram_id")
                 .select(*self.KEYS, F.col("item_id").cast("string").alias("item")).distinct()
                 .groupBy(*self.KEYS).agg(F.sort_array(F.collect_list("item")).alias("names")))
        return words.join(names, list(self.KEYS)).select(
            *self.KEYS, "n_hit", F.size("names").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "names"), 256).alias("items_sha256"))


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = WORDS) -> DataFrame:
    """Contract of op13: doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    Null and empty texts have no words and no hits. Items that are null, empty or without a word
    have no window; one item_id of several texts has the windows of all; an item without id hits,
    but is neither counted nor named. Texts without doc_id have results of their own, repeated
    rows repeated results. Other columns are ignored. An empty benchmark hits nothing; no
    documents give no rows.
    """
    found = Findings(docs, benchmark, length)
    return found.marks.join(found.per_key(), list(Findings.KEYS), "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                   length: int = WORDS) -> DataFrame:
    """The documents, all columns, without what they share with the benchmark.

    remove="documents" drops every row with a hit; remove="spans" cuts the hit words out of the
    texts, with what stands between two words of one run, and keeps the rest of the text as it
    is. Edge cases are as in `contamination`; clashing column names are kept.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    found = Findings(docs, benchmark, length)
    names = [fresh(n, docs.columns) for n in (*Findings.KEYS, "_spans")]
    keys = document_keys(column(docs, "doc_id").cast("long"), column(docs, "text").cast("string"))
    keyed = docs.select("*", *(k.alias(n) for k, n in zip(keys, names)))
    spans = found.spans.groupBy(*Findings.KEYS).agg(F.collect_list(F.struct("low", "high")).alias("_s"))
    spans = spans.toDF(*names)
    if remove == "documents":
        return keyed.join(spans, names[:2], "left_anti").select(*(column(docs, c) for c in docs.columns))
    joined = keyed.join(spans, names[:2], "left")
    text, runs = column(joined, "text").cast("string"), column(joined, names[2])
    cut = F.when(runs.isNull(), text).otherwise(without_words(text, runs))
    return joined.select(*((cut if c == "text" else column(joined, c)).alias(c) for c in docs.columns))


def without_words(text: Column, runs: Column) -> Column:
    """A text without the words of some runs (low, high) and what stands between them."""
    word, gap = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+"
    pieces = F.regexp_extract_all(text, F.lit(f"{word}|{gap}"), F.lit(0))
    lead = F.when(text.rlike(f"^{gap}"), 1).otherwise(0)  # pieces before the first word

    def stays(piece: Column, place: Column) -> Column:
        place = place - lead
        number = F.floor(place / 2)  # of the word, or of the word before the gap
        beyond = number + F.when(place % 2 == 0, 1).otherwise(2)
        return ~F.exists(runs, lambda run: (run["low"] <= number) & (beyond <= run["high"]))

    return F.array_join(F.filter(pieces, stays), "")


#: The same rows in DuckDB, by comparing every run of words.
CONTAMINATION_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
b as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
g as (
  select distinct item_id, l, array_to_string(words[pos:pos + l - 1], ' ') as gram
  from (select *, unnest(generate_series(1, len(words) - l + 1)) as pos
        from (select *, least(len(words), 10) as l from b where len(words) > 0))),
w as (
  select r, pos, l, array_to_string(words[pos:pos + l - 1], ' ') as gram
  from (select r, words, l, unnest(generate_series(1, len(words) - l + 1)) as pos
        from d, (select distinct l from g) where len(words) >= l)),
h as (select r, pos, l, item_id from w join g using (l, gram)),
c as (select r, count(distinct place) as n_hit
      from (select r, unnest(generate_series(pos, pos + l - 1)) as place from (select distinct r, pos, l from h))
      group by r),
i as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct r, item_id::varchar as item from h where item_id is not null) group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (r) left join i using (r)
"""
