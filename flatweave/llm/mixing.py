"""Mixing sources to target weights by hierarchical budgeting.

The leaves of the tree are domain / language / source. A total of tokens is dealt from the root
down: each node gets its share by weight among its siblings, but no more than its leaves can
give in the epochs allowed. What a node cannot use goes to its siblings; only what they cannot
use either is missing at the parent, and so goes to the parent's siblings. Each leaf then fills
its budget with whole seeded epochs and a prefix of the next one.

Everything is DataFrame operations. Only the tree, one row per node, is ever narrowed to a few
tasks; the documents of a leaf are ordered bucket by bucket, so a leaf may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm.common import ROWS_PER_BUCKET, column, fresh, running_totals, stored

#: Share of all tokens that the mixture has, and how often a document may be taken at most.
FRACTION = 0.7
MOST_EPOCHS = 2
SEED = 17
#: Weights by domain and by language; what is not named here has weight 1.
DOMAIN_WEIGHTS = {"d0": 2.0, "d1": 1.0, "d2": 1.0}
LANGUAGE_WEIGHTS = {"en": 3.0}

LEVELS = ("domain", "language", "source")
#: Leaves that are broadcast to the documents at most.
BROADCAST_LEAVES = 200_000


def domain_of(source: Column) -> Column:
    """A domain for every source where none is given: three groups by the source's name."""
    return F.concat(F.lit("d"), (F.crc32(source.cast("binary")) % 3).cast("string"))


def token_count(text: Column) -> Column:
    """Words between white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weight_of(name: Column, weights: dict[str, float]) -> Column:
    """The weight by name, 1 where it is not named."""
    found = F.lit(1.0)
    for key, value in sorted(weights.items()):
        found = F.when(name == key, F.lit(float(value))).otherwise(found)
    return found


def shared_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Give each node of a level `budget`: of its parent's `given`, by `weight`, at most `cap`.

    With the siblings ordered by cap / weight, a level exists up to which they are filled; the
    rest share what is left by weight. All siblings of a parent are one bounded group.
    """
    by = Window.partitionBy(*parent).orderBy(F.col("_fill"), *LEVELS)
    ahead = by.rowsBetween(Window.unboundedPreceding, -1)
    behind = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    share = F.col("_left") * F.col("weight") / F.col("_weights")
    return (nodes
            .withColumn("_fill", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight"))
                        .otherwise(F.lit(float("inf"))))
            .withColumn("_left", F.col("given") - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0)))
            .withColumn("_weights", F.sum("weight").over(behind))
            # A node is full if, with all before it full, its share reaches its cap.
            .withColumn("_full", (F.col("_weights") > 0) & (F.col("weight") > 0)
                        & (share >= F.col("cap")))
            # The first node that is not full sets the level for all that follow.
            .withColumn("_rate", F.first(F.when(~F.col("_full") & (F.col("weight") > 0),
                                                F.greatest(F.col("_left"), F.lit(0.0))
                                                / F.col("_weights")), ignorenulls=True)
                        .over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .withColumn("budget", F.when(F.col("weight") <= 0, F.lit(0.0))
                        .when(F.col("_full"), F.col("cap"))
                        .otherwise(F.least("cap", F.col("_rate") * F.col("weight"))))
            .drop("_fill", "_left", "_weights", "_full", "_rate"))


def leaf_budgets(leaves: DataFrame, fraction: float = FRACTION, epochs: int = MOST_EPOCHS,
                 domain_weights: dict[str, float] = DOMAIN_WEIGHTS,
                 language_weights: dict[str, float] = LANGUAGE_WEIGHTS) -> DataFrame:
    """domain, language, source, docs, supply, budget from one row per leaf with its supply."""
    leaves = leaves.withColumn("cap", F.col("supply").cast("double") * epochs)
    everything = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("all"))
    total = everything.select((F.col("all") * F.lit(float(fraction))).alias("given"))
    null = F.lit(None).cast("string")

    domains = (leaves.groupBy("domain").agg(F.sum("cap").alias("cap"))
               .select("domain", null.alias("language"), null.alias("source"), "cap",
                       weight_of(F.col("domain"), domain_weights).alias("weight"))
               .join(F.broadcast(total)))  # one row
    domains = shared_out(domains, []).select("domain", F.col("budget").alias("given"))

    languages = leaves.groupBy("domain", "language").agg(F.sum("cap").alias("cap"))
    languages = shared_out(
        languages.withColumn("source", null)
        .withColumn("weight", weight_of(F.col("language"), language_weights))
        .join(domains, "domain"), ["domain"])
    languages = languages.select("domain", "language", F.col("budget").alias("given"))

    sources = leaves.withColumn("weight", F.lit(1.0)).join(languages, ["domain", "language"])
    return shared_out(sources, ["domain", "language"]).select(
        *LEVELS, "docs", "supply", F.floor(F.col("budget") + 0.5).cast("long").alias("budget"))


def leaf_columns(docs: DataFrame, text: str, lang: str, source: str, domain: Column | None,
                 id_column: str) -> dict[str, Column]:
    """What the mixture needs to know of a row: its leaf, its id, a hash of its text, its tokens."""
    src = F.coalesce(column(docs, source).cast("string"), F.lit(""))
    body = column(docs, text).cast("string")
    return {"domain": domain_of(src) if domain is None else F.coalesce(domain, F.lit("")),
            "language": F.coalesce(column(docs, lang).cast("string"), F.lit("")), "source": src,
            "_id": column(docs, id_column), "_tie": F.xxhash64(body), "_tokens": token_count(body)}


def place_in_epoch(seed: int, whole: Column) -> Column:
    """Where a document comes in the epoch after so many whole ones of its leaf."""
    return F.xxhash64(F.lit(seed), whole, F.col("_id"), F.col("_tie"))


class Mixture:
    """What a mixture takes of some documents.

    `placed` has a row for each distinct document (id and text) of a leaf: levels, _id, _tie,
    _tokens, _n (rows), budget, _whole (epochs that take all of the leaf), _rest (tokens that the
    next epoch takes), _order and _before (the place in that epoch, and the tokens before it).
    """

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                 domain: Column | None = None, seed: int = SEED, fraction: float = FRACTION,
                 epochs: int = MOST_EPOCHS, domain_weights: dict[str, float] = DOMAIN_WEIGHTS,
                 language_weights: dict[str, float] = LANGUAGE_WEIGHTS, id_column: str = "doc_id"):
        self.docs, self.text, self.seed = docs, text, seed
        self.columns = leaf_columns(docs, text, lang, source, domain, id_column)
        keys = list(self.columns)
        # Rows equal in id and text are counted before they are shuffled.
        rows = stored(docs.select(*(c.alias(n) for n, c in self.columns.items()))
                      .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
        rows = rows.withColumn("_all", F.col("_n") * F.col("_tokens"))
        leaves = rows.groupBy(*LEVELS).agg(F.sum("_all").alias("supply"), F.count(F.lit(1)).alias("docs"))
        self.leaves = stored(leaf_budgets(leaves, fraction, epochs, domain_weights, language_weights)
                             .withColumn("_whole", F.when(F.col("supply") > 0, F.floor(
                                 F.col("budget") / F.col("supply"))).otherwise(F.lit(0)).cast("long"))
                             .withColumn("_rest", F.col("budget") - F.col("_whole") * F.col("supply")))
        placed = (rows.join(self.leaves, list(LEVELS))
                  .withColumn("_order", place_in_epoch(seed, F.col("_whole")))
                  # As many buckets as the leaf needs, in the order of the hash.
                  .withColumn("_bucket", F.floor((F.col("_order").cast("double") / 2.0 ** 64 + 0.5)
                                                 * F.ceil(F.col("docs") / ROWS_PER_BUCKET))))
        placed = running_totals(placed, list(LEVELS), "_bucket", ["_order", "_id", "_tie"], "_all",
                                "_before")
        # Of the last epoch a document gives the tokens up to the end of the leaf's budget.
        self.placed = placed.withColumn("_here", F.least(F.greatest(
            F.col("_rest") - F.col("_before"), F.lit(0)), F.col("_all")).cast("long"))

    def rows(self) -> DataFrame:
        """levels, _id, _tokens, budget, epoch_copies and tokens_taken of every row."""
        full = F.when(F.col("_tokens") > 0, F.floor(F.col("_here") / F.col("_tokens"))).when(
            F.col("_before") < F.col("_rest"), F.col("_n")).otherwise(F.lit(0)).cast("long")
        part = F.when(F.col("_tokens") > 0, F.col("_here") % F.col("_tokens")).otherwise(F.lit(0))
        some = self.placed.withColumns({"_full": full, "_part": part.cast("long")})
        whole, tokens = F.col("_whole"), F.col("_tokens")

        def kind(copies: Column, taken: Column, many: Column) -> Column:
            return F.struct(copies.cast("int").alias("epoch_copies"),
                            (whole * tokens + taken).cast("long").alias("tokens_taken"),
                            many.cast("long").alias("many"))

        cut = F.when(F.col("_part") > 0, 1).otherwise(0)
        kinds = F.array(kind(whole + 1, tokens, F.col("_full")), kind(whole + 1, F.col("_part"), cut),
                        kind(whole, F.lit(0), F.col("_n") - F.col("_full") - cut))
        kept = [*LEVELS, "_id", "_tokens", "budget"]
        some = some.select(*kept, "_tie", F.explode(F.filter(kinds, lambda k: k["many"] > 0)).alias("_k"))
        some = some.select(*kept, "_tie", "_k.*", F.explode(F.expr(
            f"sequence(0, _k.many - 1, {ROWS_PER_BUCKET})")).alias("_from"))
        if not self.placed.where(F.col("_n") > ROWS_PER_BUCKET).isEmpty():
            some = some.repartition("_id", "_tie", "_from")  # very many equal rows, in parts
        return some.select(*kept, "epoch_copies", "tokens_taken", F.explode(F.expr(
            f"sequence(1, least(many - _from, {ROWS_PER_BUCKET}))")).alias("_")).drop("_")

    def texts(self) -> DataFrame:
        """The documents taken, all columns, a row for every epoch that takes one.

        Where each leaf's budget ends is one row per leaf, so the documents themselves are not
        shuffled. The text at the end is cut after its last token taken; n_chars is then its own.
        """
        ends = self.placed.where("_tokens > 0 and _before < _rest and _before + _all >= _rest").select(
            *LEVELS, F.struct("_order", "_id", "_tie").alias("_end"), "_tokens", "_here")
        ends = self.leaves.select(*LEVELS, "_whole", "_rest").join(
            ends.select(*LEVELS, "_end", (F.col("_here") / F.col("_tokens")).cast("long").alias("_full"),
                        (F.col("_here") % F.col("_tokens")).alias("_part")), list(LEVELS), "left")
        ends = stored(ends)
        if ends.count() <= BROADCAST_LEAVES:
            ends = F.broadcast(ends)
        row = F.struct(*(column(self.docs, c).alias(c) for c in self.docs.columns))
        docs = self.docs.select(row.alias("_row"), *(
            c.alias(n) for n, c in self.columns.items() if n != "_tokens")).join(ends, list(LEVELS))
        docs = docs.withColumn("_at", F.struct(place_in_epoch(self.seed, F.col("_whole")).alias("_order"),
                                               "_id", "_tie"))
        last = F.col("_rest") > 0
        copies = F.col("_whole") + F.when(last & (F.col("_at") < F.col("_end")), 1).otherwise(0)
        whole = docs.withColumn("_copies", copies).where("_copies > 0").select(
            "_row", F.explode(F.expr("sequence(1, _copies)")).alias("_")).select("_row.*")
        # Rows at the end of a leaf's budget are equal in id and text: so many are taken whole, one in part.
        edge = (docs.where(last & (F.col("_at") == F.col("_end"))).groupBy(*LEVELS)
                .agg(F.first("_row").alias("_row"), F.first("_full").alias("_full"),
                     F.first("_part").alias("_part")))
        again = edge.where("_full > 0").select(
            "_row", F.explode(F.expr("sequence(1, _full)")).alias("_")).select("_row.*")
        tokens = fresh("_part", self.docs.columns)
        part = edge.where("_part > 0").select("_row.*", F.col("_part").cast("int").alias(tokens))
        cut = F.array_join(F.slice(F.regexp_extract_all(
            column(part, self.text).cast("string"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)),
            F.lit(1), F.col(tokens)), "")
        new = {self.text: cut, "n_chars": F.length(cut).cast("long")}
        part = part.select(*(new.get(c, column(part, c)).alias(c) for c in self.docs.columns))
        return whole.unionByName(again).unionByName(part)


def taken_texts(docs: DataFrame, **options) -> DataFrame:
    """The texts that a mixture takes; see `Mixture` for the options and `mixed` for odd rows."""
    return Mixture(docs, **options).texts()


def mixed(docs: DataFrame) -> DataFrame:
    """op5: what the mixture takes of every document.

    doc_id, domain, language, source, tokens, budget of the leaf, epoch_copies (0: left out) and
    tokens_taken, whose sum over a leaf is its budget. Within an epoch a leaf's documents come in
    the order of a hash of seed, epoch, id and text; the one where the budget ends is taken up to
    that token. Documents without tokens come free with every epoch that reaches them. Null
    source, lang and domain count as empty; null ids are told apart by their texts; of rows equal
    in both, as many are taken as the budget allows. An empty table gives no rows.
    """
    return Mixture(docs).rows().select(F.col("_id").alias("doc_id"), *LEVELS, F.col("_tokens").alias("tokens"),
                                       "budget", "epoch_copies", "tokens_taken")
