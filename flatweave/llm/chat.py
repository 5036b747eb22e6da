"""Chat formatting: snapshots of a growing conversation collapse into the longest one.

Systems that log a conversation after every reply store each prefix again. A hash of the first
i turns, for every i, tells whether one conversation is a prefix of another; anti-joins keep
those that are a prefix of none, and these are rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from flatweave.llm.common import running_totals, stored

#: Turns of a conversation that one task orders at a time.
TURNS_PER_BUCKET = 4096


def turn_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and position (from 0), two hashes of the turns so far.

    A hash so far is the XOR of one hash per turn that also covers the turn's position; XOR
    needs no order and cannot overflow, so a conversation of any length is added up in parts.
    """
    rows = turns.select("conv_id", *(F.col(c).cast(kind).alias(c) for c, kind in (
        ("turn", "long"), ("role", "string"), ("text", "string")))).where("conv_id is not null")
    rows = (rows.withColumn("_bucket", F.coalesce(F.floor(F.col("turn") / TURNS_PER_BUCKET),
                                                  F.lit(-1 << 62)))
            .withColumn("_one", F.lit(1)))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = running_totals(rows, ["conv_id"], "_bucket", order, "_one", "position").drop("_one")
    for i, seed in enumerate(("a", "b")):
        # A hash skips nulls, so what is null is hashed too.
        rows = rows.withColumn(f"_h{i}", F.xxhash64(
            F.lit(seed), F.col("position").cast("long"), F.isnull("role"), "role", F.isnull("text"), "text"))
    ahead = Window.partitionBy("conv_id").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "_bucket").agg(F.bit_xor("_h0").alias("_s0"),
                                                  F.bit_xor("_h1").alias("_s1"))
    for i in (0, 1):
        sums = sums.withColumn(f"_b{i}", F.coalesce(F.bit_xor(f"_s{i}").over(ahead), F.lit(0)))
    inside = Window.partitionBy("conv_id", "_bucket").orderBy("position").rowsBetween(
        Window.unboundedPreceding, 0)
    for i in (0, 1):
        rows = rows.withColumn(f"_i{i}", F.bit_xor(f"_h{i}").over(inside))
    rows = rows.join(sums.drop("_s0", "_s1"), ["conv_id", "_bucket"])
    return rows.select("conv_id", "turn", "role", "text", F.col("position").cast("long"),
                       *(F.expr(f"_b{i} ^ _i{i}").alias(f"prefix{i}") for i in (0, 1)))


def maximal(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_snapshots of the conversations that no longer one begins with.

    Of conversations with the same turns the smallest conv_id stays. n_snapshots counts the
    equal ones, itself included.
    """
    ends = rows.groupBy("conv_id").agg(
        F.max(F.struct("position", "prefix0", "prefix1")).alias("end"))
    ends = ends.select("conv_id", "end.position", "end.prefix0", "end.prefix1")
    one = ends.groupBy("position", "prefix0", "prefix1").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_snapshots"))
    # What a turn follows is a proper prefix. Equal ones combine before the shuffle.
    proper = (rows.join(ends.select("conv_id", F.col("position").alias("_last")), "conv_id")
              .where("position < _last").select("position", "prefix0", "prefix1").distinct())
    return (one.join(proper, ["position", "prefix0", "prefix1"], "left_anti")
            .select("conv_id", (F.col("position") + 1).alias("n_turns"), "n_snapshots"))


def rendered(turns: DataFrame, begin: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """One row per turn of the conversations kept: conv_id, position, n_turns, n_snapshots, chat.

    The chat text of a conversation is its rows' `chat` in order of position; rows stay apart
    so that a conversation of any length never meets in one task. Turns are ordered by turn,
    then role and text, null first; a null role or text is rendered as empty, but is no
    equal of an empty one when conversations are compared. Turns without conv_id are left out.
    Repeated rows are turns of their own. Other columns are ignored; an empty table gives none.
    """
    # Stored once, so that the joins of prefixes read their columns without the texts.
    rows = stored(turn_rows(turns))
    chat = F.concat(F.lit(begin), F.coalesce("role", F.lit("")), F.lit("\n"),
                    F.coalesce("text", F.lit("")), F.lit(f"{end}\n"))
    return (rows.join(maximal(rows), "conv_id")
            .select("conv_id", "position", "n_turns", "n_snapshots", chat.alias("chat")))


#: The same rows in DuckDB, by comparing whole prefixes.
RENDERED_SQL = """
with t as (
  select conv_id, turn, role, text,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first,
                            text nulls first) - 1 as position
  from conversations where conv_id is not null),
k as (select *, string_agg(md5(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n')), '')
               over (partition by conv_id order by position) as prefix from t),
e as (select conv_id, max(position) as last, max_by(prefix, position) as whole from k group by 1),
one as (select whole, min(conv_id) as conv_id, max(last) + 1 as n_turns, count(*) as n_snapshots
        from e group by whole),
proper as (select distinct prefix from k join e using (conv_id) where position < last),
kept as (select * from one where whole not in (select prefix from proper))
select conv_id, position, n_turns, n_snapshots,
       '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) as chat
from t join kept using (conv_id)
"""
