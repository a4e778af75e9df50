"""Logged conversations: those that a longer one begins with are dropped, the rest is rendered.

Every turn has a rolling hash of the conversation up to it: the exclusive-or of two 64-bit hashes
per turn that also hold its place. A conversation whose last hash is the hash of another's earlier turn is a snapshot of
that one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.session import materialise

#: Turns of a conversation are numbered and hashed in blocks of so many turn numbers, so that a very
#: long conversation is spread over tasks.
BLOCK_TURNS = 1024

PREFIX = ["place", "hash_a", "hash_b"]


def _before(rows: DataFrame, names: list[str], totals: DataFrame) -> DataFrame:
    """Joins a block's columns to its turns; conversation ids may be null."""
    own = totals.select(F.col("id").alias("own_id"), F.col("block").alias("own_block"), *names)
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("block") == F.col("own_block"))
    return rows.join(own, same).drop("own_id", "own_block")


def _turn_hash(seed: int) -> Column:
    given = [F.col("role").isNull(), F.col("text").isNull()]
    return F.xxhash64(F.lit(seed), F.col("place"), *given, F.col("role"), F.col("text"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(id, turn, role, text) with place from 1 and the rolling hashes hash_a and hash_b."""
    turns = turns.distinct().withColumn(
        "block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS).cast("long"), F.lit(-(1 << 62)))
    )
    order = [F.asc_nulls_first(name) for name in ("turn", "role", "text")]
    in_block = Window.partitionBy("id", "block").orderBy(*order)
    up_to_here = in_block.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    sizes = turns.groupBy("id", "block").agg(F.count("*").alias("n")).select(
        "id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("ahead")
    )
    placed = _before(turns, ["ahead"], sizes).withColumn(
        "place", F.col("ahead") + F.row_number().over(in_block)
    ).drop("ahead")
    hashed = placed.withColumn("turn_a", _turn_hash(1)).withColumn("turn_b", _turn_hash(2))
    blocks = hashed.groupBy("id", "block").agg(F.bit_xor("turn_a").alias("all_a"), F.bit_xor("turn_b").alias("all_b"))
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "id", "block", *[F.coalesce(F.bit_xor(f"all_{s}").over(earlier), zero).alias(f"ahead_{s}") for s in "ab"]
    )
    within = hashed.select(
        "*", *[F.bit_xor(f"turn_{s}").over(up_to_here).alias(f"own_{s}") for s in "ab"]
    )
    return _before(within, ["ahead_a", "ahead_b"], blocks).select(
        "id", "turn", "role", "text", "place",
        *[F.col(f"ahead_{s}").bitwiseXOR(F.col(f"own_{s}")).alias(f"hash_{s}") for s in "ab"],
    )


def maximal(placed: DataFrame) -> DataFrame:
    """(id, n_turns, n_copies) of the conversations that no other one begins with.

    Of equal conversations the one with the smallest id stands for all.
    """
    last = placed.groupBy("id").agg(F.max("place").alias("n_turns"))
    ends = placed.withColumnRenamed("id", "turn_id").join(
        last, F.col("turn_id").eqNullSafe(F.col("id"))
    )
    contents = ends.where("place = n_turns").groupBy(*PREFIX).agg(
        F.min("id").alias("id"), F.count("*").alias("n_copies")
    )
    begun = ends.where("place < n_turns").select(*PREFIX).distinct()
    return contents.join(begun, PREFIX, "left_anti").select("id", F.col("place").alias("n_turns"), "n_copies")


def render_turn(role: Column, text: Column) -> Column:
    role = F.coalesce(F.nullif(F.lower(F.trim(role)), F.lit("")), F.lit("user"))
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n<|end|>\n"))


def collapse_and_render(
    conversations: DataFrame, *, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """(id, n_turns, n_copies, rendered) of every maximal conversation.

    Turns go by turn number, then role and text where numbers repeat, nulls first; equal rows of a conversation
    are one turn. A conversation that another one begins with is dropped; of equal ones the smallest
    id stays and ``n_copies`` counts them. Rows without an id are one conversation with id null, which
    stands for others only if none has an id. A null text is rendered empty and a null or blank role as
    ``user``, but both differ from empty ones when turns are compared. No rows give no rows. Other columns are not read.
    """
    turns = conversations.select(
        F.col(id_column).alias("id"), F.col(turn_column).cast("long").alias("turn"),
        F.col(role_column).cast("string").alias("role"), F.col(text_column).cast("string").alias("text"),
    )
    placed = materialise(prefixes(turns), "turns")
    kept = maximal(placed).withColumnRenamed("id", "kept_id")
    segments = F.sort_array(F.collect_list(F.struct("place", render_turn(F.col("role"), F.col("text")).alias("turn"))))
    return placed.join(kept, F.col("id").eqNullSafe(F.col("kept_id"))).groupBy(
        F.col("id").alias(id_column), "n_turns", "n_copies"
    ).agg(F.concat_ws("", segments["turn"]).alias("rendered"))
