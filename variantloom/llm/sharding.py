"""Shards by jump consistent hashing (Lamping and Veach, 2014), in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.numbering import numbered

# Fixed values of the published generator: state * MULTIPLIER + 1 modulo 2**64.
MULTIPLIER = 2862933555777941757
LOW = (1 << 32) - 1
# Jumps made for every row; the rest, needed by hardly any row, follows only where it is.
USUAL_JUMPS = 48


def times32(a: Column, b: int) -> Column:
    """a * b modulo 2**32 for a, b below 2**32, without passing 2**63."""
    high = F.shiftright(a, 16) * F.lit(b)
    return (a.bitwiseAND(F.lit(0xFFFF)) * F.lit(b) + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(LOW))


def next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next state, as its upper and lower 32 bits."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & LOW
    part0 = low.bitwiseAND(F.lit(0xFFFF)) * F.lit(m_low)
    part1 = F.shiftright(low, 16) * F.lit(m_low)
    total = part0 + F.shiftleft(part1.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftright(total, 32) + F.shiftright(part1, 16)
    new_high = (carry + times32(high, m_low) + times32(low, m_high)).bitwiseAND(F.lit(LOW))
    return new_high, total.bitwiseAND(F.lit(LOW))


def jump_hash(key: Column, shards: int) -> Column:
    """The shard 0 ... shards - 1 of a long key; NULL goes where key 0 goes.

    With one more shard a key either keeps its shard or moves to the new one.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))

    def jump(state: Column, _: Column) -> Column:
        high, low = next_state(state["high"], state["low"])
        # b + 1 over (state >> 33) + 1, times 2**31, as in the paper.
        ahead = (state["j"] + F.lit(1)) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double"))
        open_ = state["j"] < F.lit(shards)
        return F.struct(
            F.when(open_, state["j"]).otherwise(state["b"]).alias("b"),
            F.when(open_, F.floor(ahead)).otherwise(state["j"]).cast("bigint").alias("j"),
            F.when(open_, high).otherwise(state["high"]).alias("high"),
            F.when(open_, low).otherwise(state["low"]).alias("low"),
        )

    def jumps(start: Column, n: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, jump)

    first = F.struct(
        F.lit(-1).cast("bigint").alias("b"),
        F.lit(0).cast("bigint").alias("j"),
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(LOW)).alias("low"),
    )
    # No key makes more than `shards` jumps.
    usual = jumps(first, min(shards, USUAL_JUMPS))
    if shards > USUAL_JUMPS:
        usual = F.transform(
            F.array(usual), lambda s: F.when(s["j"] < shards, jumps(s, shards - USUAL_JUMPS)).otherwise(s)
        )[0]
    return usual["b"].cast("int")


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """`docs` with the shard of each row's key: a projection, nothing is shuffled.

    Only the key and the number of shards decide: equal keys meet, and rows with a NULL key go to the
    shard of key 0. Other columns stay; an input column called `name` is replaced. An empty table
    gives an empty table.
    """
    return docs.withColumn(name, jump_hash(F.col(key), shards))


def shard_slots(assigned: DataFrame, identity: list[str], shard: str = "shard", name: str = "slot") -> DataFrame:
    """Place of each row in its shard, from 0 without gaps; needs narrow rows that are already written.

    Returns the shard, `identity` and the slot. A shard may be of any size: see `numbered`.
    """
    return numbered(assigned, [shard], identity, name)
