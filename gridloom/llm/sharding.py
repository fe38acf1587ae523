"""Jump consistent hashing of stable keys to shards, in SQL functions alone.

The generator is the published 64-bit linear congruential one. Its state is
held as three limbs (22, 22 and 20 bits) because products of 64 bits overflow
a Spark long; all partial sums stay below 2^47.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.index import ordinals

MULTIPLIER = 2862933555777941757  # fixed value of the published generator
LIMB = 22
MASK = (1 << LIMB) - 1
TOP_MASK = (1 << 20) - 1


def _limb(key: Column, i: int) -> Column:
    return F.shiftrightunsigned(key, LIMB * i).bitwiseAND(F.lit(TOP_MASK if i == 2 else MASK))


def jump_shards(key: Column, shards: int) -> Column:
    """``struct(shard, grown)``: the shard of a long key among ``shards`` and
    among ``shards + 1``.

    The two differ only where ``grown`` is the added shard. A null key counts
    as 0. The walk takes at most ``shards + 1`` steps, as its position only
    rises.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    c0, c1, c2 = (F.lit((MULTIPLIER >> (LIMB * i)) & (TOP_MASK if i == 2 else MASK)) for i in range(3))
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    start = F.struct(
        _limb(key, 0).alias("k0"), _limb(key, 1).alias("k1"), _limb(key, 2).alias("k2"),
        zero.alias("next"), zero.alias("shard"), zero.alias("grown"),
    )

    def step(s: Column, _: Column) -> Column:
        r0 = s["k0"] * c0 + F.lit(1)
        r1 = s["k1"] * c0 + s["k0"] * c1 + F.shiftright(r0, LIMB)
        r2 = s["k2"] * c0 + s["k1"] * c1 + s["k0"] * c2 + F.shiftright(r1, LIMB)
        k0, k1 = r0.bitwiseAND(F.lit(MASK)), r1.bitwiseAND(F.lit(MASK))
        k2 = r2.bitwiseAND(F.lit(TOP_MASK))
        high = F.shiftleft(k2, 11) + F.shiftright(k1, 11)
        jump = F.floor((s["next"] + 1) * (F.lit(float(1 << 31)) / (high + 1).cast("double")))
        going = s["next"] < F.lit(shards + 1)
        return F.struct(
            k0.alias("k0"), k1.alias("k1"), k2.alias("k2"),
            F.when(going, jump.cast("long")).otherwise(s["next"]).alias("next"),
            F.when(s["next"] < F.lit(shards), s["next"]).otherwise(s["shard"]).alias("shard"),
            F.when(going, s["next"]).otherwise(s["grown"]).alias("grown"),
        )

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, step)
    return F.struct(walk["shard"].cast("int").alias("shard"), walk["grown"].cast("int").alias("grown"))


def shard_table(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shards: int = 24
) -> DataFrame:
    """Place every row of ``docs`` and number the rows of each shard.

    Result: ``key``, ``size`` (UTF-8 bytes of the text plus 8; 8 for null),
    ``text_crc32`` (0 for null or empty), ``law`` (``"key"``), ``shard``,
    ``slot`` (0, 1, ... inside the shard in key order), ``grown_shard`` (the
    shard if one more is appended).

    The key and the shard count alone decide, so rows of one key share a shard
    and a repeated run moves nothing. Null keys go where key 0 goes and come
    first in its shard. Rows that repeat everything get different slots. Other
    columns of ``docs`` are ignored, an empty table gives none.

    Slots come from a range-partitioned sort over ``(shard, key, checksum, row)``:
    a shard spreads over many tasks, and so do the rows of one key. Only
    partition and shard sizes are summed up in one place.
    """
    placed = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)).alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        jump_shards(F.col(key), shards).alias("__to"),
    ).select(
        key, "size", "text_crc32",
        F.col("__to.shard").alias("shard"), F.col("__to.grown").alias("grown_shard"),
        F.monotonically_increasing_id().alias("__row"),
    )
    numbered = ordinals(placed, ["shard", key, "text_crc32", "__row"], "__ordinal")
    starts = (
        numbered.groupBy("shard").agg(F.min("__ordinal").alias("__start"))
    )  # one row a shard
    return numbered.join(F.broadcast(starts), "shard").select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("__ordinal") - F.col("__start")).alias("slot"), "grown_shard",
    )
