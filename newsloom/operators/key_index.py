"""An index of keys by folder: Bloom filters in blocks, kept as a table.

Before the keys of a large table are read to see which ones a batch brings again, the
filters say which folders can hold one of them at all.  A folder's filter is a row of
blocks of 32,768 bits.  A key's hash names its block, and ``PROBES`` bits in the block
are set; a folder whose bits for a key are not all set does not hold the key.  With
``KEYS_PER_BLOCK`` keys to a block (24 bits for each) about one key in 50,000 is taken
for present by mistake, so a batch of a thousand keys reads two folders in a hundred
for nothing.

Filters are made and asked with Spark's own bitmap and hash functions.  A filter is
about three bytes for each key of its folder, combined in each task before it is
shuffled, and a question is an equi-join on the block, so neither meets in one place.
Keys are compared as text; a null key is in no folder.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
KEYS_PER_BLOCK = 1_365
#: Bits set for a key: four from each of three hashes.
SEEDS = (11, 12, 13)
PROBES = 4 * len(SEEDS)

FILTER = "level int, block long, held long, keys long, bits binary"


def _block(key: Column, level: Column) -> Column:
    """The first ``level`` bits of the key's hash."""
    return F.when(level > 0, F.call_function("shiftrightunsigned", F.xxhash64(key), 64 - level)).otherwise(0).cast("long")


def _positions(key: Column) -> Column:
    hashes = [F.xxhash64(F.lit(seed), key) for seed in SEEDS]
    places = [F.shiftrightunsigned(h, 16 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for h in hashes for k in range(4)]
    return F.array(*places)


def filters_of(keys: DataFrame, key: str, folders: DataFrame) -> DataFrame:
    """The filters of all ``folders``, whose columns ``keys`` has too.

    A folder has a row for each block with a key and one that says how many keys
    there are.  A filter whose blocks do not hold as many is not whole.
    """
    folder = folders.columns
    named = keys.where(F.col(key).isNotNull()).select(*folder, F.col(key).cast("string").alias("_key"))
    counts = folders.distinct().join(named.groupBy(*folder).agg(F.count("*").alias("keys")), folder, "left")
    blocks = F.expr(f"greatest(coalesce(keys, 0L) - 1, 0L) DIV {KEYS_PER_BLOCK}")  # one less than are needed
    sized = counts.select(
        *folder, F.coalesce("keys", F.lit(0).cast("long")).alias("keys"), F.when(blocks > 0, F.length(F.bin(blocks))).otherwise(0).alias("level")
    )
    dealt = named.join(sized, folder).select(*folder, "level", "keys", _block(F.col("_key"), F.col("level")).alias("block"), F.explode(_positions(F.col("_key"))).alias("bit"))
    rows = dealt.groupBy(*folder, "level", "block", "keys").agg(
        (F.count("*") / PROBES).cast("long").alias("held"), F.bitmap_construct_agg("bit").alias("bits")
    )
    names = [*folder, "level", "block", "held", "keys", "bits"]
    total = sized.select(
        *folder, "level", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("held"), "keys", F.lit(None).cast("binary").alias("bits")
    )
    return rows.select(*names).union(total.select(*names))


def whole_filters(index: DataFrame, *folder: str) -> DataFrame:
    """The folders whose filter is whole."""
    counted = index.groupBy(*folder).agg(F.sum("held").alias("_held"), F.max("keys").alias("_keys"), F.min("block").alias("_first"))
    return counted.where("_held = _keys AND _first = -1").select(*folder)


def _is_set(place: int) -> Column:
    """Whether the key's bit of this number is set in the block; a byte holds its lowest bit first."""
    return F.expr(
        f"(shiftright(CAST(conv(hex(substring(bits, CAST(_at[{place}] DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), CAST(_at[{place}] % 8 AS INT)) & 1) = 1"
    )


def folders_with(index: DataFrame, keys: DataFrame, key: str, *folder: str) -> DataFrame:
    """The folders that can hold one of the keys; the index has ``folder`` columns beside the filters."""
    text = F.col("_key")
    levels = [r["level"] for r in index.where("block = -1").select("level").distinct().collect()]  # powers of two
    asked = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_key"))
    at = F.array(*[F.struct(F.lit(n).alias("level"), _block(text, F.lit(n)).alias("block")) for n in levels or [0]])
    probes = asked.select(F.inline(at), _positions(text).alias("_at"))
    met = index.where("block >= 0").select(*folder, "level", "block", "bits").join(probes, ["level", "block"])
    return met.where(reduce(and_, map(_is_set, range(PROBES)))).select(*folder).distinct()
