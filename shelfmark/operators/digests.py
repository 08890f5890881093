"""Membership over very many ids: digests of 64 bits, a Bloom filter before the shuffle, and an exact probe behind it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the filter for each member, positions that each sets, and the largest filter, 8 MB.
BITS_A_MEMBER = 12
HASHES = 4
MOST_BITS = 26
#: Bits of a bitmap that Spark's aggregate makes.
_BUCKET = 32768


def digest(id_: Column) -> Column:
    """64 bits of an id as a long: eight bytes a member, whatever its length. Null for null."""
    return F.when(id_.isNotNull(), F.xxhash64(id_.cast("string")))


class Bloom:
    """A filter of members' digests: bits, made by Spark in parts of 4 KB that are merged by number. It is broadcast once and
    no part of any plan, which the driver would keep, print and copy with all its bits; tasks look them up by batches."""

    def __init__(self, spark: SparkSession, bits: bytes, width: int):
        self.bits, self.width = spark.sparkContext.broadcast(bits), width

    @staticmethod
    def _places(d: Column, width: int) -> list[Column]:
        return [F.xxhash64(d, F.lit(k)).bitwiseAND(F.lit((1 << width) - 1)) for k in range(HASHES)]

    @classmethod
    def of(cls, digests: DataFrame, column: str, count: int, most: int = MOST_BITS) -> Bloom | None:
        """None if so many members would leave a filter of the largest size too full to tell anything."""
        width = max(15, (max(1, count) * BITS_A_MEMBER - 1).bit_length())
        if width > most:
            if count * HASHES > 1 << most:
                return None
            width = most
        each = digests.select(F.explode(F.array(*[p + 1 for p in cls._places(F.col(column), width)])).alias("at"))
        parts = each.groupBy(F.expr("bitmap_bucket_number(at)").alias("n")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
        out = bytearray(1 << (width - 3))
        for r in parts.collect():  # 2 ** (width - 15) rows at most, 8 MB in all
            first = (r["n"] - 1) * (_BUCKET // 8)
            out[first : first + _BUCKET // 8] = bytes(r["bits"])
        return cls(digests.sparkSession, bytes(out), width)

    def may_hold(self, d: Column) -> Column:
        sent = self.bits

        @F.pandas_udf("boolean")
        def held(*places: pd.Series) -> pd.Series:
            bits = np.frombuffer(sent.value, np.uint8)
            at = np.stack([p.to_numpy(np.int64) for p in places])
            return pd.Series(((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0))

        return held(*self._places(d, self.width))


def members(rows: DataFrame, ids: DataFrame, on: str, most: int = MOST_BITS, anti: bool = False) -> DataFrame:
    """Rows whose id is among ids (a column of the same name), or with `anti` those whose id is not. A null id is no member.

    Rows that the filter rules out never reach the shuffle; with `anti` they are results there and then. What passes is
    joined on the digest and the id itself, so there is no false member, whatever digests collide."""
    wanted = ids.filter(F.col(on).isNotNull()).select(F.col(on).cast("string").alias("_id")).distinct().withColumn("_d", digest(F.col("_id")))
    held = rows.withColumn("_d", digest(F.col(on)))
    bloom = Bloom.of(wanted, "_d", wanted.count(), most)
    passes = F.coalesce(F.lit(True) if bloom is None else bloom.may_hold(F.col("_d")), F.lit(False)) & F.col("_d").isNotNull()
    mine, theirs = held.filter(passes).alias("r"), wanted.alias("w")
    same = (F.col("r._d") == F.col("w._d")) & (F.col(f"r.{on}").cast("string") == F.col("w._id"))
    probed = mine.join(theirs, same, "left_anti" if anti else "left_semi").drop("_d")
    return probed.unionByName(held.filter(~passes).drop("_d")) if anti else probed
