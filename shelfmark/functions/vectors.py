"""Cosine and Hamming as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where either vector is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def hamming_hex(a: Column, b: Column) -> Column:
    """Differing bits of two hashes of up to 64 bits, as hex."""
    return F.bit_count(F.conv(a, 16, -10).cast("long").bitwiseXOR(F.conv(b, 16, -10).cast("long")))


def sign_bits(v: Column) -> Column:
    """The signs of a vector's first 64 components as a long, the first component in the lowest bit; null for null."""
    bit = lambda i: F.when(F.get(v, i) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    return F.when(v.isNotNull(), F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, i: acc.bitwiseOR(bit(i))))
