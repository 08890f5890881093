"""Identity keys: md5 over components with nulls as empty, byte for byte the same in every producer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts: Column) -> Column:
    """concat_ws would skip nulls and let different keys meet."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    joined = [x for p in text for x in (F.lit("|"), p)][1:]
    return F.md5(F.concat(*joined))


def bucket(parts: list[Column], digits: int = 2) -> Column:
    """The first hex digits of the key: the partition of a bucketed table."""
    return F.substring(md5_key(*parts), 1, digits)


def bigint_code(c: Column) -> Column:
    """A code as a number, so that leading zeros do not part equal codes."""
    return F.regexp_replace(c.cast("string"), "[^0-9]", "").try_cast("long")
