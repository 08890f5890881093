"""GS1 product codes as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import digits


def check_digit(body: Column) -> Column:
    """The check digit of a body without one: weights 3 and 1 alternate from the right."""
    figures = F.transform(F.split(F.reverse(body), ""), lambda ch: ch.try_cast("int"))
    weighted = F.transform(figures, lambda d, i: F.coalesce(d, F.lit(0)) * F.when(i % 2 == 0, 3).otherwise(1))
    total = F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x)
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))


def valid(code: Column) -> Column:
    """Whether a code of 8, 12, 13 or 14 digits carries its own check digit."""
    d = digits(code)
    last = F.substring(d, -1, 1).try_cast("int")
    body = F.substr(d, F.lit(1), F.greatest(F.length(d) - 1, F.lit(0)))
    return F.coalesce(F.length(d).isin(8, 12, 13, 14) & (check_digit(body) == last), F.lit(False))


def with_check_digit(body: Column) -> Column:
    d = digits(body)
    return F.concat(d, check_digit(d).cast("string"))


def placeholder(code: Column) -> Column:
    """One digit throughout, or a run that counts up."""
    d = digits(code)
    return d.rlike(r"^(\d)\1*$") | d.rlike("^0*123456789[0-9]*$")
