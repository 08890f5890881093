"""Uploaded tables: delimiter and header are found, names are made unique, all values are strings."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def sniff(sample: str) -> str:
    """The delimiter that cuts most of the first lines into the same number of fields, more than one."""
    lines = [x for x in sample.splitlines() if x.strip()][:20]
    best = (0, 0, ",")
    for d in (",", "\t", ";", "|"):
        widths = [len(r) for r in csv.reader(lines, delimiter=d)]
        common = max(set(widths), key=widths.count) if widths else 0
        if common > 1:
            best = max(best, (widths.count(common), common, d))
    return best[2]


def header_row(rows: list[list[str]], scan: int = 15) -> int:
    """The first row of mostly distinct, mostly non-numeric names as wide as the table."""
    width = max((len([c for c in r if c.strip()]) for r in rows[:scan]), default=0)
    for i, r in enumerate(rows[:scan]):
        named = [c.strip() for c in r if c.strip()]
        words = [c for c in named if not c.replace(".", "", 1).replace("-", "", 1).isdigit()]
        if named and len(named) >= 0.6 * width and len(words) >= 0.6 * len(named) and len(set(named)) >= 0.6 * len(named):
            return i
    return 0


def unique_names(names: list[str]) -> list[str]:
    out: list[str] = []
    for i, n in enumerate(names):
        base = n.strip() or f"column_{i + 1}"
        name, k = base, 2
        while name in out:
            name, k = f"{base}_{k}", k + 1
        out.append(name)
    return out


def parse_upload(spark: SparkSession, raw: bytes, scan: int = 15) -> DataFrame:
    """A delimited upload (small: it came through a form). Rows above the header are dropped, and so are repeats of it."""
    text = raw.decode("utf-8-sig", "replace")
    rows = [r for r in csv.reader(io.StringIO(text), delimiter=sniff(text[:20_000])) if any(c.strip() for c in r)]
    if not rows:
        return spark.createDataFrame([], StructType([]))
    at = header_row(rows, scan)
    names = unique_names(rows[at])
    body = [(r + [""] * len(names))[: len(names)] for r in rows[at + 1 :] if [c.strip() for c in r] != [c.strip() for c in rows[at]]]
    return spark.createDataFrame(body, StructType([StructField(n, StringType()) for n in names]))
