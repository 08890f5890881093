"""Places laid out along a space-filling curve, so that a box of the map is a few ranges of one column and a few row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of each coordinate in a place's number: cells of about six hundred metres.
BITS = 16
#: Ranges into which a box is cut at most; beyond, neighbours are joined and read too much rather than too little.
RANGES = 64
#: Bytes of a row group.
ROW_GROUP = 1 << 20
#: Shifts and masks that put a zero bit before each of 16.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread(c: Column) -> Column:
    for shift, mask in _SPREAD:
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def _scaled(c: Column, low: float, high: float) -> Column:
    top = (1 << BITS) - 1
    return F.least(F.greatest(F.floor((c - low) / (high - low) * (top + 1)), F.lit(0)), F.lit(top)).cast("long")


def curve(lat: Column, lng: Column) -> Column:
    """A place's number: the bits of its longitude and latitude, by turns. Null without a place."""
    return _spread(_scaled(lng, -180.0, 180.0)).bitwiseOR(F.shiftleft(_spread(_scaled(lat, -90.0, 90.0)), 1))


def box_ranges(south: float, west: float, north: float, east: float, most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of numbers, both ends within, that hold every place of a box. Quarters of the map that lie in the box whole are
    ranges; those that it cuts are quartered again, until there are as many as may be."""
    top = 1 << BITS
    cell = lambda v, low, span: min(max(int((v - low) / span * top), 0), top - 1)
    x0, x1 = cell(west, -180.0, 360.0), cell(east, -180.0, 360.0)
    y0, y1 = cell(south, -90.0, 180.0), cell(north, -90.0, 180.0)
    if south > north or west > east:
        return []
    whole: list[tuple[int, int]] = []
    cut = [(0, 0, 0, BITS)]  # number of the first cell, x, y, bits of the side
    while cut:
        finer = []
        for z, x, y, bits in cut:
            side = 1 << bits
            if x > x1 or y > y1 or x + side <= x0 or y + side <= y0:
                continue
            if x >= x0 and y >= y0 and x + side <= x1 + 1 and y + side <= y1 + 1 or not bits:
                whole.append((z, z + (1 << 2 * bits) - 1))
                continue
            half = side >> 1
            finer += [(z + (q << 2 * (bits - 1)), x + half * (q & 1), y + half * (q >> 1), bits - 1) for q in range(4)]
        if len(whole) + len(finer) > most:
            whole += [(z, z + (1 << 2 * bits) - 1) for z, x, y, bits in finer if not (x > x1 or y > y1 or x + (1 << bits) <= x0 or y + (1 << bits) <= y0)]
            break
        cut = finer
    out: list[tuple[int, int]] = []
    for a, b in sorted(whole):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    while len(out) > most:  # join the two that lie nearest
        k = min(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1])
        out[k - 1 : k + 1] = [(out[k - 1][0], out[k][1])]
    return out


def write_places(df: DataFrame, path: str, lat: str = "lat", lng: str = "lng", files: int | None = None, row_group: int = ROW_GROUP) -> None:
    """Files that are ranges of the curve, sorted by it, in small row groups; rows without a place come first. Adds z."""
    placed = df.withColumn("z", curve(F.col(lat), F.col(lng)))
    dealt = placed.repartitionByRange("z") if files is None else placed.repartitionByRange(files, "z")
    dealt.sortWithinPartitions("z").write.option("parquet.block.size", row_group).parquet(path)


def in_box(table: DataFrame, box: tuple[float, float, float, float], lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows within (south, west, north, east), edges included. The ranges of z reach the scan, which skips row groups by
    them; the box itself decides."""
    south, west, north, east = box
    near = F.lit(False)
    for a, b in box_ranges(*box):
        near = near | F.col("z").between(a, b)
    return table.filter(near & F.col(lat).between(south, north) & F.col(lng).between(west, east))


def read_places(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.drop("z") if box is None else in_box(table, box).drop("z")
