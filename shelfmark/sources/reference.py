"""Reference series as long tables: JSON payloads in, one row a value out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SERIES = "Results struct<series: array<struct<seriesID: string, data: array<struct<year: string, period: string, periodName: string, value: string>>>>>"
_OBSERVATIONS = "observations array<struct<date: string, value: string>>"


def labour_series(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """series, year, period, value of payloads of the form Results.series[].data[]; values that are no number are null."""
    parsed = payloads.select(F.from_json(column, _SERIES).alias("j")).select(F.explode("j.Results.series").alias("s"))
    rows = parsed.select(F.col("s.seriesID").alias("series"), F.explode("s.data").alias("d"))
    return rows.select("series", F.col("d.year").try_cast("int").alias("year"), F.col("d.period").alias("period"), F.regexp_replace("d.value", ",", "").try_cast("double").alias("value"))


_ACCOUNTS = """BEAAPI struct<Error: struct<APIErrorCode: string, APIErrorDescription: string, ErrorDetail: struct<Description: string>>,
  Results: struct<Error: struct<APIErrorCode: string, APIErrorDescription: string, ErrorDetail: struct<Description: string>>,
                  Data: array<struct<GeoFips: string, GeoName: string, TimePeriod: string, DataValue: string>>>>"""
#: Fixed value: census figures at or below it stand for what is suppressed.
CENSUS_SUPPRESSED = -1e8


def census_rows(payloads: DataFrame, metrics: list[str], geography: list[str], keep: list[str] | None = None, column: str = "payload") -> DataFrame:
    """keep, geo (the geography's codes one after the other), metric, value, suppressed of payloads that are arrays of arrays, the
    first of which names the columns. A figure is suppressed if its flag column <metric>_F holds anything, or if it is no
    number or a large negative one; a payload of another form gives no rows."""
    keep = keep or []
    parsed = payloads.select(*keep, F.from_json(column, "array<array<string>>").alias("j")).filter(F.size("j") > 1)
    rows = parsed.select(*keep, F.get("j", F.lit(0)).alias("h"), F.explode(F.slice("j", 2, F.size("j") - 1)).alias("r")).filter(F.size("h") == F.size("r"))
    cells = rows.select(*keep, F.map_from_arrays("h", "r").alias("m"))
    at = lambda c: F.try_element_at("m", F.lit(c))
    number = lambda c: F.when(at(c).try_cast("double") > CENSUS_SUPPRESSED, at(c).try_cast("double"))
    one = [F.struct(F.lit(c.lower()).alias("metric"), number(c).alias("value"), ((F.trim(F.coalesce(at(f"{c}_F"), F.lit(""))) != "") | number(c).isNull()).alias("suppressed")) for c in metrics]
    return cells.select(*keep, F.concat(*[F.coalesce(at(g), F.lit("")) for g in geography]).alias("geo"), F.explode(F.array(*one)).alias("x")).select(*keep, "geo", "x.*")


def census_labels(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """code, label, concept of payloads of the form variables{code: {label, concept}}."""
    parsed = payloads.select(F.from_json(column, "variables map<string, struct<label: string, concept: string>>")["variables"].alias("v"))
    return parsed.select(F.explode("v").alias("code", "x")).select("code", "x.label", "x.concept")


def census_groups(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """name, description of payloads of the form groups[]."""
    parsed = payloads.select(F.explode(F.from_json(column, "groups array<struct<name: string, description: string>>")["groups"]).alias("g"))
    return parsed.select("g.name", "g.description")


def account_rows(payloads: DataFrame, level: str = "county", keep: list[str] | None = None, column: str = "payload") -> DataFrame:
    """keep, geo, year, value of payloads of the form BEAAPI.Results.Data[]. At the level of states only codes that end in 000
    are, and lose it. Letters stand for values that are suppressed: null, never 0; rows without a year are left out."""
    keep = keep or []
    d = payloads.select(*keep, F.explode(F.from_json(column, _ACCOUNTS)["BEAAPI"]["Results"]["Data"]).alias("d"))
    if level == "state":
        d = d.filter(F.col("d.GeoFips").endswith("000"))
    geo = F.substring("d.GeoFips", 1, 2) if level == "state" else F.col("d.GeoFips")
    year = F.substring("d.TimePeriod", 1, 4).try_cast("int")
    return d.select(*keep, geo.alias("geo"), year.alias("year"), F.regexp_replace("d.DataValue", ",", "").try_cast("double").alias("value")).filter("year is not null")


def account_errors(payloads: DataFrame, keep: list[str] | None = None, column: str = "payload") -> DataFrame:
    """keep, error of payloads that say why they hold nothing; the service says so at one of two levels."""
    j = payloads.select(*(keep or []), F.from_json(column, _ACCOUNTS)["BEAAPI"].alias("j"))
    e = j.select(*(keep or []), F.coalesce("j.Results.Error", "j.Error").alias("e")).filter("e is not null")
    detail = F.trim(F.coalesce("e.ErrorDetail.Description", F.lit("")))
    return e.select(*(keep or []), F.concat(F.coalesce("e.APIErrorDescription", F.lit("?")), F.when(detail != "", F.concat(F.lit(": "), detail)).otherwise(""), F.lit(" (code "), F.coalesce("e.APIErrorCode", F.lit("?")), F.lit(")")).alias("error"))


def dated_observations(payloads: DataFrame, series: str | Column, column: str = "payload") -> DataFrame:
    """series, date, value of payloads of the form observations[]; a full stop stands for a value not published."""
    rows = payloads.select((F.lit(series) if isinstance(series, str) else series).alias("series"), F.explode(F.from_json(column, _OBSERVATIONS)["observations"]).alias("o"))
    return rows.select("series", F.col("o.date").alias("date"), F.when(F.col("o.value") != ".", F.col("o.value")).try_cast("double").alias("value"))


def real_index(series: DataFrame, base_year: int) -> DataFrame:
    """Yearly means rebased to 100 in the base year."""
    yearly = series.groupBy("series", "year").agg(F.avg("value").alias("mean"))
    base = yearly.filter(F.col("year") == base_year).select("series", F.col("mean").alias("base"))
    return yearly.join(base, "series").select("series", "year", F.round(100 * F.col("mean") / F.col("base"), 2).alias("index"))
