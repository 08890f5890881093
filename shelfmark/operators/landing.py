"""Rows as they land: typed observations, cleaned fields, samples, flags, lists, rules on values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import gs1, products
from ..functions.text import present

#: Plausible alcohol by volume of each class, from and to.
ABV_BANDS = {"beer": (0.5, 20.0), "wine": (5.0, 24.0), "whiskey": (30.0, 75.0), "spirits": (15.0, 80.0), "non-alcoholic": (0.0, 0.5)}


def typed_observations(rows: DataFrame, source: str, day: str | None = None) -> DataFrame:
    """Raw strings as observations: numbers are numbers or null, a promotion that is words goes to promo_text."""
    number, words = products.split_promo(F.col("promo"))
    yes = F.lower(F.col("in_stock").cast("string"))
    stock = F.when(yes.isin("true", "1", "t", "yes"), True).when(yes.isin("false", "0", "f", "no"), False)
    when = F.lit(day) if day else F.col("date")
    return rows.select(
        when.alias("date"), F.lit(source).alias("source"), F.col("store_id").cast("string").alias("store_id"), F.col("product_id").cast("string").alias("product_id"),
        F.regexp_replace("price", r"[$,]", "").try_cast("double").alias("price"), F.col("qty").try_cast("double").alias("qty"), number.alias("promo"), words.alias("promo_text"), stock.alias("in_stock"),
    )


def stride_sample(rows: DataFrame, key: str, stride: int) -> DataFrame:
    """One key in `stride`, always the same ones: a sampling operator. The choice is by md5, so any engine makes it."""
    return rows.filter(F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(stride)) == 0)


def fixed_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """n rows, always the same ones: the least by md5 of the key."""
    return rows.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def field_query(rows: DataFrame, op: str, field: str, k: int = 10) -> DataFrame:
    """distinct, count or top of a field."""
    if op == "distinct":
        return rows.select(F.col(field).cast("string").alias("value")).distinct()
    if op == "count":
        return rows.agg(F.count(field).alias("n"), F.count_distinct(field).alias("distinct"))
    if op == "top":
        return rows.filter(present(field)).groupBy(F.col(field).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)
    raise ValueError(f"no such operation: {op}")


def shelf_positions(rows: DataFrame, key: str, codes: str) -> DataFrame:
    """Pipe-parted shelf codes such as `A03-2-15` as aisle, shelf and place, in order."""
    e = rows.select(key, F.posexplode(F.split(codes, r"\|")).alias("pos", "code"))
    part = lambda i, kind: F.regexp_extract("code", r"^([A-Z]+[0-9]*)-([0-9]+)-([0-9]+)$", i).try_cast(kind)
    return e.filter("code <> ''").select(key, "pos", "code", F.nullif(part(1, "string"), F.lit("")).alias("aisle"), part(2, "int").alias("shelf"), part(3, "int").alias("place"))


def merge_lists(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """Union of comma-parted lists by key, in order."""
    e = rows.select(*by, F.explode(F.split(column, ",")).alias("x")).filter(F.trim("x") != "")
    return e.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_set(F.trim("x"))), ",").alias(column))


def carried_flags(outlets: DataFrame, goods: DataFrame, key: str, text: str, flags: dict[str, str]) -> DataFrame:
    """Flags of outlets by what they carry: true if any good's name has the pattern."""
    g = goods.groupBy(key).agg(*[F.bool_or(F.lower(text).rlike(p)).alias(n) for n, p in flags.items()])
    return outlets.join(g, key, "left").withColumns({n: F.coalesce(n, F.lit(False)) for n in flags})


def repeated_images(rows: DataFrame, image: str, product: str, least: int = 8) -> DataFrame:
    """Images that stand for many products are no pictures of any."""
    return rows.filter(present(image)).groupBy(image).agg(F.count_distinct(product).alias("products")).filter(F.col("products") >= least)


def value_rules(rows: DataFrame, code: str, abv: str, price: str, list_price: str, kind: str) -> DataFrame:
    """Violations of each row as a list: check digit, range, price relation, class band."""
    low = high = F.lit(None).cast("double")
    for name, (a, b) in ABV_BANDS.items():
        low, high = F.when(F.col(kind) == name, a).otherwise(low), F.when(F.col(kind) == name, b).otherwise(high)
    rules: dict[str, Column] = {
        "code": present(code) & ~gs1.valid(F.col(code)),
        "abv_range": ~F.col(abv).between(0, 100),
        "abv_class": ~F.col(abv).between(low, high),
        "price": F.col(price) <= 0,
        "above_list": F.col(price) > F.col(list_price),
    }
    return rows.withColumn("violations", F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])))


def violation_rates(judged: DataFrame) -> DataFrame:
    """Violations by rule in a thousand rows."""
    total = judged.agg(F.count(F.lit(1)).alias("rows"))
    v = judged.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    return v.join(F.broadcast(total)).select("rule", "n", F.round(1000 * F.col("n") / F.col("rows"), 3).alias("per_1000"))


def mappable(lat: Column, lng: Column, street: Column, zip5: Column) -> Column:
    """How well a row can be put on a map."""
    point = lat.isNotNull() & lng.isNotNull() & ~((F.abs(lat) < 0.01) & (F.abs(lng) < 0.01))
    return F.when(point, "point").when(present(street) & present(zip5), "address").when(present(zip5), "zip").otherwise("none")


def freshness(last: Column, now: Column, target_hours: Column) -> Column:
    hours = (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(last.cast("timestamp"))) / 3600
    return F.when(last.isNull(), "never").when(hours <= target_hours, "fresh").when(hours <= 2 * target_hours, "late").otherwise("stale")


def evacuate(rows: DataFrame, key: str, fat: str) -> tuple[DataFrame, DataFrame]:
    """A fat column moved to a table of its own: (slim rows, key and payload of rows that have one)."""
    return rows.withColumn(fat, F.lit(None).cast("string")), rows.filter(present(fat)).select(key, fat)


def rare_combinations(rows: DataFrame, columns: list[str], share: float = 0.02) -> DataFrame:
    g = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("_all"))
    return g.join(F.broadcast(total)).filter(F.col("n") < share * F.col("_all")).select(*columns, "n", F.round(F.col("n") / F.col("_all"), 5).alias("share"))
