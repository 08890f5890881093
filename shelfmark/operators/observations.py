"""Dated observations of stock and price: quality, velocity, movers, voids, projection, rollups.

All of it is grouped aggregates and one window keyed by (source, store, product); Spark partitions by that key once
and reuses it, and everything after the weekly fact is bounded by its dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import numbered

CELL = ("source", "store_id", "product_id")
#: A move of so many units without a change of price or promotion is a recount, not a sale.
JITTER = 2
CENSOR_DAYS, CENSOR_CADENCES = 8.0, 3.0
CONFIDENCE_FLOOR = 0.2
COUNT_COVERAGE, COUNT_LEVELS = 0.5, 15
Z95 = 1.96


def _distinct(c: Column | str) -> Column:
    """Distinct values as the size of a set, for groups whose sets are bounded by a dimension (a catalog, a calendar):
    several exact distinct counts in one aggregate would each add a copy of every row before the shuffle."""
    return F.size(F.collect_set(c)).cast("long")


def _lagged(obs: DataFrame, *columns: str) -> DataFrame:
    w = Window.partitionBy(*CELL).orderBy("d")
    return obs.withColumns({f"p_{c}": F.lag(c).over(w) for c in columns})


def quality_cells(obs: DataFrame) -> DataFrame:
    """Per cell: observations, days, moves, recounts and the mean gap between days."""
    moved = F.coalesce(F.col("qty") != F.col("p_qty"), F.lit(False))
    steady = F.coalesce(F.col("price") == F.col("p_price"), F.col("p_price").isNull()) & F.coalesce(F.col("on_promo") == F.col("p_on_promo"), F.col("p_on_promo").isNull())
    jitter = moved & (F.abs(F.col("qty") - F.col("p_qty")) <= JITTER) & steady
    cells = (
        _lagged(obs, "qty", "price", "on_promo", "d")
        .groupBy(*CELL)
        .agg(
            F.count(F.lit(1)).alias("n_obs"),
            # Rows are in the order of days, so a day is counted where it begins, and no set of days is kept.
            F.count_if(F.col("d").isNotNull() & ~F.col("d").eqNullSafe(F.col("p_d"))).alias("n_days"),
            F.min("d").alias("first_date"),
            F.max("d").alias("last_date"),
            F.count("qty").alias("n_qty"),
            _distinct("qty").alias("distinct_qty"),
            F.count_if(moved).alias("qty_moves"),
            F.count_if(F.coalesce(F.col("price") != F.col("p_price"), F.lit(False))).alias("price_moves"),
            F.count_if(jitter).alias("jitter_moves"),
        )
    )
    return cells.withColumn("cadence_days", F.when(F.col("n_days") > 1, F.datediff("last_date", "first_date") / (F.col("n_days") - 1)))


def quality_sources(obs: DataFrame, cells: DataFrame) -> DataFrame:
    """Per source an instrument's card: coverage, distinct levels, recounts, cadence and its tier."""
    # Stores, levels and cadences are grouped first, so that no task holds all of a source.
    levels = obs.filter("qty is not null").select("source", "qty").groupBy("source", "qty").agg(F.lit(1).alias("_")).groupBy("source").agg(F.count(F.lit(1)).alias("levels"))
    by_store = cells.groupBy("source", "store_id").agg(
        F.sum("n_obs").alias("obs"),
        F.count(F.lit(1)).alias("cells"),
        F.sum("n_qty").alias("qty_obs"),
        F.sum("qty_moves").alias("moves"),
        F.sum("jitter_moves").alias("jitters"),
        F.count_if(F.col("n_obs") > 1).alias("diffable"),
    )
    sums = [F.sum(c).alias(c) for c in ("obs", "cells", "qty_obs", "moves", "jitters", "diffable")]
    s = by_store.groupBy("source").agg(*sums, F.count("store_id").alias("stores"))
    steps = cells.filter("cadence_days is not null").groupBy("source", "cadence_days").agg(F.count(F.lit(1)).alias("_n"))
    cadence = steps.groupBy("source").agg(F.percentile("cadence_days", 0.5, F.col("_n")).alias("cadence"))
    joined = s.join(F.broadcast(levels), "source", "left").join(F.broadcast(cadence), "source", "left")  # a row a source
    share = lambda a, b: F.round(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), 3)
    card = joined.select(
        "source",
        "obs",
        "cells",
        "stores",
        share("qty_obs", "obs").alias("qty_coverage"),
        F.coalesce("levels", F.lit(0)).alias("distinct_qty_global"),
        share("diffable", "cells").alias("diffable_frac"),
        share("jitters", "moves").alias("jitter_frac"),
        F.round("cadence", 2).alias("median_cadence_days"),
    )
    counts = (F.col("qty_coverage") >= COUNT_COVERAGE) & (F.col("distinct_qty_global") >= COUNT_LEVELS)
    return card.withColumn("qual_tier", F.when(F.col("diffable_frac") < 0.05, "thin").when(counts, "count").otherwise("state"))


def stock_changes(obs: DataFrame, cards: DataFrame) -> DataFrame:
    """Consecutive observations of counting sources, told apart: sale, restock, recount, censored, out of stock."""
    # A card is one row a source; by a join on the source all of a source's observations would come to one task.
    card = cards.filter("qual_tier = 'count'").select("source", "jitter_frac", F.coalesce("median_cadence_days", F.lit(999.0)).alias("cadence"))
    counted = obs.filter("qty is not null").join(F.broadcast(card), "source")
    pairs = _lagged(counted, "qty", "price", "on_promo", "d").filter("p_qty is not null")
    dq = F.col("qty") - F.col("p_qty")
    # An unknown price leaves a small move undecided: neither a sale nor a recount.
    noise = (dq != 0) & (F.abs(dq) <= JITTER) & (F.col("price") == F.col("p_price")) & (F.col("on_promo") == F.col("p_on_promo"))
    censored = F.datediff("d", "p_d") > F.greatest(F.lit(CENSOR_DAYS), CENSOR_CADENCES * F.col("cadence"))
    return pairs.select(
        *CELL,
        "brand",
        "d",
        dq.alias("dq"),
        noise.alias("is_noise"),
        censored.alias("is_censored"),
        ((F.col("p_qty") > 0) & (F.col("qty") == 0)).alias("oos_enter"),
        F.coalesce("jitter_frac", F.lit(0.0)).alias("jitter_frac"),
        "cadence",
    )


def weekly_velocity(changes: DataFrame, floor: float = CONFIDENCE_FLOOR) -> DataFrame:
    """Units sold by cell and ISO week, with a confidence; cells below the floor are left out, not shown as zero."""
    real = ~F.col("is_noise")
    sale = (F.col("dq") < 0) & real & ~F.col("is_censored")
    restock = (F.col("dq") > 0) & real
    units = lambda when, value: F.sum(F.when(when, value).otherwise(0.0))
    fact = (
        changes.withColumn("week", F.trunc("d", "week"))
        .groupBy(*CELL, "brand", "week")
        .agg(
            units(sale, -F.col("dq")).alias("implied_units"),
            F.count_if(sale).alias("sale_events"),
            F.count_if(restock).alias("restock_events"),
            units(restock, F.col("dq")).alias("restock_units"),
            units(F.col("is_noise"), F.abs("dq")).alias("noise_damped_units"),
            F.count_if("is_censored").alias("censored_pairs"),
            F.count_if("oos_enter").alias("oos_events"),
            F.count(F.lit(1)).alias("pairs"),
            F.max("jitter_frac").alias("jitter_frac"),
            F.max("cadence").alias("cadence"),
        )
    )
    tight = F.least(F.lit(1.0), 3.0 / F.greatest(F.col("cadence"), F.lit(1.0)))
    confidence = tight * (1.0 - F.col("censored_pairs") / F.col("pairs")) * (1.0 - 0.5 * F.col("jitter_frac"))
    return fact.withColumn("confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence))).filter(F.col("confidence") >= floor)


def brand_mart(fact: DataFrame) -> DataFrame:
    """Brand by week: bounded by brands times weeks, however many observations there are."""
    return (
        fact.filter("trim(brand) <> ''")
        .groupBy("brand", "week")
        .agg(
            F.round(F.sum("implied_units"), 4).alias("implied_units"),
            F.round(F.try_divide(F.sum(F.col("implied_units") * F.col("confidence")), F.sum("confidence")), 6).alias("conf_wt_units"),
            F.count_distinct("store_id", "product_id").alias("cells"),
            F.count_distinct("store_id").alias("stores"),
            F.sum("restock_events").alias("restock_events"),
            F.sum("oos_events").alias("oos_events"),
            F.round(F.avg("confidence"), 3).alias("avg_confidence"),
        )
    )


def movers(fact: DataFrame, days: DataFrame, min_cells: int = 5, min_previous: float = 10, full: float = 0.8) -> DataFrame:
    """Week over week on cells seen in both weeks. days has week and obs_days; a change is partial unless both weeks
    were observed on most days of the best one."""
    cell = fact.groupBy("brand", "store_id", "product_id", "week").agg(F.sum("implied_units").alias("units"), F.avg("confidence").alias("conf"))
    # Weeks are few: numbering them needs no more than a list of distinct weeks.
    weeks = cell.select("week").distinct().withColumn("wn", F.row_number().over(Window.orderBy("week")))
    w = Window.partitionBy("brand", "store_id", "product_id").orderBy("wn")
    before = F.lag(F.struct("wn", F.col("units").alias("prev"), F.col("week").alias("prev_week"))).over(w)
    matched = cell.join(F.broadcast(weeks), "week").withColumn("_b", before).filter(F.col("_b.wn") == F.col("wn") - 1).select("brand", "week", "units", "conf", "_b.prev", "_b.prev_week")
    agg = (
        matched.groupBy("brand", "week", "prev_week")
        .agg(F.count(F.lit(1)).alias("matched_cells"), F.sum("units").alias("u"), F.sum("prev").alias("p"), F.avg("conf").alias("c"))
        .filter((F.col("matched_cells") >= min_cells) & (F.col("p") >= min_previous))
    )
    best = days.agg(F.max("obs_days").alias("best"))
    now = days.select("week", F.col("obs_days").alias("cur_obs_days"))
    then = days.select(F.col("week").alias("prev_week"), F.col("obs_days").alias("prev_obs_days"))
    joined = agg.join(now, "week", "left").join(then, "prev_week", "left").join(F.broadcast(best))
    cur, prev = (F.coalesce(c, F.lit(0)) for c in ("cur_obs_days", "prev_obs_days"))
    return joined.select(
        "brand",
        "week",
        "prev_week",
        "matched_cells",
        F.round("u").alias("units"),
        F.round("p").alias("prev_units"),
        F.round(F.col("u") - F.col("p")).alias("delta_units"),
        F.round((F.col("u") - F.col("p")) / F.col("p") * 100, 1).alias("pct_change"),
        F.round("c", 3).alias("confidence"),
        ((cur < full * F.col("best")) | (prev < full * F.col("best"))).alias("partial"),
    )


def voids(fact: DataFrame) -> DataFrame:
    """Brands that ran out, and the units a week that closing the gap would bring."""
    sold = F.when(F.col("implied_units") > 0, F.col("implied_units"))
    out = fact.groupBy("brand").agg(
        F.count_distinct(F.when(F.col("oos_events") > 0, F.col("store_id"))).alias("oos_stores"),
        F.count_distinct("store_id").alias("stores_seen"),
        F.sum("oos_events").alias("oos_events"),
        F.avg(sold).alias("typical"),
        F.avg("confidence").alias("conf"),
    )
    return out.filter("oos_stores > 0 and typical is not null").select(
        "brand",
        "oos_stores",
        "stores_seen",
        "oos_events",
        F.round("typical", 1).alias("typ_units_per_store_wk"),
        F.round(F.col("oos_stores") * F.col("typical")).alias("est_recoverable_units_wk"),
        F.round(F.col("oos_stores") * 100.0 / F.col("stores_seen"), 1).alias("pct_stores_out"),
        F.round("conf", 3).alias("confidence"),
    )


def projection(cells: DataFrame, universe: DataFrame, min_stores: int = 8, min_coverage: float = 0.02) -> DataFrame:
    """Observed units scaled to a market's stores, with a 95 % interval under a finite population; thin cells say why not.

    cells: market, brand, store_id, store_units; universe: market, n."""
    c = cells.groupBy("market", "brand").agg(
        F.count(F.lit(1)).alias("k"), F.sum("store_units").alias("seen"), F.avg("store_units").alias("mean"), F.coalesce(F.stddev_samp("store_units"), F.lit(0.0)).alias("sd")
    )
    j = c.join(universe, "market", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    coverage = F.try_divide(k, n)
    enough = (F.col("n") > 0) & (F.col("k") >= min_stores) & (coverage >= min_coverage)
    error = n * (F.col("sd") / F.sqrt(k)) * F.when(n > 1, F.sqrt(F.greatest((n - k) / (n - 1), F.lit(0.0)))).otherwise(0.0)
    total = n * F.col("mean")
    why = F.concat_ws(
        "; ",
        F.when(F.col("n") == 0, F.lit("no universe")),
        F.when(F.col("k") < min_stores, F.lit(f"fewer than {min_stores} stores")),
        F.when((F.col("n") > 0) & (coverage < min_coverage), F.lit("low coverage")),
    )
    return j.select(
        "market",
        "brand",
        F.col("n").alias("universe_outlets"),
        F.col("k").alias("obs_stores"),
        F.round(coverage, 4).alias("coverage"),
        F.round("seen", 2).alias("observed_units"),
        F.when(enough, F.round(total)).alias("projected_units"),
        F.when(enough, F.round(F.greatest(total - Z95 * error, F.lit(0.0)))).alias("ci_low"),
        F.when(enough, F.round(total + Z95 * error)).alias("ci_high"),
        F.when(enough, F.lit("projected")).otherwise(F.concat(F.lit("suppressed: "), why)).alias("status"),
    )


def store_rollup(obs: DataFrame, *keys: str) -> DataFrame:
    """One row a store: counts, distinct items, exact price quartiles, shares."""
    quartiles = F.percentile("price", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    r = obs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_obs"),
        _distinct("product_id").alias("items"),
        _distinct("brand").alias("brands"),
        _distinct("d").alias("days"),
        F.min("d").alias("first_seen"),
        F.max("d").alias("last_seen"),
        quartiles.alias("q"),
        F.count_if(F.col("on_promo")).alias("promos"),
        _distinct(F.when(F.col("on_promo"), F.col("product_id"))).alias("promo_items"),
        F.count_if(F.col("qty") > 0).alias("stocked"),
    )
    return r.select(
        *keys, "n_obs", "items", "brands", "days", "first_seen", "last_seen", "promo_items",
        F.round(F.col("q")[0], 4).alias("price_p25"), F.round(F.col("q")[1], 4).alias("price_median"), F.round(F.col("q")[2], 4).alias("price_p75"),
        F.round(F.col("promos") / F.col("n_obs"), 4).alias("promo_share"), F.round(F.col("stocked") / F.col("n_obs"), 4).alias("stock_share"),
    )


def metro_rollup(stores: DataFrame, *keys: str) -> DataFrame:
    """An aggregate of store rollups: never goes back to observations."""
    return stores.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("stores"),
        F.sum("n_obs").alias("n_obs"),
        F.max("items").alias("widest_range"),
        F.round(F.median("price_median"), 4).alias("median_of_medians"),
        F.round(F.avg("promo_share"), 4).alias("mean_promo_share"),
        F.max("last_seen").alias("last_seen"),
    )


def percentile_verdict(offers: DataFrame, pool: list[str], value: str = "price") -> DataFrame:
    """Each offer's place in its pool, ties counting half: (below + ties / 2) / n. Offers are counted by pool and value
    first, so a pool's window has a row a value, not a row an offer."""
    counted = offers.groupBy(*pool, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*pool)
    upto = F.sum("_n").over(w.orderBy(value))
    placed = counted.select(*[F.col(c).alias(f"_{c}") for c in (*pool, value)], ((upto - F.col("_n") / 2) / F.sum("_n").over(w)).alias("_place"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*pool, value)]
    met = offers.join(placed, same).withColumn("percentile", F.round("_place", 4)).drop("_place", *[f"_{c}" for c in (*pool, value)])
    return met.withColumn(
        "verdict", F.when(F.col("percentile") <= 0.25, "low").when(F.col("percentile") < 0.75, "typical").otherwise("high")
    )


def reference_pools(rows: DataFrame, pool: list[str], store: str = "store_id", value: str = "price") -> DataFrame:
    """Median of store medians: a store has one vote however many prices it shows."""
    stores = rows.groupBy(*pool, store).agg(F.median(value).alias("m"))
    return stores.groupBy(*pool).agg(F.count(F.lit(1)).alias("stores"), F.round(F.median("m"), 4).alias("reference"))


def price_coherence(rows: DataFrame, key: str, value: str = "price", band: float = 0.35) -> DataFrame:
    """Spread of prices under one key: median, ratio, share within the band, and whether it diverges more than twofold."""
    medians = rows.groupBy(key).agg(F.median(value).alias("median"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"))
    joined = rows.select(key, value).join(medians, key)
    near = F.abs(F.col(value) - F.col("median")) <= band * F.col("median")
    return joined.groupBy(key, "n").agg(
        F.round(F.max("median"), 4).alias("median_price"),
        (F.floor(F.max(F.try_divide("high", "low")) * 1000) / 1000).alias("spread_ratio"),
        F.count_if(near).alias("within_band"),
        F.max(F.col("high") > 2 * F.col("low")).alias("divergent"),
    )


def conservation(changes: DataFrame) -> DataFrame:
    """Units sold against units restocked, by source and in all."""
    real = ~F.col("is_noise")
    sold = F.sum(F.when((F.col("dq") < 0) & real & ~F.col("is_censored"), -F.col("dq")).otherwise(0.0))
    stocked = F.sum(F.when((F.col("dq") > 0) & real, F.col("dq")).otherwise(0.0))
    r = changes.rollup("source").agg(sold.alias("sold"), stocked.alias("restocked"))
    return r.select(F.coalesce("source", F.lit("(all)")).alias("source"), "sold", "restocked", F.round(F.try_divide("sold", "restocked"), 4).alias("ratio"))


def core_voids(obs: DataFrame, core: float, store: str = "store_id", product: str = "product_id") -> DataFrame:
    """Products that a store lacks although most stores of its size class hold them.

    Size classes are thirds by range, the rest going to the last. Stores meet core products of their class only, a
    join whose output is bounded by stores times core products, less what is there."""
    held = obs.select(store, product).distinct()
    width = held.groupBy(store).agg(F.count(F.lit(1)).alias("range"))
    total = width.agg(F.count(F.lit(1)).alias("stores"))
    ranked = numbered(width, F.col("range"), F.col(store)).join(F.broadcast(total))  # one row
    third = F.greatest(F.floor(F.col("stores") / 3), F.lit(1))
    sized = ranked.select(store, F.least(F.floor((F.col("rn") - 1) / third), F.lit(2)).cast("int").alias("size_class"))
    of_class = sized.groupBy("size_class").agg(F.count(F.lit(1)).alias("class_stores"))
    common = (
        held.join(sized, store).groupBy("size_class", product).agg(F.count(F.lit(1)).alias("holders"))
        .join(of_class, "size_class").filter(F.col("holders") >= core * F.col("class_stores"))
    )
    wanted = sized.join(common, "size_class")
    return wanted.join(held, [store, product], "left_anti").select(store, product, "size_class", "holders")


def mark_present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
