"""Checks of data against itself and against declared rules: gaps of scale, spikes of rates, events missed, places and times."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import present

#: Cells of the decimal logarithm in a decade. Numbers have fewer than 640 decades, so there are never more than 6,400 cells.
CELLS_A_DECADE = 10


def scale_gap(rows: DataFrame, value: str) -> DataFrame:
    """One row: gap (the widest step between two neighbouring positive values, in decades), below (how many values lie under
    it) and n (positive values). Of equally wide steps the lowest counts.

    Nothing is sorted: a step wider than a cell lies between the largest value of a cell and the least of the next one
    that holds any, so one aggregate by cell keeps least, largest and number. Narrower steps, which would lie inside a
    cell, are told as 0."""
    log = F.log10(F.col(value).cast("double"))
    held = rows.select(log.alias("_l")).filter(F.col("_l").isNotNull() & ~F.isnan("_l") & (F.abs("_l") < F.lit(float("inf"))))
    cells = held.groupBy(F.floor(F.col("_l") * CELLS_A_DECADE).alias("_c")).agg(F.min("_l").alias("_lo"), F.max("_l").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(F.lit(0)).orderBy("_c")  # a few thousand cells at most
    steps = cells.select((F.lead("_lo").over(w) - F.col("_hi")).alias("_gap"), F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_below"), "_hi", "_n")
    widest = F.max(F.when(F.col("_gap") >= 1.0 / CELLS_A_DECADE, F.struct("_gap", (-F.col("_hi")).alias("_at"), "_below")))
    return steps.agg(widest.alias("w"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).select(F.coalesce("w._gap", F.lit(0.0)).alias("gap"), F.coalesce("w._below", F.lit(0)).alias("below"), "n")


def coverage_kind(rows: DataFrame, entity: str, axis: str, least: float = 0.6) -> DataFrame:
    """One row: entities, periods, share of the axis that an entity holds on average, and whether the table is a panel, whose
    entities should be there always, or holds events, at which only who takes part is."""
    held = rows.filter(present(entity) & present(axis)).select(entity, axis).distinct()
    c = held.agg(F.count(F.lit(1)).alias("cells"), F.count_distinct(entity).alias("entities"), F.count_distinct(axis).alias("periods"))
    share = F.try_divide(F.col("cells").cast("double"), (F.col("entities") * F.col("periods")).cast("double"))
    return c.select("entities", "periods", F.round(share, 3).alias("coverage"), F.when(share >= least, "panel").otherwise("event").alias("kind"))


def event_gaps(rows: DataFrame, entity: str, axis: str, group: str, least_events: int = 2) -> DataFrame:
    """entity, axis, group, volume, severity of each event at which an active entity was not seen although its group took
    part. Active is who is seen at `least_events` events or more; an entity's group is that of its latest event, the
    greatest of several. Events that the group did not take part in are expected of nobody.

    What is expected is the members of a group times its events, which is what a gap is measured by; it is made by a join on
    the group and leaves again by an anti join on entity and event."""
    r = rows.filter(present(entity) & present(axis)).select(F.col(entity).alias("e"), F.col(axis).alias("p"), F.when(present(group), F.col(group)).alias("g"))
    cells = r.groupBy("e", "p").agg(F.count(F.lit(1)).alias("n"), F.max("g").alias("g"))
    members = cells.groupBy("e").agg(F.count(F.lit(1)).alias("events"), F.sum("n").alias("volume"), F.max(F.when(F.col("g").isNotNull(), F.struct("p", "g"))).alias("last"))
    most = members.agg(F.max("volume").alias("most"))
    active = members.filter((F.col("events") >= least_events) & F.col("last").isNotNull()).select("e", "volume", F.col("last.g").alias("g")).join(F.broadcast(most))
    taking_part = r.filter(F.col("g").isNotNull()).select("p", "g").distinct()
    missed = active.join(taking_part, "g").join(cells.select("e", "p"), ["e", "p"], "left_anti")
    ratio = F.col("volume") / F.col("most")
    return missed.select(F.col("e").alias(entity), F.col("p").alias(axis), F.col("g").alias(group), "volume", F.when(ratio >= 0.5, "high").when(ratio >= 0.2, "medium").otherwise("low").alias("severity"))


def ruled_places(rows: DataFrame, rules: DataFrame, when: str, where: str) -> DataFrame:
    """when, where, n of rows whose place is not among those that the rules (when, where: one row for each allowed pair) allow
    for their time. A time that the rules do not name is not judged, and neither are rows without a time or a place."""
    counted = rows.filter(present(when) & present(where)).groupBy(F.col(when).alias("when"), F.col(where).alias("where")).agg(F.count(F.lit(1)).alias("n"))
    known = rules.select(F.col("when")).distinct()
    return counted.join(known, "when", "left_semi").join(rules.select("when", "where").distinct(), ["when", "where"], "left_anti")


def ruled_sentinels(rows: DataFrame, sentinels: DataFrame) -> DataFrame:
    """column, value, n of values that stand for nothing according to a table (column, value). Rows are turned into one row a
    cell of the columns that are named in it, and counted before they meet the table."""
    wanted = [r[0] for r in sentinels.select("column").distinct().collect() if r[0] in rows.columns]  # columns of one table
    if not wanted:
        return sentinels.sparkSession.createDataFrame([], "column string, value string, n long")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.trim(F.col(c).cast("string")).alias("value")) for c in wanted]))
    counted = rows.select(cells.alias("c")).select("c.*").filter("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(sentinels.select("column", F.col("value").cast("string").alias("value")).distinct(), ["column", "value"])


#: A spike is at least so many violations in a thousand rows and so many times its baseline; one without history
#: at least LOUD times the least; fewer rows than these say nothing.
SPIKE_LEAST, SPIKE_TIMES, LOUD, SPIKE_ROWS = 5.0, 3.0, 4.0, 200


def rate_spikes(judged: DataFrame, day: str, by: list[str], rule: str = "violations", days: int = 7, least_rows: int = SPIKE_ROWS) -> DataFrame:
    """by, day, rule, rate (violations in a thousand rows), baseline (the median of that rule's rates on the `days` days before
    on which there were rows; null without any) and spike. A day on which a rule is not broken has a rate of 0. judged has
    a list of violations in each row."""
    per_day = judged.groupBy(*by, day).agg(F.count(F.lit(1)).alias("rows"))
    broken = judged.select(*by, day, F.explode(rule).alias("rule")).groupBy(*by, day, "rule").agg(F.count(F.lit(1)).alias("n"))
    rules = broken.select(*by, "rule").distinct()
    rates = per_day.join(rules, by).join(broken, [*by, day, "rule"], "left").select(*by, day, "rule", "rows", F.round(1000.0 * F.coalesce("n", F.lit(0)) / F.col("rows"), 2).alias("rate"))
    at = F.unix_date(F.col(day).cast("date"))
    before = F.array_sort(F.collect_list("rate").over(Window.partitionBy(*by, "rule").orderBy("_at").rangeBetween(-days, -1)))
    told = rates.withColumn("_at", at).withColumn("_b", before)
    n = F.size("_b")
    middle = (F.get("_b", F.expr("(size(_b) - 1) div 2")) + F.get("_b", F.expr("size(_b) div 2"))) / 2
    told = told.withColumn("baseline", F.when(n > 0, middle))
    loud = F.when(F.col("baseline").isNull(), F.col("rate") >= SPIKE_LEAST * LOUD).otherwise(F.col("rate") >= F.greatest(F.lit(SPIKE_LEAST), F.col("baseline") * SPIKE_TIMES))
    return told.select(*by, day, "rule", "rate", F.round("baseline", 4).alias("baseline"), ((F.col("rows") >= least_rows) & loud).alias("spike"))


def grain(rows: DataFrame, columns: list[str], least: float = 0.99, most: int = 2, screen: float = 0.05) -> DataFrame:
    """keys of a table, level by level: columns (sorted, comma-parted), n_distinct, share of rows. A set that holds a key is not
    looked at again. All sets of a level are counted in one pass by sketches; those that come near the bar are counted
    exactly in a second one, which is why no level takes more than two passes.

    A sketch errs by less than a hundredth mostly; `screen`, seven times that, is the room that it is given below the bar.
    Rows are counted by hashes of 96 bits."""
    import itertools

    total = rows.count()
    spark, found, out = rows.sparkSession, [], []
    if not total:
        return spark.createDataFrame([], "columns string, n_distinct long, share double")
    for size in range(1, most + 1):
        sets = [s for s in itertools.combinations(sorted(columns), size) if not any(set(k) <= set(s) for k in found)]
        if not sets:
            break
        one = lambda s: F.struct(*[F.col(c) for c in s])
        rough = rows.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(one(s)), F.lit(14))).alias(f"s{i}") for i, s in enumerate(sets)]).first()
        near = [s for i, s in enumerate(sets) if rough[f"s{i}"] >= (least - screen) * total]
        if not near:
            continue
        # One row for each set and row, of a hash of two halves, counted by one shuffle of them.
        halves = F.array(*[F.struct(F.lit(i).alias("i"), F.xxhash64(one(s)).alias("a"), F.hash(one(s)).alias("b")) for i, s in enumerate(near)])
        exact = rows.select(F.explode(halves).alias("h")).select("h.*").distinct().groupBy("i").count().collect()  # a row a set
        for r in exact:
            if r["count"] >= least * total:
                found.append(near[r["i"]])
                out.append((",".join(near[r["i"]]), r["count"], round(r["count"] / total, 6)))
    return spark.createDataFrame(out, "columns string, n_distinct long, share double")


def entity_and_axis(rows: DataFrame, columns: list[str], dates: list[str], least: float = 0.99) -> DataFrame:
    """One row: grain (entity, fact or unknown), entity, axis. A single key is a table of entities; a pair of a date and one
    other column is a fact of that entity along that axis; of several the first by name counts."""
    keys = [r["columns"].split(",") for r in grain(rows, columns, least).orderBy("columns").collect()]  # as many as columns
    one = next((k[0] for k in keys if len(k) == 1), None)
    pair = next((k for k in keys if len(k) == 2 and sum(c in dates for c in k) == 1), None)
    axis = next((c for c in pair if c in dates), None) if pair else None
    entity = one or (next(c for c in pair if c not in dates) if pair else None)
    kind = "entity" if one else "fact" if pair else "unknown"
    return rows.sparkSession.createDataFrame([(kind, entity, None if one else axis)], "grain string, entity string, axis string")


