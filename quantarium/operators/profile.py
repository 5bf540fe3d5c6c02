"""Counts, summaries and other aggregates over measurements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantarium.operators.joins import nullsafe_join
from quantarium.session import Scratch
from quantarium.sources.measurements import TRIPLET


def running(df: DataFrame, order: list[Column], amount: str) -> DataFrame:
    """Adds to each row its place (from 1) in a total order and the sum of `amount` up to it, itself included.

    Rows are cut into ranges of the order, written with their range's number; the sums of these ranges,
    as many as there are tasks, give each its start, so the windows run inside ranges.
    """
    ranged = Scratch(df.sparkSession, "ranges").keep(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "rows")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(amount).alias("_s"))
    starts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s"))
    inside = Window.partitionBy("_part").orderBy(*order)
    up_to = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.join(F.broadcast(starts), "_part")
    return rows.select(*df.columns, (F.col("_n") + F.row_number().over(inside)).alias("place"), (F.col("_s") + F.sum(amount).over(up_to)).alias("up_to"))


def value_counts(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Keys (nulls are one), count, dense rank by count, and cumulative share in that order (ties by key)."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    names = [c for c in counts.columns if c != "n"]
    rows = running(counts, [F.desc("n"), *(F.asc_nulls_first(c) for c in names)], "n")
    # different counts are fewer than the root of twice the rows, whatever the keys
    levels = rows.groupBy("n").agg(F.max("up_to").alias("end"))
    ranks = levels.select("n", F.dense_rank().over(Window.orderBy(F.desc("n"))).alias("rank"), F.max("end").over(Window.partitionBy()).alias("total"))
    return rows.join(ranks, "n").select(*names, "n", "rank", (F.col("up_to") / F.col("total")).alias("share"))


def only_one(c: str) -> Column:
    """The group's one value, null counting as a value; an error if it has several."""
    one = (F.count(c) == 0) | ((F.count(c) == F.count("*")) & (F.min(c) == F.max(c)))
    return F.when(one, F.min(c)).otherwise(F.raise_error(F.lit(f"{c} has several values in a group")))


def triplet_summary(df: DataFrame, constants: list[str], universe: int) -> DataFrame:
    """Rows, nulls, compounds, flags and share of the universe of each triplet, and its constants."""
    return df.groupBy(*TRIPLET).agg(
        F.count("*").alias("activities"), F.count_if(F.col("value").isNull()).alias("nan_values"), F.count_distinct("compound_id").alias("cpds"),
        F.count_if(F.col("text_flag") == 1).alias("act_flag"), F.count_if(F.col("text_flag") == -1).alias("inact_flag"),
        (F.count_distinct("compound_id") / F.lit(universe)).alias("frac_cs"), *(only_one(c).alias(c) for c in constants),
    )


def relation_counts(df: DataFrame, keys: list[str] = TRIPLET) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.count_if(F.col("relation") == r).alias(n) for r, n in (("=", "equal"), ("<", "lower"), (">", "higher"))))


def cumulative(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """k0, k1, ... (the keys), v, n, before, total: each group's values in order, the rows with this one, with lesser ones, and in all.

    Null values are left out; null keys are keys. Equal values are one row before anything is ordered. The
    values are cut into ranges over all groups, so that a group of any size is counted by many tasks: sums
    of its ranges, at most one a task, give each range its start.
    """
    group = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*(df[f"`{c}`"].alias(k) for c, k in zip(keys, group)), df[f"`{value}`"].alias("v")).where("v IS NOT NULL")
    counts = rows.groupBy(*group, "v").agg(F.count("*").alias("n"))
    ranged = Scratch(df.sparkSession, "cumulative").keep(counts.repartitionByRange(*group, "v").withColumn("part", F.spark_partition_id()), "values")
    sums = ranged.groupBy(*group, "part").agg(F.sum("n").alias("n"))
    each = Window.partitionBy(*group)
    starts = sums.select(*group, "part", (F.sum("n").over(each.orderBy("part")) - F.col("n")).alias("start"), F.sum("n").over(each).alias("total"))
    up_to = F.sum("n").over(Window.partitionBy(*group, "part").orderBy("v"))
    inside = ranged.select(*group, "part", "v", "n", (up_to - F.col("n")).alias("inside"))
    return nullsafe_join(inside, starts, [*group, "part"]).select(*group, "v", "n", (F.col("start") + F.col("inside")).alias("before"), "total")


def quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Keys and, under each name, the exact quantile at its share (0 to 1), by linear interpolation.

    NaN is above all numbers, as Spark orders it; groups without values have no row.
    """
    rows = cumulative(df, keys, value)
    group = [f"k{i}" for i in range(len(keys))]

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("before") <= place) & (place < F.col("before") + F.col("n")), F.col("v")))

    places = {name: F.lit(float(share)) * (F.col("total") - 1) for name, share in shares.items()}
    ends = [e for i, x in enumerate(places.values()) for e in (at(F.floor(x)).alias(f"below{i}"), at(F.ceil(x)).alias(f"above{i}"))]
    # only values that a quantile lies at or next to are gathered, at most two a quantile
    near = [(x > F.col("before") - 1) & (x < F.col("before") + F.col("n")) for x in places.values()]
    out = rows.where(reduce(lambda a, b: a | b, near)).groupBy(*group).agg(F.max("total").alias("total"), *ends)

    def between(i: int, x: Column) -> Column:
        low, high = F.col(f"below{i}"), F.col(f"above{i}")
        return F.when(low == high, low.cast("double")).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    return out.select(*(F.col(k).alias(c) for c, k in zip(keys, group)), *(between(i, x).alias(name) for i, (name, x) in enumerate(places.items())))


def percentiles(df: DataFrame, keys: list[str] = TRIPLET, value: str = "value") -> DataFrame:
    """Least, 1, 25, 50, 75, 99 % and largest value, by linear interpolation."""
    return quantiles(df, keys, value, {"low": 0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "high": 1})


def null_share(df: DataFrame, key: str, value: str = "value") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col(value).isNull()).alias("nulls")).where("nulls > 0").withColumn("share", F.col("nulls") / F.col("n"))


def violations(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def ambiguous_units(df: DataFrame) -> DataFrame:
    """(assay, activity type) with a null unit and another one."""
    return df.groupBy("assay_id", "activity_type").agg(F.bool_or(F.col("unit").isNull()).alias("missing"), F.count_distinct("unit").alias("units")).where("missing AND units > 0").drop("missing")


def concatenated(df: DataFrame, key: str, value: str, separator: str = ";") -> DataFrame:
    """Distinct non-empty values of each key, in order, as one text."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.nullif(F.trim(value), F.lit("")))), separator).alias("joined"))


def mode_with_ties(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent non-empty value; of equals the longest, then the last in order."""
    counts = df.where(F.trim(value) != "").groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.max_by(value, F.struct("n", F.length(value), value)).alias("mode"))


def running_coverage(members: DataFrame, key: str, member: str) -> DataFrame:
    """Sets from the largest down: place, size, and distinct members so far."""
    members = members.select(key, member).distinct()
    sizes = members.groupBy(key).agg(F.count("*").alias("size"))
    # one row a set; members count where they first appear
    placed = running(sizes, [F.desc("size"), F.col(key)], "size").drop("up_to")
    first = members.join(placed, key).groupBy(member).agg(F.min("place").alias("place"))
    new = first.groupBy("place").agg(F.count("*").alias("new"))
    out = placed.join(new, "place", "left").select(key, "size", F.col("place").alias("at"), F.coalesce("new", F.lit(0)).alias("new"))
    return running(out, [F.col("at")], "new").select(key, "place", "size", F.col("up_to").alias("covered"))


def bucket_shares(members: DataFrame, bucket: str, member: str) -> DataFrame:
    """Size of each bucket's union, its share of all members, and members of no other bucket."""
    per = members.groupBy(member).agg(F.collect_set(bucket).alias("buckets"))  # as many as there are buckets
    rows = per.select(member, F.explode("buckets").alias(bucket), (F.size("buckets") == 1).alias("alone"))
    total = per.count()
    return rows.groupBy(bucket).agg(F.count("*").alias("members"), F.count_if("alone").alias("exclusive")).withColumn("share", F.col("members") / F.lit(max(1, total)))


def pivot_shares(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of each value and their shares of the row's sum."""
    counts = df.groupBy(row).pivot(column, values).count().fillna(0)
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return counts.select(row, *(F.col(f"`{v}`").alias(f"n_{v}") for v in values), *((100 * F.col(f"`{v}`") / F.greatest(total, F.lit(1))).alias(f"pct_{v}") for v in values))


def ladder(df: DataFrame, c: str, steps: list[int]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c) >= s).alias(f"at_least_{s}") for s in steps))


def condition_stats(df: DataFrame, key: str) -> DataFrame:
    """Number, sums, mean ratio and spread of scores of each condition's datasets."""
    return df.groupBy(key).agg(
        F.count("*").alias("n"), F.sum("cpds").alias("cpds"), F.sum("positives").alias("positives"), F.avg("ratio").alias("mean_ratio"),
        F.avg("score").alias("score_mean"), F.percentile("score", F.lit(0.5)).alias("score_median"), F.stddev_samp("score").alias("score_sd"), F.min("score").alias("score_min"), F.max("score").alias("score_max"),
    )


def funnel(stages: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """Distinct keys (null-safe) left at each stage."""
    out = None
    for i, (name, df) in enumerate(stages):
        row = df.select(*keys).distinct().agg(F.count("*").alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def square_matrix(pairs: DataFrame, names: list, metric: str, most: int = 10_000) -> DataFrame:
    """A row a key_1 with a column for each name: names are endpoints, an error above `most` of them."""
    if len(names) > most:
        raise ValueError(f"a matrix has at most {most} columns")
    return pairs.groupBy("key_1").pivot("key_2", names).agg(F.first(metric))


def approximate(df: DataFrame, keys: list[str], member: str, value: str, error: float = 0.02) -> DataFrame:
    """Sketches instead of exact sets: distinct members, and the median, within about `error`."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(member, error).alias("members"), F.percentile_approx(value, 0.5, int(1 / error) * 100).alias("median"))


def steps(df: DataFrame, key: str, order: str, value: str, parts: int = 4, reach: int = 3600) -> DataFrame:
    """For each row: the values before and behind it, its quarter and percent rank, and the sum of the hour (`reach` seconds) up to it."""
    w = Window.partitionBy(key).orderBy(order, "event_id")
    near = Window.partitionBy(key).orderBy(F.unix_timestamp(order)).rangeBetween(-reach, 0)
    return df.select(
        "event_id", key, F.lag(value).over(w).alias("before"), F.lead(value).over(w).alias("behind"), F.ntile(parts).over(w).alias("part"),
        F.percent_rank().over(w).alias("share"), F.sum(value).over(near).alias("near"),
    )
