"""Joins: null-safe keys, validated one-to-one, substring, and pairs of sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantarium.operators.pairs import common
from quantarium.session import Scratch
from quantarium.sources.measurements import TRIPLET


def nullsafe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join where null keys meet null keys; the right side's keys go."""
    other = right.select(*(F.col(f"`{c}`").alias(f"_r_{c}" if c in keys else c) for c in right.columns))
    match = reduce(lambda a, b: a & b, (F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys))
    out = left.join(other, match, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*(f"_r_{k}" for k in keys))


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str], both: bool = True) -> DataFrame:
    """nullsafe left join that fails while it runs: on a repeated key, or (both) on one without partner."""
    marked = left.withColumn("_l", F.lit(1)), right.withColumn("_r", F.lit(1))
    other = marked[1].select(*(F.col(f"`{c}`").alias(f"_r_{c}" if c in keys else c) for c in marked[1].columns))
    match = reduce(lambda a, b: a & b, (F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys))
    joined = marked[0].join(other, match, "full" if both else "left")
    ok = (F.col("_l").isNotNull() & F.col("_r").isNotNull()) if both else F.lit(True)
    joined = joined.where(F.coalesce(F.assert_true(ok, F.lit("a key has no partner")).isNull(), F.lit(True)))
    hashed = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\x00")) for k in keys]
    from pyspark.sql import Window

    alone = F.count(F.lit(1)).over(Window.partitionBy(*hashed)) == 1
    checked = joined.withColumn("_one", alone)
    return checked.where(F.assert_true(F.col("_one"), F.lit("a key is repeated")).isNull()).drop("_l", "_r", "_one", *(f"_r_{k}" for k in keys))


def flag_member(df: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """A boolean column: whether the key is among ids (column `id`)."""
    return df.join(ids.select(F.col("id").alias(key)).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def mentions_or_member(df: DataFrame, columns: list[str], word: str, ids: DataFrame, key: str) -> DataFrame:
    """Rows where a column holds the word, whatever its case, or whose key is listed."""
    some = reduce(lambda a, b: a | b, (F.coalesce(F.contains(F.lower(c), F.lit(word.lower())), F.lit(False)) for c in columns))
    return flag_member(df, ids, key, "_listed").where(some | F.col("_listed")).drop("_listed")


def without_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(F.col("id").alias(key)), key, "left_anti")


def first_contained(df: DataFrame, c: str, rules: DataFrame) -> DataFrame:
    """The label of the first rule (place, word, label) whose word the column holds, or null.

    Rules are matched by the words' distinct values: one pass over distinct values of the column.
    """
    values = df.select(c).distinct()
    found = values.join(rules, F.contains(F.col(c), F.col("word"))).groupBy(c).agg(F.min_by("label", "place").alias("label"))
    return df.join(found, c, "left")


def longest_prefix_rest(df: DataFrame, c: str, prefixes: DataFrame) -> DataFrame:
    """`rest`: the column without the longest matching prefix (column `prefix`), or as it is."""
    values = df.select(c).distinct()
    hit = values.join(prefixes, F.startswith(F.lower(c), F.lower("prefix"))).groupBy(c).agg(F.max(F.length("prefix")).alias("n"))
    out = df.join(hit, c, "left")
    rest = F.trim(F.expr(f"substring(`{c}`, coalesce(n, 0) + 1)"))
    return out.withColumn("rest", F.when(rest != "", rest).otherwise(F.col(c))).drop("n")


def sets_of(df: DataFrame, keys: list[str] = TRIPLET, member: str = "compound_id") -> DataFrame:
    return df.select(*keys, member).distinct()


def overlaps(members: DataFrame, key: str, member: str, least: int = 0, zeros: bool = False) -> DataFrame:
    """key_1 <= key_2, shared members, sizes and share of the smaller set, of sets with at least `least` members.

    A pair without common members costs nothing (zeros adds such pairs); see pairs.common.
    """
    members = Scratch(members.sparkSession, "sets").keep(members.select(F.col(key).alias("k"), F.col(member).alias("x")).distinct(), "members")
    sizes = members.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    pairs = common(members.withColumn("label", F.lit(None).cast("long")), sizes).select("key_1", "key_2", "n_1", "n_2", "shared")
    # a set with itself shares all that is not null
    n = F.col("n")
    alone = members.where("k IS NOT NULL AND x IS NOT NULL").groupBy("k").agg(F.count("*").alias("shared")).join(sizes, "k")
    pairs = pairs.unionByName(alone.select(F.col("k").alias("key_1"), F.col("k").alias("key_2"), n.alias("n_1"), n.alias("n_2"), "shared"))
    if zeros:  # sets are few: every pair of them is the result
        left, right = sizes.toDF("key_1", "n_1"), sizes.toDF("key_2", "n_2")
        pairs = left.join(right, F.col("key_1") <= F.col("key_2")).join(pairs, ["key_1", "key_2", "n_1", "n_2"], "left").fillna(0, ["shared"])
    return pairs.withColumn("share", F.col("shared") / F.least("n_1", "n_2"))


def concordance(labels: DataFrame, key: str, member: str, label: str, least: int) -> DataFrame:
    """key_1 < key_2, share of equal labels, n of common members, of pairs with at least `least`."""
    rows = Scratch(labels.sparkSession, "concordance").keep(labels.select(F.col(key).alias("k"), F.col(member).alias("x"), F.col(label).alias("label")), "labels")
    pairs = common(rows, rows.groupBy("k").agg(F.count("*").alias("n")), max(least, 1))
    return pairs.select("key_1", "key_2", F.try_divide("same", "told").alias("agreement"), F.col("shared").alias("n"))


def expand_keys(df: DataFrame, c: str, names: list[str], separator: str = ";") -> DataFrame:
    """One row for each key in a list of encoded keys."""
    from quantarium.functions.text import decode_key

    return df.withColumn("_key", F.explode(F.split(c, separator))).select("*", *decode_key(F.col("_key"), names)).drop("_key")


def either(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))
