"""Ranks, correlations, areas under curves, samples and folds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantarium.session import Scratch, ship_package


def average_rank(value: str, within: list[str]) -> Column:
    """Ranks where equals share their mean."""
    w = Window.partitionBy(*within)
    return F.rank().over(w.orderBy(value)) + (F.count("*").over(w.partitionBy(*within, value)) - 1) / 2


#: Vectors and places in one block of a product: two blocks are at most 16 MB.
VECTOR_BLOCK, PLACE_BLOCK = 512, 2048
_SUMS = ["n", "a", "b", "aa", "bb", "ab"]


def _products(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Of each pair of vectors in two blocks: common places, and sums of ranks, squares and products over them."""
    places = np.intersect1d(left["place"].unique(), right["place"].unique())
    keys, values, there = [], [], []
    for rows in (left, right):
        rows = rows[rows["place"].isin(places)]
        own, at = np.unique(rows["key"], return_inverse=True)
        x, has = np.zeros((len(own), len(places))), np.zeros((len(own), len(places)))
        column = np.searchsorted(places, rows["place"])
        x[at, column], has[at, column] = rows["r"], 1
        keys.append(own)
        values.append(x)
        there.append(has)
    (x, y), (p, q) = values, there
    sums = dict(zip(_SUMS, (p @ q.T, x @ q.T, p @ y.T, (x * x) @ q.T, p @ (y * y).T, x @ y.T)))
    i, j = np.nonzero((sums["n"] > 0) & (keys[0][:, None] < keys[1][None, :]))
    return pd.DataFrame({"key_1": keys[0][i], "key_2": keys[1][j]} | {c: m[i, j] for c, m in sums.items()})


def spearman(vectors: DataFrame, vector_block: int = VECTOR_BLOCK, place_block: int = PLACE_BLOCK) -> DataFrame:
    """key_1, key_2 (key_1 < key_2), rho over the places both have; vectors: (key, place, value), one row a place.

    Vectors of one reference set have the same places, so ranks within each vector serve all its pairs. Keys
    and places are dealt to blocks by number, in their order; a task takes two blocks of vectors at one block of
    places and gives six sums a pair, so a vector is sent once for each block of vectors and pairs are never
    joined place by place. Ranks are taken from their mean, which keeps sums exact. Pairs without a common
    place have no row, those where one side does not vary a null; rows with a null value are no places.
    """
    vectors = vectors.select("key", "place", "value").where("key IS NOT NULL AND place IS NOT NULL AND value IS NOT NULL")
    size = F.count("*").over(Window.partitionBy("key"))
    ranked = vectors.select("key", "place", (average_rank("value", ["key"]) - (size + 1) / 2).alias("r"))
    # hashes deal keys and places evenly; twice the blocks that would do keep them under their sizes
    n = vectors.agg(F.approx_count_distinct("key").alias("keys"), F.approx_count_distinct("place").alias("places")).first()
    k, p = (1 if x <= 0.9 * b else -(-2 * x // b) for x, b in ((n["keys"], vector_block), (n["places"], place_block)))
    ranked = ranked.select("*", F.pmod(F.xxhash64("key"), F.lit(k)).cast("int").alias("own"), F.pmod(F.xxhash64("place"), F.lit(p)).cast("int").alias("at"))
    left = ranked.select("at", F.col("own").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("j"), "key", "place", "r")
    right = ranked.select("at", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("i"), F.col("own").alias("j"), "key", "place", "r")
    kind = vectors.schema["key"].dataType.simpleString()
    ship_package(vectors.sparkSession)
    sums = left.groupBy("at", "i", "j").cogroup(right.groupBy("at", "i", "j")).applyInPandas(_products, f"key_1 {kind}, key_2 {kind}, " + ", ".join(f"{c} double" for c in _SUMS))
    sums = sums.groupBy("key_1", "key_2").agg(*(F.sum(c).alias(c) for c in _SUMS))
    spread = F.sqrt((F.col("aa") - F.col("a") * F.col("a") / F.col("n")) * (F.col("bb") - F.col("b") * F.col("b") / F.col("n")))
    return sums.select("key_1", "key_2", F.try_divide(F.col("ab") - F.col("a") * F.col("b") / F.col("n"), spread).alias("rho"))


def top_overlap(vectors: DataFrame, top: int) -> DataFrame:
    """Common members of two vectors' top places, corrected for chance: 1 if all, 0 as by chance."""
    each = Window.partitionBy("key")
    ranked = vectors.withColumn("n", F.count("*").over(each)).withColumn("k", F.row_number().over(each.orderBy(F.desc("value"), "place"))).where(F.col("k") <= top)
    a, b = ranked.select(F.col("key").alias("key_1"), "place", "n"), ranked.select(F.col("key").alias("key_2"), "place")
    shared = a.join(b, "place").where("key_1 < key_2").groupBy("key_1", "key_2", "n").agg(F.count("*").alias("m"))
    keys = vectors.groupBy("key").agg(F.count("*").alias("n"))
    pairs = keys.toDF("key_1", "n").join(keys.select(F.col("key").alias("key_2")), F.col("key_1") < F.col("key_2")).join(shared, ["key_1", "key_2", "n"], "left").fillna(0, ["m"])
    chance = F.lit(float(top)) * top / F.col("n")
    return pairs.select("key_1", "key_2", "m", ((F.col("m") - chance) / (F.lit(float(top)) - chance)).alias("overlap"))


def auroc(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Area under the curve by ranks, equals counting half; scores: keys, score, bin."""
    # equal scores are one row before any window; each wins against the negatives below it and half of its own
    counts = scores.groupBy(*keys, "score").agg(F.sum("bin").alias("p"), F.sum(1 - F.col("bin")).alias("n"))
    below = F.sum("n").over(Window.partitionBy(*keys).orderBy("score")) - F.col("n") / 2
    p, n = F.sum("p"), F.sum("n")
    return counts.withColumn("wins", F.col("p") * below).groupBy(*keys).agg(F.try_divide(F.sum("wins"), p * n).alias("auroc"), p.alias("positives"), n.alias("negatives"))


def shuffled(key: Column, seed: int) -> Column:
    """An order by hash that other engines share."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))


def _ranked(df: DataFrame, within: list[str], member: str, seed: int) -> DataFrame:
    """row (a struct of all columns) and k, the row's number in hash order in its group, from 1.

    Groups are cut by the hash's first digits: counts of these pieces give each its offset, so that
    a group of any size is numbered by many tasks. The input is used twice, so it should be a table.
    """
    group = F.struct(F.lit(0).alias("all"), *(df[c].alias(f"w{i}") for i, c in enumerate(within)))
    rows = df.select(F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("row"), group.alias("g"), df[member].alias("member"))
    rows = rows.withColumn("h", shuffled(F.col("member"), seed)).withColumn("piece", F.substring("h", 1, 2))
    pieces = rows.groupBy("g", "piece").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("g").orderBy("piece")) - F.col("n")
    # members that are null have no hash; their piece is one of its own
    pieces = pieces.select(F.col("g").alias("of"), F.col("piece").alias("at"), before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("g", "piece").orderBy("h", "member"))
    return rows.join(pieces, (F.col("g") == F.col("of")) & F.col("piece").eqNullSafe(F.col("at"))).select("row", (F.col("before") + inside).alias("k"))


def hash_rank(df: DataFrame, within: list[str], member: str, seed: int, name: str = "_k") -> DataFrame:
    """The rows with their numbers in hash order in their groups, from 1."""
    return _ranked(df, within, member, seed).select("row.*", F.col("k").alias(name))


def _once(df: DataFrame, label: str) -> DataFrame:
    """A table of rows that are used more than once."""
    return Scratch(df.sparkSession, label).keep(df, "rows")


#: Rows that one task may pick at the end of an ordered limit.
ONE_TASK = 10_000


def sample(df: DataFrame, key: str, n: int, seed: int = 42, one_task: int = ONE_TASK) -> DataFrame:
    """n rows, the same ones for the same seed; a large n is numbered by many tasks, not gathered by one."""
    if n <= one_task:
        return df.orderBy(shuffled(F.col(key), seed), key).limit(n)
    return _ranked(_once(df, "sample"), [], key, seed).where(F.col("k") <= n).select("row.*")


def decoys(pool: DataFrame, tested: DataFrame, key: str, positives: int, rows: int, ratio: float, seed: int = 42) -> DataFrame:
    """As many pool rows that were never tested as bring the share of positives down to ratio; an error if there are too few."""
    need = max(0, int(positives / ratio) - rows)
    picked = sample(pool.join(tested.select(key).distinct(), key, "left_anti"), key, need, seed)
    if need and picked.count() < need:
        raise ValueError(f"the pool has fewer than {need} rows")
    return picked


def downsampled(df: DataFrame, keys: list[str], member: str, trigger: float = 0.05, ratio: float = 0.10, seed: int = 42) -> DataFrame:
    """Where positives are rarer than trigger, only as many negatives as bring them to ratio.

    Only the negatives of such groups are ranked; null keys are a group like any other.
    """
    rows = _once(df, "downsample").select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.struct(*keys).alias("g"))
    totals = rows.groupBy("g").agg(F.sum("row.bin").alias("p"), F.count("*").alias("n"))
    rows = rows.join(totals, "g").withColumn("free", F.coalesce((F.col("row.bin") == 1) | (F.col("p") >= trigger * F.col("n")), F.lit(False)))
    ranked = _ranked(rows.where("NOT free"), ["g"], f"row.`{member}`", seed)
    p = F.col("row.p")
    return rows.where("free").select("row.*").unionByName(ranked.where(F.col("k") <= F.floor(p / F.lit(ratio)) - p).select("row.row.*"))


def folds(df: DataFrame, keys: list[str], member: str, n: int = 4, seed: int = 42) -> DataFrame:
    """A stratified fold number: rows of a class are dealt in hash order."""
    return _ranked(_once(df, "folds"), [*keys, "bin"], member, seed).select("row.*", ((F.col("k") - 1) % n).cast("int").alias("fold"))


def capped(df: DataFrame, member: str, most: int, least: int = 4, seed: int = 42) -> DataFrame:
    """At most about `most` rows, each class in proportion and with `least` rows at least."""
    rows = _once(df, "capped")
    counts = rows.groupBy("bin").agg(F.count("*").alias("c")).select(F.col("bin").alias("class"), "c")
    ranked = _ranked(rows, ["bin"], member, seed)
    total = rows.count()
    allowed = F.greatest(F.lit(least), F.floor(F.col("c") * F.lit(most / max(total, 1)))) if total > most else F.col("c")
    return ranked.join(counts, F.col("row.bin").eqNullSafe(F.col("class"))).where(F.col("k") <= allowed).select("row.*")


def ends(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first and the last n rows, or all of fewer than 2 n."""
    first = df.orderBy(order).limit(n)
    last = df.orderBy(F.desc(order)).limit(n)
    return first.unionByName(last).distinct()
