"""Edges between endpoints, components, references, pools."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantarium.session import Scratch


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Join each node's larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the smallest of them; edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """(node, root): the smallest node of its component, for each node of an edge; edges are (u, v).

    Large-star and small-star alternate until nothing moves; each round is a table of its own.
    """
    now, mark, turn = scratch.keep(_oriented(edges), f"{name}-0"), None, 0
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if tuple(state) == mark or not state[0]:
            break
        mark, turn = tuple(state), turn + 1
        now = scratch.keep(small_star(large_star(now)), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def both_ways(pairs: DataFrame) -> DataFrame:
    """(key, other, agreement, n) of each pair, from both sides."""
    a = pairs.select(F.col("key_1").alias("key"), F.col("key_2").alias("other"), "agreement", "n")
    return a.unionByName(pairs.select(F.col("key_2").alias("key"), F.col("key_1").alias("other"), "agreement", "n"))


def neighbour_agreement(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Mean agreement of each member with members of its group, weighted by common compounds; null if alone.

    members: (key, group, size).
    """
    # pairs across groups go before they are turned round
    side = lambda i: members.select(F.col("key").alias(f"key_{i}"), F.col("group").alias(f"group_{i}"))
    sides = both_ways(pairs.join(side(1), "key_1").join(side(2), "key_2").where("group_1 = group_2"))
    mean = sides.groupBy("key").agg(F.try_divide(F.sum(F.col("agreement") * F.col("n")), F.sum("n")).alias("mean_agreement"))
    return members.join(mean, "key", "left")


def references(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Each group's medoid: the best mean agreement, then the larger, then the first key."""
    scored = neighbour_agreement(pairs, members)
    order = F.struct(F.coalesce("mean_agreement", F.lit(-1.0)), "size", (-F.col("key")).alias("first"))
    return scored.groupBy("group").agg(F.max_by("key", order).alias("reference"))


def pooled(rows: DataFrame, keys: list[str], structure: str = "smiles", member: str = "compound_id") -> DataFrame:
    """Any-active labels: of each compound, then of each structure, with its first active compound."""
    per = rows.groupBy(*keys, member).agg(F.max("bin").alias("bin"), F.min(structure).alias(structure))
    best = F.max_by(F.col(member), F.struct("bin", (-F.col(member)).alias("first")))
    return per.groupBy(*keys, structure).agg(F.max("bin").alias("bin"), best.alias(member))


def occurrences(rows: DataFrame, structure: str = "smiles") -> DataFrame:
    """In how many datasets each structure is active."""
    return rows.where("bin = 1").groupBy(structure).agg(F.count("*").alias("n"))


def prune(pairs: DataFrame, sizes: dict, score, least: float, loss: float = 0.02, checks: int = 200, policy: str = "largest", agreement: dict | None = None) -> list:
    """Keys dropped from a pool: discordant pairs in ascending agreement lose a member while the score holds.

    The policy `largest` keeps a pair's larger member, `medoid` the one with the higher mean agreement
    with its pool; ties keep key_2. score(dropped) is the pool's score without these keys, or None if it can't
    be had: a member goes if its trial, or the pool before it, has no score. Each check fits a model, so a pool
    gets at most `checks` of them; pairs of which a member is gone cost none. Pairs come to the driver a partition at a time.
    """
    if policy not in ("largest", "medoid"):
        raise ValueError(f"unknown policy {policy}")
    rank = (lambda k: (agreement or {}).get(k) or -1.0) if policy == "medoid" else sizes.__getitem__
    dropped: list = []
    base, done = score(dropped), 0
    for r in pairs.where(F.col("agreement") < least).orderBy("agreement", "key_1", "key_2").toLocalIterator():
        a, b = r["key_1"], r["key_2"]
        if a in dropped or b in dropped:
            continue
        if done >= checks:
            break
        done += 1
        loser = a if rank(a) <= rank(b) else b
        now = score([*dropped, loser])
        if base is None or now is None or now >= base - loss:
            dropped.append(loser)
            base = base if now is None else now
    return dropped


def ranks(pairs: DataFrame, members: DataFrame, policy: str = "largest") -> DataFrame:
    """group, key, rank: which of a discordant pair stays, by size (`largest`) or by mean agreement with the pool (`medoid`).

    members: (key, group, size); pairs: (key_1, key_2, agreement, n). No agreement, or none but 0, ranks below all.
    """
    if policy not in ("largest", "medoid"):
        raise ValueError(f"unknown policy {policy}")
    if policy == "largest":
        return members.select("group", "key", F.col("size").cast("double").alias("rank"))
    rank = F.coalesce(F.nullif("mean_agreement", F.lit(0.0)), F.lit(-1.0))
    return neighbour_agreement(pairs, members).select("group", "key", rank.alias("rank"))


def prune_pools(pairs: DataFrame, ranked: DataFrame, score: Callable[[DataFrame], DataFrame], scratch: Scratch, least: float, loss: float = 0.02, checks: int = 200) -> DataFrame:
    """group, key, kept: `prune` of all pools at once, in rounds; ranked: group, key, rank, as of `ranks`.

    In each round every pool tries its next discordant pair whose members are both still there, and one call of
    score, on (group, key) of all these trials, gives (group, score) of each; a pool without a row, or with a
    null, has no score. There are as many rounds as the longest pool has checks, `checks` at most, and between them only
    tables: members left, and each pool's score and place. Pairs across pools are none of theirs; null keys are no members.
    A key may be in several pools, one for each policy say.
    """
    ranked = scratch.keep(ranked.where("key IS NOT NULL"), "ranked")
    side = lambda i: ranked.select(F.col("group").alias(f"group_{i}"), F.col("key").alias(f"key_{i}"), F.col("rank").alias(f"rank_{i}"))
    open_pairs = pairs.where(F.col("agreement") < least).join(side(1), "key_1").join(side(2), "key_2").where("group_1 = group_2")
    loser = F.when(F.col("rank_1") <= F.col("rank_2"), F.col("key_1")).otherwise(F.col("key_2"))
    open_pairs = scratch.keep(open_pairs.select(F.col("group_1").alias("group"), F.struct("agreement", "key_1", "key_2").alias("pair"), loser.alias("loser")), "open")
    members = ranked.select("group", "key")
    gone = scratch.keep(members.limit(0), "gone")  # a key a pool and round at most, so open pairs stay where they are
    none = F.lit(None).cast(open_pairs.schema["pair"].dataType)
    # a pool without any discordant pair needs no score
    asked = open_pairs.select("group").distinct()
    state = scratch.keep(asked.join(score(members.join(asked, "group", "left_semi")), "group", "left").select("group", F.col("score").cast("double").alias("base"), none.alias("last")), "state")
    for turn in range(checks):
        there = open_pairs.join(state, "group").where("last IS NULL OR pair > last").select("*", "pair.key_1", "pair.key_2")
        for one in ("key_1", "key_2"):
            there = there.join(gone.toDF("group", one), ["group", one], "left_anti")
        tried = scratch.keep(there.groupBy("group").agg(F.min("pair").alias("pair"), F.min_by("loser", "pair").alias("loser"), F.first("base").alias("base")), f"tried{turn}")
        if tried.isEmpty():
            break
        kept = members.join(tried.select("group", "loser"), "group").where("key <> loser").select("group", "key").join(gone, ["group", "key"], "left_anti")
        now = score(kept).select("group", F.col("score").cast("double").alias("now"))
        goes = F.col("base").isNull() | F.col("now").isNull() | (F.col("now") >= F.col("base") - loss)
        moved = scratch.keep(tried.join(now, "group", "left").select("group", "pair", "loser", goes.alias("goes"), F.when(goes, F.coalesce("now", "base")).otherwise(F.col("base")).alias("next")), f"moved{turn}")
        # pools that had nothing left to try stay out
        state = moved.select("group", F.col("next").alias("base"), F.col("pair").alias("last"))
        gone = scratch.keep(gone.unionByName(moved.where("goes").select("group", F.col("loser").alias("key"))), f"gone{turn}")
        scratch.drop(f"tried{turn}")
    return members.join(gone.withColumn("kept", F.lit(False)), ["group", "key"], "left").select("group", "key", F.coalesce("kept", F.lit(True)).alias("kept"))


#: Ways to pool endpoints: by bucket, by family of a bucket, by component of agreement.
def pool_by_bucket(endpoints: DataFrame) -> DataFrame:
    return endpoints.withColumn("pool", F.col("bucket"))


def pool_by_family(endpoints: DataFrame) -> DataFrame:
    from quantarium.functions.text import family

    return endpoints.withColumn("pool", family(F.col("activity_type"), F.col("unit"), F.col("bucket")))


def pool_by_component(endpoints: DataFrame, edges: DataFrame, scratch: Scratch, least: float = 0.7, most: int = 6) -> DataFrame:
    """Components of agreeing endpoints; the largest `most` of a bucket are pools, the rest is its residual."""
    from pyspark.sql import Window

    roots = components(edges.where(F.col("agreement") >= least).select(F.col("key_1").alias("u"), F.col("key_2").alias("v")), scratch)
    rows = endpoints.join(roots.withColumnRenamed("node", "key"), "key", "left")
    sizes = rows.where("root IS NOT NULL").groupBy("bucket", "root").agg(F.count("*").alias("n"))
    ranked = sizes.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("n"), "root"))).where(F.col("place") <= most)
    rows = rows.join(ranked.select("bucket", "root", "place"), ["bucket", "root"], "left")
    return rows.withColumn("pool", F.concat_ws("_", "bucket", F.coalesce(F.col("place").cast("string"), F.lit("residual")))).drop("place", "root")


STRATEGIES = {"bucket": pool_by_bucket, "family": pool_by_family, "component": pool_by_component}
