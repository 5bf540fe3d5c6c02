"""Which datasets, thresholds, assays and merges to keep, and why."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantarium.operators.joins import nullsafe_join
from quantarium.sources.measurements import TRIPLET


@dataclass(frozen=True)
class Limits:
    """Fixed values of the published pipeline; all can be set."""

    decoy_ratio: float = 0.1
    a_compounds: int = 1000
    a_positives: int = 50
    b_positives: int = 100
    ratio: float = 0.5
    score: float = 0.70
    improvement: float = 0.1
    correlation: float = 0.5
    overlap_compounds: int = 50
    merge_union: int = 100
    contribution: float = 0.05
    merged_compounds: int = 1000
    merged_compounds_balanced: int = 100
    merged_positives: int = 50
    top: tuple[int, int] = (100, 1000)


def condition_a(limits: Limits) -> Column:
    return F.col("kind").isin("quantitative", "mixed") & (F.col("cpds_qt") >= limits.a_compounds) & (F.col("pos_qt") >= limits.a_positives) & (F.col("pos_qt") < limits.ratio * F.col("cpds_qt"))


def condition_b(limits: Limits) -> Column:
    return F.col("kind").isin("quantitative", "mixed") & (F.col("pos_qt") >= limits.b_positives) & (F.col("pos_qt") >= limits.ratio * F.col("cpds_qt"))


def hierarchical(datasets: DataFrame, limits: Limits, keys: list[str] = TRIPLET) -> DataFrame:
    """Rows that meet their triplet's label: A if any of its thresholds meets A, else B. Null units have none."""
    marked = datasets.withColumn("a", condition_a(limits)).withColumn("b", condition_b(limits)).where("unit IS NOT NULL")
    each = marked.groupBy(*keys).agg(F.bool_or("a").alias("any_a"), F.bool_or("b").alias("any_b")).where("any_a OR any_b")
    rows = nullsafe_join(marked, each, keys)
    return rows.withColumn("label", F.when(F.col("any_a"), "A").otherwise("B")).where("(label = 'A' AND a) OR (label = 'B' AND b)").drop("a", "b", "any_a", "any_b")


def select_threshold(scores: DataFrame, keys: list[str], limits: Limits, least_rows: int = 2) -> DataFrame:
    """(keys, best, reference score, chosen cutoff) where the best score is above the limit.

    scores: keys, cutoff, score, is_reference. The reference stays unless it is missing or the best
    is more than `improvement` above it. Ties of the best: the lower place.
    """
    best = scores.groupBy(*keys).agg(
        F.max_by(F.struct("cutoff", "score"), F.struct("score", (-F.col("place")).alias("first"))).alias("best"),
        F.max(F.when(F.col("is_reference"), F.struct("cutoff", "score"))).alias("ref"), F.count("*").alias("rows"),
    ).where((F.col("rows") >= least_rows) & (F.col("best.score") > limits.score))
    keep = F.col("ref").isNotNull() & (F.col("best.score") - F.col("ref.score") <= limits.improvement)
    return best.select(*keys, F.col("best.cutoff").alias("best_cutoff"), F.col("best.score").alias("best_score"), F.col("ref.score").alias("ref_score"), F.when(keep, F.col("ref.cutoff")).otherwise(F.col("best.cutoff")).alias("selected_cutoff"))


def merge_groups(members: DataFrame, group: list[str], assay: list[str], least_union: int) -> DataFrame:
    """Groups of several assays whose union of compounds is large enough, with their sorted keys."""
    key = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in assay))
    out = members.withColumn("_key", key).groupBy(*group).agg(F.count_distinct("_key").alias("n_assays"), F.count_distinct("compound_id").alias("n_compounds"), F.array_join(F.array_sort(F.collect_set("_key")), ";").alias("assay_keys"))
    return out.where((F.col("n_assays") > 1) & (F.col("n_compounds") >= least_union))


def named(groups: DataFrame, prefix: str, order: list[Column | str]) -> DataFrame:
    """M_ORG0, M_ORG1, ...: by union size, then keys. Groups are few."""
    return groups.withColumn("name", F.concat(F.lit(prefix), (F.row_number().over(Window.orderBy(*order)) - 1).cast("string")))


def fractional(members: DataFrame, group: list[str], assay: str, share: float) -> DataFrame:
    """group, assay, n, pass: 1 if the assay holds the share of the group's union, 2 if of the rejects' own union.

    A pass of fewer than two assays is none (0).
    """
    members = members.select(*group, assay, "compound_id").distinct()

    def judged(rows: DataFrame) -> DataFrame:
        union = rows.groupBy(*group).agg(F.count_distinct("compound_id").alias("union"))
        sizes = rows.groupBy(*group, assay).agg(F.count("*").alias("n"))
        return nullsafe_join(sizes, union, group).withColumn("ok", F.col("n") >= share * F.col("union"))

    one = judged(members)
    rejected = nullsafe_join(members, one.where("NOT ok").select(*group, assay), [*group, assay], "left_semi")
    several = nullsafe_join(rejected, rejected.groupBy(*group).agg(F.count_distinct(assay).alias("k")).where("k >= 2").drop("k"), group, "left_semi")
    two = judged(several).where("ok").select(*group, assay, F.lit(2).alias("second"))
    out = nullsafe_join(one, two, [*group, assay], "left").withColumn("pass", F.when(F.col("ok"), 1).otherwise(F.coalesce("second", F.lit(0))))
    strong = out.where("pass > 0").groupBy(*group, "pass").agg(F.count("*").alias("k")).where("k >= 2").drop("k").withColumn("strong", F.lit(True))
    out = nullsafe_join(out, strong, [*group, "pass"], "left")
    return out.select(*group, assay, "n", F.when(F.col("strong"), F.col("pass")).otherwise(0).alias("pass"))


def passes_gates(limits: Limits) -> Column:
    """Of a merged dataset with cpds and positives."""
    enough = F.when(F.col("positives") < limits.ratio * F.col("cpds"), limits.merged_compounds).otherwise(limits.merged_compounds_balanced)
    return (F.col("cpds") >= enough) & (F.col("positives") > limits.merged_positives)


def resolved_reasons(events: DataFrame, key: str) -> DataFrame:
    """The reason of each assay from events (key, step, reason).

    A success counts whenever it happens; a failure only replaces the state of a group that qualified,
    so the first failure stays.
    """
    rank = F.when(F.col("reason") == "successfully_merged", 2).when(F.col("reason") != "group_qualified", 1).otherwise(0)
    return events.groupBy(key).agg(F.max_by("reason", F.struct(rank.alias("rank"), (-F.col("step")).alias("first"))).alias("reason"))


#: Datasets of an entity that one walk may hold.
MOST_DATASETS = 10_000


def greedy_distinct(datasets: DataFrame, pairs: DataFrame, limits: Limits) -> DataFrame:
    """(name, kept): datasets in their order (place) unless alike to one kept before.

    Alike: the pair's mean correlation and its overlap are above the limit. Datasets of an entity are a
    few hundred rows, so the walk is one expression over their ordered list; only alike pairs are joined.
    More than MOST_DATASETS fail the job.
    """
    alike = pairs.where((F.col("score") > limits.correlation) & (F.col("share") > limits.correlation)).select(F.col("key_1").alias("a"), F.col("key_2").alias("b"))
    near = alike.unionByName(alike.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").groupBy("a").agg(F.collect_set("b").alias("near"))
    rows = datasets.join(near, F.col("name") == F.col("a"), "left")
    few = F.when(F.count("*") > MOST_DATASETS, F.raise_error(F.lit(f"more than {MOST_DATASETS} datasets")).cast("long")).otherwise(F.count("*"))
    one = rows.agg(few.alias("n"), F.array_sort(F.collect_list(F.struct("place", "name", F.coalesce("near", F.expr("array()")).alias("near")))).alias("l"))
    empty = F.expr("filter(transform(l, x -> x.name), x -> false)")
    kept = F.aggregate("l", empty, lambda acc, x: F.when(F.arrays_overlap(acc, x["near"]), acc).otherwise(F.array_append(acc, x["name"])))
    return one.withColumn("kept", kept).select(F.explode("l").alias("x"), "kept").select(F.col("x.name").alias("name"), F.array_contains("kept", F.col("x.name")).alias("kept"))


def causes(result: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each dropped dataset, the kept one it correlates with best."""
    both = pairs.select(F.col("key_1").alias("name"), F.col("key_2").alias("other"), "score").unionByName(pairs.select(F.col("key_2").alias("name"), F.col("key_1").alias("other"), "score"))
    kept = result.where("kept").select(F.col("name").alias("other"))
    return both.join(result.where("NOT kept").select("name"), "name").join(kept, "other").groupBy("name").agg(F.max_by("other", F.struct("score", "other")).alias("cause"), F.max("score").alias("score"))


def comment(n: str = "cpds_qt", limits: Limits | None = None) -> Column:
    """Why a dataset row is or isn't of label A, with its numbers."""
    limits = limits or Limits()
    return (
        F.when(F.col("kind") == "none", "no activity data").when(F.col("kind") == "qualitative", "only qualitative data").when(F.col("cutoff").isNull(), "no expert cutoff defined")
        .when(condition_a(limits), F.format_string("Retained: %d compounds, %d actives", F.col(n), F.col("pos_qt")))
        .when(F.col(n) < limits.a_compounds, F.format_string("insufficient compounds (%d)", F.col(n)))
        .when(F.col("pos_qt") < limits.a_positives, F.format_string("insufficient positives (%d)", F.col("pos_qt")))
        .otherwise("active ratio out of range")
    )
