"""From measurements of a triplet to labelled datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantarium.functions.numeric import binarize
from quantarium.operators.joins import nullsafe_join
from quantarium.session import Scratch
from quantarium.sources.measurements import TRIPLET

#: Values censored on the active side can't be placed within the range.
_WRONG = {1: "<", -1: ">"}


def fix_censored(df: DataFrame, keys: list[str] = TRIPLET) -> DataFrame:
    """Values censored on the wrong side take the group's least active value; all relations become =.

    Direction 1 (more is more active): `<` becomes the minimum; direction -1: `>` becomes the maximum.
    The extremes are aggregated and joined back, so no group is gathered in one place.
    """
    ends = df.where("value IS NOT NULL").groupBy(*keys).agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    df = nullsafe_join(df, ends, keys, "left")
    value = F.when((F.col("direction") == 1) & (F.col("relation") == "<"), F.col("_low")).when((F.col("direction") == -1) & (F.col("relation") == ">"), F.col("_high")).otherwise(F.col("value"))
    return df.withColumn("value", F.when(F.col("value").isNotNull(), value)).withColumn("relation", F.lit("=")).drop("_low", "_high")


def most_active(df: DataFrame, keys: list[str] = TRIPLET, member: str = "compound_id") -> DataFrame:
    """One row a compound: the least value for direction -1, the largest for 1; ties by structure text."""
    low = F.min_by(F.struct("value", "smiles"), F.struct("value", "smiles"))
    high = F.max_by(F.struct("value", "smiles"), F.struct("value", "smiles"))
    rows = df.groupBy(*keys, member, "direction").agg(F.when(F.col("direction") == 1, high).otherwise(low).alias("_best"))
    return rows.select(*keys, member, "direction", "_best.value", "_best.smiles")


def compounds(df: DataFrame, constants: list[str]) -> DataFrame:
    """All that labels need of each (triplet, constants, direction, compound): a table written once.

    low and high value, the best of the values that stay (`best`), the structure of the best of those
    that fix_censored() moves (`moved`), both flags (`act`, `inact`) and the first structure.
    """
    used = F.col("value").isNotNull() & F.col("direction").isin(1, -1)
    wrong = F.coalesce(((F.col("direction") == 1) & (F.col("relation") == "<")) | ((F.col("direction") == -1) & (F.col("relation") == ">")), F.lit(False))
    stays, moves = F.when(used & ~wrong, F.struct("value", "smiles")), F.when(used & wrong, F.struct("smiles"))
    up, value = F.col("direction") == 1, F.when(used, F.col("value"))
    rows = df.groupBy(*TRIPLET, *constants, "compound_id", "direction").agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.when(up, F.max(stays)).otherwise(F.min(stays)).alias("best"),
        F.when(up, F.max(moves)).otherwise(F.min(moves)).alias("moved"), F.bool_or(F.col("text_flag") == 1).alias("act"), F.bool_or(F.col("text_flag") == -1).alias("inact"), F.min("smiles").alias("first"),
    )
    return Scratch(df.sparkSession, "compounds").keep(rows, "rows")


def actives(table: DataFrame, constants: list[str]) -> DataFrame:
    """The quantitative rows of compounds(): what most_active() gives behind fix_censored()."""
    valued = table.where("low IS NOT NULL")
    ends = valued.groupBy(*TRIPLET).agg(F.min("low").alias("_low"), F.max("high").alias("_high"))
    rows = nullsafe_join(valued, ends, TRIPLET)
    up = F.col("direction") == 1
    moved = F.when(F.col("moved").isNotNull(), F.struct(F.when(up, F.col("_low")).otherwise(F.col("_high")).alias("value"), F.col("moved.smiles").alias("smiles")))
    rows = rows.withColumn("best", F.when(up, F.greatest("best", moved)).otherwise(F.least("best", moved)))
    return rows.select(*TRIPLET, *constants, "compound_id", "direction", "best.value", "best.smiles")


def flagged(table: DataFrame, keys: list[str]) -> DataFrame:
    """The qualitative() rows of compounds()."""
    flags = table.groupBy(*keys, "compound_id").agg(F.bool_or("act").alias("act"), F.bool_or("inact").alias("inact"), F.min("first").alias("smiles"))
    return flags.where("act <> inact").select(*keys, "compound_id", "smiles", F.col("act").cast("int").alias("bin"))


def quantitative(df: DataFrame, constants: list[str]) -> DataFrame:
    """Placed, deduplicated values of triplets with a direction, and the constants.

    Where nothing else is asked of the rows, a second scan for the extremes is cheaper than compounds().
    """
    rows = df.where(F.col("value").isNotNull() & F.col("direction").isin(1, -1))
    return most_active(fix_censored(rows), [*TRIPLET, *constants])


def with_thresholds(df: DataFrame, rules: DataFrame) -> DataFrame:
    """One row for each threshold of the row's endpoint and target class (place 1 is the most lenient); none without."""
    rules = rules.select("activity_type", "unit", "target_class", F.posexplode("thresholds").alias("place", "cutoff")).withColumn("place", F.col("place") + 1)
    return nullsafe_join(df, rules, ["activity_type", "unit", "target_class"], "inner")


def labelled(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Quantitative rows with bin at each threshold."""
    return with_thresholds(df, rules).withColumn("bin", binarize(F.col("value"), F.col("cutoff"), F.col("direction")))


def dataset_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Compounds, positives and their ratio; an error if a compound has two rows."""
    n = F.count("*")
    return df.groupBy(*keys).agg(
        F.when(n == F.count_distinct("compound_id"), n).otherwise(F.raise_error(F.lit("a compound is repeated"))).alias("cpds"),
        F.sum("bin").alias("positives"), F.avg("bin").alias("ratio"),
    )


def qualitative(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row a compound with flags of one sign only: bin 1 or 0; compounds with both or none go."""
    flags = df.groupBy(*keys, "compound_id").agg(F.bool_or(F.col("text_flag") == 1).alias("act"), F.bool_or(F.col("text_flag") == -1).alias("inact"), F.min("smiles").alias("smiles"))
    return flags.where("act <> inact").select(*keys, "compound_id", "smiles", F.col("act").cast("int").alias("bin"))


def conflicting(df: DataFrame, keys: list[str]) -> DataFrame:
    """The compounds whose flags have both signs, with the counts of each: the quarantine of qualitative()."""
    out = df.groupBy(*keys, "compound_id").agg(F.count_if(F.col("text_flag") == 1).alias("actives"), F.count_if(F.col("text_flag") == -1).alias("inactives"))
    return out.where("actives > 0 AND inactives > 0")


def mixed(quantitative_rows: DataFrame, qualitative_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Quantitative rows at each threshold and the qualitative inactives that are not among them."""
    spots = quantitative_rows.select(*keys, "place", "cutoff").distinct()
    inactive = nullsafe_join(spots, qualitative_rows.where("bin = 0"), keys, "inner")
    extra = nullsafe_join(inactive, quantitative_rows.select(*keys, "place", "compound_id").distinct(), [*keys, "place", "compound_id"], "left_anti")
    columns = [*keys, "place", "cutoff", "compound_id", "smiles", "value", "bin"]
    return quantitative_rows.select(*columns, F.lit("quantitative").alias("origin")).unionByName(extra.withColumn("value", F.lit(None).cast("double")).select(*columns, F.lit("qualitative").alias("origin")))


def classify(df: DataFrame, rules: DataFrame, constants: list[str]) -> DataFrame:
    """Each triplet and threshold: its kind (quantitative, qualitative, mixed, none) and counts.

    Triplets without a threshold have one row without cutoff: qualitative or none.
    """
    keys = [*TRIPLET, *constants]
    table = compounds(df, constants)
    triplets = table.select(*keys).distinct()
    spots = nullsafe_join(triplets, rules.select("activity_type", "unit", "target_class", F.posexplode_outer("thresholds").alias("place", "cutoff")), ["activity_type", "unit", "target_class"], "left")
    spots = spots.withColumn("place", F.col("place") + 1)
    numbers = labelled(actives(table, constants), rules).groupBy(*TRIPLET, "place").agg(F.count("*").alias("cpds_qt"), F.sum("bin").alias("pos_qt"))
    flags = flagged(table, TRIPLET)
    texts = flags.groupBy(*TRIPLET).agg(F.count("*").alias("cpds_ql"), F.sum("bin").alias("pos_ql"))
    own = table.where("low IS NOT NULL").select(*TRIPLET, "compound_id").distinct()
    extra = nullsafe_join(flags.where("bin = 0"), own, [*TRIPLET, "compound_id"], "left_anti").groupBy(*TRIPLET).agg(F.count("*").alias("added"))
    out = nullsafe_join(spots, numbers, [*TRIPLET, "place"], "left")
    out = nullsafe_join(nullsafe_join(out, texts, TRIPLET, "left"), extra, TRIPLET, "left").fillna(0, ["cpds_qt", "pos_qt", "cpds_ql", "pos_ql", "added"])
    kind = F.when((F.col("cpds_qt") > 0) & (F.col("added") > 0), "mixed").when(F.col("cpds_qt") > 0, "quantitative").when(F.col("cpds_ql") > 0, "qualitative").otherwise("none")
    return out.withColumn("kind", kind).withColumn("cpds_mx", F.when(kind == "mixed", F.col("cpds_qt") + F.col("added")).otherwise(0)).drop("added")


def positive_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key: positives before negatives, then by the given columns."""
    w = Window.partitionBy(key).orderBy(F.desc("bin"), *order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
