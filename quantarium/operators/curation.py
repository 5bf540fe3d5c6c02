"""Names to ids, strains to labels, assays to annotated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantarium.functions.text import prefix_key, strain_key
from quantarium.operators.joins import first_contained, longest_prefix_rest, nullsafe_join
from quantarium.operators.stats import shuffled
from quantarium.sources.measurements import TRIPLET


def lookup_index(names: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(key, id): names and synonyms (id, name) in lower case; names before synonyms, the first id of equals."""
    rows = names.select("id", "name", F.lit(0).alias("rank")).unionByName(synonyms.select("id", "name", F.lit(1).alias("rank")))
    rows = rows.select("id", F.lower(F.trim("name")).alias("key"), "rank").where("key <> ''")
    return rows.groupBy("key").agg(F.min_by("id", F.struct("rank", "id")).alias("id"))


def _rebuilt(parts: Column) -> Column:
    """The first part without its last run of letters and digits, and the second, if that has at most three characters."""
    base = F.regexp_replace(F.trim(F.get(parts, 0)), "[A-Za-z0-9]+$", "")
    second = F.trim(F.get(parts, 1))
    return F.when((F.size(parts) == 2) & (F.length(second) <= 3) & (base != ""), F.concat(base, second))


def resolve_names(df: DataFrame, name: str, index: DataFrame, prefixes: DataFrame) -> DataFrame:
    """`id` of each name by the first way that finds one.

    Whole; without the organism before it; parts between slashes of either; a short second part put on
    the first one's stem; the same for single tokens with a slash. Every way is a row of candidates, so
    one join with the index answers all of them.
    """
    names = longest_prefix_rest(df.select(name).where(F.col(name).isNotNull()).distinct(), name, prefixes)
    slashed = lambda c: F.contains(c, F.lit("/"))
    full, rest = F.col(name), F.col("rest")
    tokens = F.filter(F.split(rest, r"\s+"), slashed)
    token_parts = F.flatten(F.transform(tokens, lambda t: F.concat(F.split(t, "/"), F.array(_rebuilt(F.split(t, "/"))))))
    none = F.array().cast("array<string>")
    ways = [
        F.array(full), F.array(rest), F.when(slashed(full), F.split(full, "/")).otherwise(none), F.when(slashed(rest), F.split(rest, "/")).otherwise(none),
        F.when(slashed(rest), F.array(_rebuilt(F.split(rest, "/")))).otherwise(none), token_parts,
    ]
    tagged = F.flatten(F.array(*(F.transform(w, _tag(k)) for k, w in enumerate(ways))))
    rows = names.select(name, F.explode(tagged).alias("c")).select(name, "c.*").where("key IS NOT NULL AND key <> ''")
    found = rows.join(index, "key").groupBy(name).agg(F.min_by("id", F.struct("way", "at")).alias("id"), F.min("way").alias("way"))
    return df.join(found, name, "left")


def _tag(way: int):
    return lambda x, i: F.struct(F.lit(way).alias("way"), i.alias("at"), F.lower(F.trim(x)).alias("key"))


def strain_labels(df: DataFrame, curated: str, fallback: str, rules: DataFrame) -> DataFrame:
    """`strain`: by rules (place, kind, word, label) of kind prefixed, exact, contains in this order, else the plain key.

    The curated name counts, or the fallback where it is blank.
    """
    value = F.when(F.trim(F.coalesce(F.col(curated), F.lit(""))) != "", F.col(curated)).otherwise(F.col(fallback))
    rows = df.withColumn("_key", strain_key(value)).withColumn("_long", prefix_key(value))
    exact = rules.where("kind = 'exact'").select(strain_key(F.col("word")).alias("_key"), F.col("label").alias("_exact")).dropDuplicates(["_key"])
    long = rules.where("kind = 'prefixed'").select(prefix_key(F.col("word")).alias("_long"), F.col("label").alias("_prefixed")).dropDuplicates(["_long"])
    parts = rules.where("kind = 'contains'").select("place", strain_key(F.col("word")).alias("word"), "label").where("word <> ''")
    rows = first_contained(rows.join(exact, "_key", "left").join(long, "_long", "left"), "_key", parts)
    return rows.withColumn("strain", F.coalesce("_prefixed", "_exact", "label", "_key")).drop("_key", "_long", "_exact", "_prefixed", "label")


def alias_counts(df: DataFrame, labelled: str, plain: str) -> DataFrame:
    """Labels with more than one plain key: keys, rows, and the dominant key (most rows, then first)."""
    counts = df.groupBy(labelled, plain).agg(F.count("*").alias("n"))
    out = counts.groupBy(labelled).agg(F.count("*").alias("keys"), F.sum("n").alias("rows"), F.min_by(plain, F.struct((-F.col("n")).alias("n"), plain)).alias("dominant"))
    return out.where("keys > 1")


def expand_to_triplets(results: DataFrame, triplets: DataFrame, order: str) -> DataFrame:
    """Results of assays, the last of each, on all of the assays' triplets."""
    rest = [c for c in results.columns if c not in ("assay_id", order)]
    last = results.groupBy("assay_id").agg(F.max_by(F.struct(*rest), order).alias("r")).select("assay_id", "r.*")
    return triplets.select(*TRIPLET).distinct().join(last, "assay_id")


def background(entities: DataFrame, pool: DataFrame, key: str, times: int = 3, seed: int = 42) -> DataFrame:
    """`times` rows of the pool for each entity row, none of them an entity; the same ones for the same seed."""
    n = times * entities.count()
    return pool.join(entities.select(key), key, "left_anti").orderBy(shuffled(F.col(key), seed), key).limit(n)


def annotate(triplets: DataFrame, datasets: DataFrame, selected: DataFrame) -> DataFrame:
    """One row a triplet: ratios and cutoffs in order as text, largest dataset, whether selected, and a comment."""
    listed = datasets.where("cutoff IS NOT NULL").groupBy(*TRIPLET).agg(
        F.array_sort(F.collect_list(F.struct("place", "cutoff", (F.col("pos_qt") / F.greatest("cpds_qt", F.lit(1))).alias("ratio")))).alias("l"),
        F.max("cpds_qt").alias("cpds"), F.max("pos_qt").alias("positives"),
    )
    listed = listed.select(
        *TRIPLET, F.array_join(F.transform("l", lambda x: x["cutoff"].cast("string")), ";").alias("cutoffs"), F.array_join(F.transform("l", lambda x: F.format_string("%.2f", x["ratio"])), ";").alias("ratios"), "cpds", "positives",
        F.try_divide("positives", F.nullif("cpds", F.lit(0))).alias("ratio"),
    )
    out = nullsafe_join(triplets, listed, TRIPLET, "left")
    out = nullsafe_join(out, selected.select(*TRIPLET, "label", "selected_cutoff").withColumn("selected", F.lit(True)), TRIPLET, "left").fillna(False, ["selected"])
    note = (
        F.when(F.col("selected"), F.concat(F.lit("Retained in final selection as "), F.col("label"))).when(F.col("cutoffs").isNull(), "no expert cutoff defined")
        .when(F.col("positives") == 0, "insufficient positives").otherwise("not selected")
    )
    return out.withColumn("comment", note)


def pool_records(rows: DataFrame, pool: str, assay: str, structure: str) -> DataFrame:
    """Assays, structures and active structures of each pool."""
    per = rows.groupBy(pool, structure).agg(F.max("bin").alias("bin"))
    sizes = rows.groupBy(pool).agg(F.count_distinct(assay).alias("n_assays"))
    return per.groupBy(pool).agg(F.count("*").alias("n_mols"), F.sum("bin").alias("n_actives")).join(sizes, pool)


def split_off(base: DataFrame, claimed: DataFrame, key: str) -> DataFrame:
    """Counts of a key less those that other rules claim; keys without any left go."""
    out = base.join(claimed.select(key, F.col("n").alias("_c")), key, "left").withColumn("n", F.col("n") - F.coalesce("_c", F.lit(0))).drop("_c")
    return out.where("n > 0")

