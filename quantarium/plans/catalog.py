"""All queries over the measurement model with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantarium.functions import numeric, text
from quantarium.operators import datasets, graph, joins, ml, profile, selection, stats
from quantarium.session import Scratch
from quantarium.sources.files import last_of_key
from quantarium.sources.measurements import MEASUREMENTS_SQL, THRESHOLDS_SQL, TRIPLET, measurements, table, threshold_rules
from quantarium.streaming import incremental

FLAGSHIP = "flagship_binarize_quantitative"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Limits scaled to the driver's tables, so that every branch has rows.
SMALL = selection.Limits(a_compounds=180, a_positives=20, b_positives=45, merge_union=100, contribution=0.20)
M, T = MEASUREMENTS_SQL, THRESHOLDS_SQL


def query(sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


# SQL shared by the checks: censored values placed, one row a compound, labels at each threshold

FIXED = """d AS (SELECT assay_id, activity_type, unit, direction, target_class, organism, region, compound_id, smiles,
 CASE WHEN direction = 1 AND relation = '<' THEN min(value) OVER w WHEN direction = -1 AND relation = '>' THEN max(value) OVER w ELSE value END AS value
 FROM m WHERE value IS NOT NULL AND direction IS NOT NULL WINDOW w AS (PARTITION BY assay_id, activity_type, unit)),
q AS (SELECT assay_id, activity_type, unit, direction, target_class, organism, region, compound_id, min(smiles) AS smiles, CASE WHEN direction = 1 THEN max(value) ELSE min(value) END AS value
 FROM d GROUP BY assay_id, activity_type, unit, direction, target_class, organism, region, compound_id)"""
LABELLED = f"""{M}, {T}, {FIXED},
b AS (SELECT q.*, place, cutoff, CASE WHEN direction = 1 THEN value >= cutoff ELSE value <= cutoff END::INT AS bin
 FROM q JOIN t ON q.activity_type = t.activity_type AND q.unit = t.unit AND q.target_class = t.target_class)"""
QUALITATIVE = """ql AS (SELECT assay_id, activity_type, unit, compound_id, min(smiles) AS smiles, CASE WHEN bool_or(text_flag = 1) THEN 1 ELSE 0 END AS bin
 FROM m GROUP BY assay_id, activity_type, unit, compound_id HAVING bool_or(text_flag = 1) <> bool_or(text_flag = -1))"""
STATS = "ds AS (SELECT assay_id, activity_type, unit, target_class, organism, region, place, cutoff, count(*) AS cpds_qt, sum(bin) AS pos_qt FROM b GROUP BY assay_id, activity_type, unit, target_class, organism, region, place, cutoff)"


CONSTANTS = ["target_class", "organism", "region"]


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return datasets.labelled(datasets.quantitative(measurements(spark, d), CONSTANTS), threshold_rules(spark))


def _counted(rows: DataFrame) -> DataFrame:
    out = rows.groupBy(*TRIPLET, *CONSTANTS, "place", "cutoff").agg(F.count("*").alias("cpds_qt"), F.sum("bin").alias("pos_qt"))
    return out.withColumn("kind", F.lit("quantitative"))


def _datasets(spark: SparkSession, d: str) -> DataFrame:
    return _counted(_labelled(spark, d))


@query(f"WITH {LABELLED} SELECT assay_id, activity_type, unit, target_class, place, cutoff, count(*) AS cpds, sum(bin)::BIGINT AS positives, avg(bin) AS ratio FROM b GROUP BY assay_id, activity_type, unit, target_class, place, cutoff")
def flagship_binarize_quantitative(spark: SparkSession, d: str) -> DataFrame:
    rows = datasets.labelled(datasets.quantitative(measurements(spark, d), ["target_class"]), threshold_rules(spark))
    return datasets.dataset_stats(rows, [*TRIPLET, "target_class", "place", "cutoff"])


@query("SELECT * FROM (SELECT event_type, n, dense_rank() OVER (ORDER BY n DESC) AS rank, sum(n) OVER (ORDER BY n DESC, event_type ROWS UNBOUNDED PRECEDING) / sum(n) OVER () AS share FROM (SELECT lower(trim(event_type)) AS event_type, count(*) AS n FROM events GROUP BY 1))")
def value_counts_cumulative(spark: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(table(spark, d, "events"), F.lower(F.trim("event_type")).alias("event_type"))


@query(f"WITH {M} SELECT activity_type, unit, n, dense_rank() OVER (ORDER BY n DESC) AS rank, sum(n) OVER (ORDER BY n DESC, activity_type NULLS FIRST, unit NULLS FIRST ROWS UNBOUNDED PRECEDING) / sum(n) OVER () AS share FROM (SELECT activity_type, unit, count(*) AS n FROM m GROUP BY activity_type, unit)")
def dense_rank_frequency(spark: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(measurements(spark, d), "activity_type", "unit")


@query(r"SELECT o_orderpriority, regexp_replace(upper(trim(o_orderpriority)), '[_\s./\\]', '', 'g') AS harmonized, count(*) AS n FROM orders GROUP BY 1, 2")
def harmonize_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderpriority", text.harmonize(F.col("o_orderpriority")).alias("harmonized")).agg(F.count("*").alias("n"))


@query("SELECT CASE p_type WHEN 'ECONOMY' THEN 'BASIC' WHEN 'PROMO' THEN 'BASIC' WHEN 'LARGE' THEN 'BIG' ELSE p_type END AS kind, count(*) AS n FROM part GROUP BY 1")
def synonym_map(spark: SparkSession, d: str) -> DataFrame:
    known = {"ECONOMY": "BASIC", "PROMO": "BASIC", "LARGE": "BIG"}
    return table(spark, d, "part").groupBy(text.lookup(F.col("p_type"), known).alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT CASE round(l_tax, 2) WHEN 0 THEN '>=' WHEN 0.01 THEN '>>' WHEN 0.02 THEN '<=' WHEN 0.03 THEN '<<' WHEN 0.04 THEN '~' WHEN 0.05 THEN 'x' WHEN 0.06 THEN NULL ELSE '=' END AS raw, CASE round(l_tax, 2) WHEN 0 THEN '>' WHEN 0.01 THEN '>' WHEN 0.02 THEN '<' WHEN 0.03 THEN '<' WHEN 0.04 THEN '=' WHEN 0.05 THEN NULL ELSE '=' END AS relation, count(*) AS n FROM lineitem GROUP BY 1, 2")
def relation_normalize(spark: SparkSession, d: str) -> DataFrame:
    tax = F.round("l_tax", 2)
    raw = F
    for v, r in ((0.0, ">="), (0.01, ">>"), (0.02, "<="), (0.03, "<<"), (0.04, "~"), (0.05, "x"), (0.06, None)):
        raw = raw.when(tax == v, F.lit(r))
    return table(spark, d, "lineitem").select(raw.otherwise("=").alias("raw")).groupBy("raw", text.relation(F.col("raw")).alias("relation")).agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, f, g, CASE WHEN least(f, g) = -1 AND greatest(f, g) = 1 THEN NULL WHEN greatest(f, g) = 1 THEN 1 WHEN least(f, g) = -1 THEN -1 ELSE 0 END AS merged, count(*) AS n FROM (SELECT o_orderstatus, CASE WHEN lower(trim(o_orderpriority)) IN ('1-urgent', '2-high') THEN 1 WHEN lower(trim(o_orderpriority)) = '5-low' THEN -1 ELSE 0 END AS f, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN -1 ELSE 0 END AS g FROM orders) GROUP BY 1, 2, 3, 4")
def flag_lookup_and_merge(spark: SparkSession, d: str) -> DataFrame:
    f = text.flag(F.col("o_orderpriority"), ["1-urgent", "2-high"], ["5-low"])
    g = text.flag(F.col("o_orderstatus"), ["F"], ["P"], exact=True)
    rows = table(spark, d, "orders").select("o_orderstatus", f.alias("f"), g.alias("g"))
    return rows.groupBy("o_orderstatus", "f", "g", numeric.merge_flags(F.col("f"), F.col("g")).alias("merged")).agg(F.count("*").alias("n"))


@query(f"WITH {M} SELECT assay_id, activity_type, unit, compound_id, count(*) FILTER (text_flag = 1) AS actives, count(*) FILTER (text_flag = -1) AS inactives FROM m GROUP BY assay_id, activity_type, unit, compound_id HAVING bool_or(text_flag = 1) AND bool_or(text_flag = -1)")
def conflict_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return datasets.conflicting(measurements(spark, d), TRIPLET)


_UNIT_RULES = [("ug.mL-1", "umol.L-1", "standard_value*1000/molecular_weight"), ("nmol.L-1", "umol.L-1", "standard_value/1000"), ("umol.L-1", "umol.L-1", "standard_value"), ("min", "s", "standard_value*60")]
_UNIT_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS v, p_retailprice AS mw, CASE l_linenumber WHEN 1 THEN 'ug.mL-1' WHEN 2 THEN 'nmol.L-1' WHEN 3 THEN 'umol.L-1' WHEN 4 THEN 'min' WHEN 5 THEN 'furlong' END AS u FROM lineitem JOIN part ON l_partkey = p_partkey"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE u WHEN 'ug.mL-1' THEN v * 1000 / mw WHEN 'nmol.L-1' THEN v / 1000 WHEN 'min' THEN v * 60 ELSE v END AS value, CASE WHEN u IN ('ug.mL-1', 'nmol.L-1', 'umol.L-1') THEN 'umol.L-1' WHEN u = 'min' THEN 's' END AS unit FROM ({_UNIT_SQL})")
def unit_conversion(spark: SparkSession, d: str) -> DataFrame:
    unit = F
    for i, u in enumerate(("ug.mL-1", "nmol.L-1", "umol.L-1", "min", "furlong"), 1):
        unit = unit.when(F.col("l_linenumber") == i, u)
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("u", unit)
    value, final = numeric.convert(F.col("l_quantity"), F.col("u"), F.col("p_retailprice"), _UNIT_RULES)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", value.alias("value"), final.alias("unit"))


@query(f"WITH {M} SELECT assay_id, count(p) AS n, min(p) AS low, max(p) AS high FROM (SELECT assay_id, CASE WHEN unit = 'umol.L-1' AND value >= 0 THEN round(greatest(1, least(9, 6 - log10(CASE WHEN value = 0 THEN 1e-10 ELSE value END))), 9) END AS p FROM m) GROUP BY assay_id")
def pscale_clip(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("unit") == "umol.L-1", F.round(numeric.pscale(F.col("value")), 9))
    return measurements(spark, d).groupBy("assay_id").agg(F.count(p).alias("n"), F.min(p).alias("low"), F.max(p).alias("high"))


@query(f"WITH {M} SELECT assay_id, organism, count(*) AS n FROM m WHERE contains(lower(organism), 'nation_1') OR contains(lower(region), 'asia') OR assay_id IN (3, 5, 8) GROUP BY assay_id, organism")
def substring_or_allowlist_filter(spark: SparkSession, d: str) -> DataFrame:
    ids = spark.createDataFrame([(3,), (5,), (8,)], "id long")
    return joins.mentions_or_member(measurements(spark, d), ["organism", "region"], "NATION_1", ids, "assay_id").unionByName(
        joins.without_listed(measurements(spark, d), ids, "assay_id").where("contains(lower(region), 'asia') AND NOT contains(lower(organism), 'nation_1')")
    ).groupBy("assay_id", "organism").agg(F.count("*").alias("n"))


@query(f"WITH {M} SELECT assay_id, count(*) AS n FROM m WHERE assay_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY assay_id")
def denylist_anti(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("id"))
    return joins.without_listed(measurements(spark, d), ids, "assay_id").groupBy("assay_id").agg(F.count("*").alias("n"))


@query(f"WITH {M} SELECT activity_type, unit, direction, text_flag, count(*) AS n FROM m WHERE (value IS NOT NULL OR text_flag <> 0) AND (unit IN ('%', 'umol.L-1') OR unit IS NULL) AND (direction IN (1, -1) OR text_flag IN (1, -1)) GROUP BY activity_type, unit, direction, text_flag")
def value_domain_direction_filters(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d).where(F.col("value").isNotNull() | ~F.col("text_flag").eqNullSafe(F.lit(0)))
    m = m.where(F.col("unit").isin("%", "umol.L-1") | F.col("unit").isNull()).where(F.col("direction").isin(1, -1) | F.col("text_flag").isin(1, -1))
    return m.groupBy("activity_type", "unit", "direction", "text_flag").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_mktsegment, p_brand, n_name FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey")
def left_join_chain(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "lineitem")
    for name, on in (("orders", "l_orderkey = o_orderkey"), ("customer", "o_custkey = c_custkey"), ("part", "l_partkey = p_partkey"), ("supplier", "l_suppkey = s_suppkey"), ("nation", "s_nationkey = n_nationkey")):
        out = out.join(table(spark, d, name), F.expr(on), "left")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus", "c_mktsegment", "p_brand", "n_name")


@query(f"WITH {M}, a AS (SELECT assay_id, activity_type, unit, count(*) AS n FROM m GROUP BY assay_id, activity_type, unit), f AS (SELECT assay_id, activity_type, unit, sum(text_flag) AS flags FROM m GROUP BY assay_id, activity_type, unit) SELECT a.assay_id, a.activity_type, a.unit, n, flags::BIGINT AS flags FROM a JOIN f ON a.assay_id = f.assay_id AND a.activity_type = f.activity_type AND a.unit IS NOT DISTINCT FROM f.unit")
def nullsafe_triplet_join(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d)
    return joins.one_to_one(m.groupBy(*TRIPLET).agg(F.count("*").alias("n")), m.groupBy(*TRIPLET).agg(F.sum("text_flag").alias("flags")), TRIPLET)


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def dictionary_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return last_of_key(table(spark, d, "events").select("user_id", "event_type", "value", "event_id"), ["user_id"], "event_id").select("user_id", "event_type", "value")


@query(f"WITH {M} SELECT assay_id, activity_type, unit, count(*) AS activities, count(*) FILTER (value IS NULL) AS nan_values, count(DISTINCT compound_id) AS cpds, count(*) FILTER (text_flag = 1) AS act_flag, count(*) FILTER (text_flag = -1) AS inact_flag, count(DISTINCT compound_id) / (SELECT count(DISTINCT compound_id) FROM m) AS frac_cs, min(organism) AS organism, min(target_class) AS target_class, min(doc_id) AS doc_id FROM m GROUP BY assay_id, activity_type, unit")
def triplet_summary(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d)
    return profile.triplet_summary(m, ["organism", "target_class", "doc_id"], m.agg(F.count_distinct("compound_id")).first()[0])


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_values FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
def cardinality_violations(spark: SparkSession, d: str) -> DataFrame:
    return profile.violations(table(spark, d, "orders"), "o_custkey", "o_orderstatus")


@query(f"WITH {M} SELECT assay_id, activity_type, unit, min(value) AS low, quantile_cont(value, 0.01) AS p01, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.99) AS p99, max(value) AS high FROM m WHERE value IS NOT NULL GROUP BY assay_id, activity_type, unit")
def percentiles_exact(spark: SparkSession, d: str) -> DataFrame:
    return profile.percentiles(measurements(spark, d))


@query(f"WITH {M} SELECT assay_id, activity_type, unit, count(*) FILTER (relation = '=') AS equal, count(*) FILTER (relation = '<') AS lower, count(*) FILTER (relation = '>') AS higher FROM m GROUP BY assay_id, activity_type, unit")
def relation_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.relation_counts(measurements(spark, d))


@query(f"WITH {M} SELECT assay_id, count(*) AS n, count(*) FILTER (value IS NULL) AS nulls, count(*) FILTER (value IS NULL) / count(*) AS share FROM m GROUP BY assay_id HAVING count(*) FILTER (value IS NULL) > 0")
def null_share(spark: SparkSession, d: str) -> DataFrame:
    return profile.null_share(measurements(spark, d), "assay_id")


@query(f"WITH {M} SELECT assay_id, activity_type, count(DISTINCT unit) AS units FROM m GROUP BY assay_id, activity_type HAVING bool_or(unit IS NULL) AND count(DISTINCT unit) > 0")
def ambiguous_units(spark: SparkSession, d: str) -> DataFrame:
    return profile.ambiguous_units(measurements(spark, d))


@query(f"WITH {M}, {QUALITATIVE} SELECT assay_id, activity_type, unit, count(*) AS cpds, sum(bin)::BIGINT AS positives FROM ql GROUP BY assay_id, activity_type, unit")
def qualitative_labels(spark: SparkSession, d: str) -> DataFrame:
    return datasets.qualitative(measurements(spark, d), TRIPLET).groupBy(*TRIPLET).agg(F.count("*").alias("cpds"), F.sum("bin").alias("positives"))


@query(f"WITH {LABELLED}, {QUALITATIVE}, s AS (SELECT DISTINCT assay_id, activity_type, unit, place, cutoff FROM b), x AS (SELECT s.*, ql.compound_id FROM s JOIN ql ON s.assay_id = ql.assay_id AND s.activity_type = ql.activity_type AND s.unit = ql.unit WHERE ql.bin = 0 AND NOT EXISTS (SELECT 1 FROM q WHERE q.assay_id = s.assay_id AND q.activity_type = s.activity_type AND q.unit = s.unit AND q.compound_id = ql.compound_id)) SELECT assay_id, activity_type, unit, place, cutoff, origin, count(*) AS cpds, sum(bin)::BIGINT AS positives FROM (SELECT assay_id, activity_type, unit, place, cutoff, bin, 'quantitative' AS origin FROM b UNION ALL SELECT assay_id, activity_type, unit, place, cutoff, 0, 'qualitative' FROM x) GROUP BY assay_id, activity_type, unit, place, cutoff, origin")
def mixed_union(spark: SparkSession, d: str) -> DataFrame:
    members = datasets.compounds(measurements(spark, d), CONSTANTS)
    rows = datasets.mixed(datasets.labelled(datasets.actives(members, CONSTANTS), threshold_rules(spark)), datasets.flagged(members, TRIPLET), TRIPLET)
    return rows.groupBy(*TRIPLET, "place", "cutoff", "origin").agg(F.count("*").alias("cpds"), F.sum("bin").alias("positives"))


_CLASSIFIED = f"""{LABELLED}, {QUALITATIVE}, tr AS (SELECT DISTINCT assay_id, activity_type, unit, target_class FROM m),
sp AS (SELECT tr.*, place, cutoff FROM tr LEFT JOIN t ON tr.activity_type = t.activity_type AND tr.unit = t.unit AND tr.target_class = t.target_class),
nq AS (SELECT assay_id, activity_type, unit, place, count(*) AS cpds_qt, sum(bin) AS pos_qt FROM b GROUP BY assay_id, activity_type, unit, place),
nl AS (SELECT assay_id, activity_type, unit, count(*) AS cpds_ql, sum(bin) AS pos_ql FROM ql GROUP BY assay_id, activity_type, unit),
ad AS (SELECT assay_id, activity_type, unit, count(*) AS added FROM ql WHERE bin = 0 AND NOT EXISTS (SELECT 1 FROM q WHERE q.assay_id = ql.assay_id AND q.activity_type = ql.activity_type AND q.unit IS NOT DISTINCT FROM ql.unit AND q.compound_id = ql.compound_id) GROUP BY assay_id, activity_type, unit),
c AS (SELECT sp.*, coalesce(cpds_qt, 0) AS cpds_qt, coalesce(pos_qt, 0)::BIGINT AS pos_qt, coalesce(cpds_ql, 0) AS cpds_ql, coalesce(pos_ql, 0)::BIGINT AS pos_ql, coalesce(added, 0) AS added FROM sp
 LEFT JOIN nq ON sp.assay_id = nq.assay_id AND sp.activity_type = nq.activity_type AND sp.unit IS NOT DISTINCT FROM nq.unit AND sp.place = nq.place
 LEFT JOIN nl ON sp.assay_id = nl.assay_id AND sp.activity_type = nl.activity_type AND sp.unit IS NOT DISTINCT FROM nl.unit
 LEFT JOIN ad ON sp.assay_id = ad.assay_id AND sp.activity_type = ad.activity_type AND sp.unit IS NOT DISTINCT FROM ad.unit),
k AS (SELECT assay_id, activity_type, unit, target_class, place, cutoff, cpds_qt, pos_qt, cpds_ql, pos_ql, CASE WHEN cpds_qt > 0 AND added > 0 THEN 'mixed' WHEN cpds_qt > 0 THEN 'quantitative' WHEN cpds_ql > 0 THEN 'qualitative' ELSE 'none' END AS kind, CASE WHEN cpds_qt > 0 AND added > 0 THEN cpds_qt + added ELSE 0 END AS cpds_mx FROM c)"""


@query(f"WITH {_CLASSIFIED} SELECT * FROM k")
def dataset_classify(spark: SparkSession, d: str) -> DataFrame:
    return datasets.classify(measurements(spark, d), threshold_rules(spark), ["target_class"])


@query(f"WITH {M}, s AS (SELECT DISTINCT assay_id, compound_id FROM m), z AS (SELECT assay_id, count(*) AS size FROM s GROUP BY assay_id), p AS (SELECT *, row_number() OVER (ORDER BY size DESC, assay_id) AS place FROM z), f AS (SELECT compound_id, min(place) AS place FROM s JOIN p USING (assay_id) GROUP BY compound_id), n AS (SELECT place, count(*) AS new FROM f GROUP BY place) SELECT assay_id, p.place, size, sum(coalesce(new, 0)) OVER (ORDER BY p.place ROWS UNBOUNDED PRECEDING)::BIGINT AS covered FROM p LEFT JOIN n ON p.place = n.place")
def running_distinct_coverage(spark: SparkSession, d: str) -> DataFrame:
    return profile.running_coverage(measurements(spark, d), "assay_id", "compound_id")


@query(f"WITH {M}, s AS (SELECT DISTINCT assay_id || '|' || activity_type || '|' || coalesce(unit, '') AS k, compound_id FROM m), z AS (SELECT k, count(*) AS n FROM s GROUP BY k HAVING count(*) >= 50), o AS (SELECT s.*, n FROM s JOIN z USING (k)) SELECT a.k AS key_1, b.k AS key_2, a.n AS n_1, b.n AS n_2, count(*) AS shared, count(*) / least(a.n, b.n) AS share FROM o a JOIN o b ON a.compound_id = b.compound_id AND a.k <= b.k GROUP BY a.k, b.k, a.n, b.n")
def pairwise_overlap(spark: SparkSession, d: str) -> DataFrame:
    return joins.overlaps(measurements(spark, d).withColumn("key", text.encode_key(*map(F.col, TRIPLET))), "key", "compound_id", least=50)


_EDGES = f"{LABELLED}, r AS (SELECT assay_id * 10 + CASE activity_type WHEN 'MIC' THEN 1 WHEN 'IC50' THEN 2 ELSE 3 END AS k, compound_id AS x, bin AS l FROM b WHERE place = CASE WHEN unit = '%' THEN 1 ELSE 2 END), e AS (SELECT a.k AS key_1, c.k AS key_2, avg((a.l = c.l)::INT) AS agreement, count(*) AS n FROM r a JOIN r c ON a.x = c.x AND a.k < c.k GROUP BY a.k, c.k HAVING count(*) >= 5)"


def _endpoints(spark: SparkSession, d: str) -> DataFrame:
    """Labels at each endpoint's reference threshold; an endpoint's key is its assay and a digit for the activity type."""
    kind = F.when(F.col("activity_type") == "MIC", 1).when(F.col("activity_type") == "IC50", 2).otherwise(3)
    rows = _labelled(spark, d).where(F.col("place") == F.when(F.col("unit") == "%", 1).otherwise(2))
    return rows.select((F.col("assay_id") * 10 + kind).alias("key"), "compound_id", "bin")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return joins.concordance(_endpoints(spark, d), "key", "compound_id", "bin", 5)


@query(f"WITH {_EDGES} SELECT * FROM e")
def pair_concordance(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


@query(f"WITH {M}, s AS (SELECT DISTINCT target_class AS bucket, compound_id FROM m), c AS (SELECT compound_id, count(*) AS n FROM s GROUP BY compound_id) SELECT bucket, count(*) AS members, count(*) FILTER (n = 1) AS exclusive, count(*) / (SELECT count(*) FROM c) AS share FROM s JOIN c USING (compound_id) GROUP BY bucket")
def exclusive_sets(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d).select(F.col("target_class").alias("bucket"), "compound_id").distinct()
    return profile.bucket_shares(m, "bucket", "compound_id")


@query(f"WITH {M}, a AS (SELECT DISTINCT compound_id FROM m WHERE activity_type = 'MIC' AND region = 'ASIA'), c AS (SELECT DISTINCT compound_id FROM m WHERE activity_type = 'IC50' AND region = 'EUROPE') SELECT (SELECT count(*) FROM (FROM a INTERSECT FROM c)) AS common, (SELECT count(*) FROM (FROM a EXCEPT FROM c)) AS only_first, (SELECT count(*) FROM (FROM a UNION FROM c)) AS either_one")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    m = measurements(spark, d)
    a, b = (m.where((F.col("activity_type") == t) & (F.col("region") == g)).select("compound_id").distinct() for t, g in (("MIC", "ASIA"), ("IC50", "EUROPE")))
    one = lambda df, n: df.agg(F.count("*").alias(n))
    parts = one(a.intersect(b), "common"), one(a.subtract(b), "only_first"), one(a.union(b).distinct(), "either_one")
    return parts[0].join(parts[1]).join(parts[2])  # three single rows


@query(f"WITH {T}, a AS (SELECT activity_type, unit, target_class, list(cutoff ORDER BY place) AS c FROM t GROUP BY ALL) SELECT activity_type, unit, target_class, array_to_string(c, ';') AS listed, CASE WHEN unit = '%' THEN c[1] ELSE c[2] END AS reference, c[1] AS low, c[2] AS middle, c[3] AS high FROM a")
def reference_threshold_pick(spark: SparkSession, d: str) -> DataFrame:
    rules = threshold_rules(spark).withColumn("levels", numeric.threshold_levels(F.col("thresholds")))
    return rules.select("activity_type", "unit", "target_class", F.concat_ws(";", F.col("thresholds").cast("array<string>")).alias("listed"), numeric.reference_threshold(F.col("thresholds"), F.col("unit")).alias("reference"), "levels.low", "levels.middle", "levels.high")


_A = f"cpds_qt >= {SMALL.a_compounds} AND pos_qt >= {SMALL.a_positives} AND pos_qt < 0.5 * cpds_qt"
_B = f"pos_qt >= {SMALL.b_positives} AND pos_qt >= 0.5 * cpds_qt"


@query(f"WITH {LABELLED}, {STATS}, g AS (SELECT *, bool_or({_A}) OVER w AS any_a, bool_or({_B}) OVER w AS any_b FROM ds WINDOW w AS (PARTITION BY assay_id, activity_type, unit)) SELECT assay_id, activity_type, unit, place, cutoff, cpds_qt, pos_qt::BIGINT AS pos_qt, CASE WHEN any_a THEN 'A' ELSE 'B' END AS label FROM g WHERE (any_a AND {_A}) OR (NOT any_a AND any_b AND {_B})")
def hierarchical_assignment(spark: SparkSession, d: str) -> DataFrame:
    return selection.hierarchical(_datasets(spark, d), SMALL).select(*TRIPLET, "place", "cutoff", "cpds_qt", "pos_qt", "label")


_SCORED = f"{LABELLED}, {STATS}, sc AS (SELECT assay_id, activity_type, unit, place, cutoff, 0.5 + pos_qt / cpds_qt AS score, place = CASE WHEN unit = '%' THEN 1 ELSE 2 END AS is_reference FROM ds)"


@query(f"WITH {_SCORED}, x AS (SELECT assay_id, activity_type, unit, arg_max(cutoff, (score, -place)) AS best_cutoff, max(score) AS best_score, max(score) FILTER (is_reference) AS ref_score, max(cutoff) FILTER (is_reference) AS ref_cutoff, count(*) AS n FROM sc GROUP BY assay_id, activity_type, unit) SELECT assay_id, activity_type, unit, best_cutoff, best_score, ref_score, CASE WHEN ref_score IS NOT NULL AND best_score - ref_score <= 0.1 THEN ref_cutoff ELSE best_cutoff END AS selected_cutoff FROM x WHERE n >= 2 AND best_score > 0.7")
def select_best_or_reference(spark: SparkSession, d: str) -> DataFrame:
    rows = _datasets(spark, d).withColumn("score", F.lit(0.5) + F.col("pos_qt") / F.col("cpds_qt")).withColumn("is_reference", F.col("place") == F.when(F.col("unit") == "%", 1).otherwise(2))
    return selection.select_threshold(rows.select(*TRIPLET, "place", "cutoff", "score", "is_reference"), TRIPLET, selection.Limits())


_GROUPS = f"{M}, s AS (SELECT DISTINCT organism, activity_type, unit, direction, assay_id, compound_id FROM m WHERE target_class = 'ORGANISM' AND direction IS NOT NULL)"


def _group_members(spark: SparkSession, d: str) -> DataFrame:
    return measurements(spark, d).where("target_class = 'ORGANISM' AND direction IS NOT NULL").select("organism", "activity_type", "unit", "direction", "assay_id", "compound_id").distinct()


@query(f"WITH {_GROUPS}, g AS (SELECT organism, activity_type, unit, direction, count(DISTINCT assay_id) AS n_assays, count(DISTINCT compound_id) AS n_compounds, string_agg(DISTINCT assay_id::VARCHAR, ';' ORDER BY assay_id::VARCHAR) AS assay_keys FROM s GROUP BY organism, activity_type, unit, direction HAVING count(DISTINCT assay_id) > 1 AND count(DISTINCT compound_id) >= 100) SELECT *, 'M_ORG' || (row_number() OVER (ORDER BY n_compounds DESC, organism, activity_type) - 1) AS name FROM g")
def merge_groups_union(spark: SparkSession, d: str) -> DataFrame:
    groups = selection.merge_groups(_group_members(spark, d), ["organism", "activity_type", "unit", "direction"], ["assay_id"], SMALL.merge_union)
    return selection.named(groups, "M_ORG", [F.desc("n_compounds"), "organism", "activity_type"])


@query("WITH c AS (SELECT l_suppkey, p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_brand) SELECT l_suppkey, arg_max(p_brand, (n, length(p_brand), p_brand)) AS mode FROM c GROUP BY l_suppkey")
def mode_with_ties(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return profile.mode_with_ties(rows, "l_suppkey", "p_brand")


@query(f"""WITH {_GROUPS}, u1 AS (SELECT organism, activity_type, unit, direction, count(DISTINCT compound_id) AS u FROM s GROUP BY organism, activity_type, unit, direction),
z AS (SELECT organism, activity_type, unit, direction, assay_id, count(*) AS n FROM s GROUP BY organism, activity_type, unit, direction, assay_id),
p1 AS (SELECT z.*, n >= 0.2 * u AS ok FROM z JOIN u1 USING (organism, activity_type, unit, direction)),
rj AS (SELECT s.* FROM s JOIN p1 USING (organism, activity_type, unit, direction, assay_id) WHERE NOT ok),
u2 AS (SELECT organism, activity_type, unit, direction, count(DISTINCT compound_id) AS u FROM rj GROUP BY organism, activity_type, unit, direction HAVING count(DISTINCT assay_id) >= 2),
p2 AS (SELECT organism, activity_type, unit, direction, assay_id FROM z JOIN u2 USING (organism, activity_type, unit, direction) JOIN p1 USING (organism, activity_type, unit, direction, assay_id) WHERE NOT p1.ok AND z.n >= 0.2 * u),
f AS (SELECT p1.*, CASE WHEN ok THEN 1 WHEN p2.assay_id IS NOT NULL THEN 2 ELSE 0 END AS pass FROM p1 LEFT JOIN p2 USING (organism, activity_type, unit, direction, assay_id))
SELECT organism, activity_type, unit, direction, assay_id, n, CASE WHEN count(*) OVER (PARTITION BY organism, activity_type, unit, direction, pass) >= 2 THEN pass ELSE 0 END AS pass FROM f""")
def fractional_two_pass(spark: SparkSession, d: str) -> DataFrame:
    return selection.fractional(_group_members(spark, d), ["organism", "activity_type", "unit", "direction"], "assay_id", SMALL.contribution)


_REASONS = ["group_qualified", "insufficient_compounds", "insufficient_positives", "successfully_merged", "insufficient_compatible_assays"]


@query(f"WITH e AS (SELECT user_id, event_id AS step, ['{"', '".join(_REASONS)}'][(event_id % 5 + 1)::INT] AS reason FROM events) SELECT user_id, arg_max(reason, (CASE reason WHEN 'successfully_merged' THEN 2 WHEN 'group_qualified' THEN 0 ELSE 1 END, -step)) AS reason FROM e GROUP BY user_id")
def failure_reason_resolve(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    reasons = F.array(*map(F.lit, _REASONS))
    return selection.resolved_reasons(e.select("user_id", F.col("event_id").alias("step"), F.get(reasons, (F.col("event_id") % 5).cast("int")).alias("reason")), "user_id")


@query(f"WITH {LABELLED}, p AS (SELECT activity_type, unit, place, compound_id, max(bin) AS bin, min(smiles) AS smiles FROM b WHERE target_class = 'ORGANISM' GROUP BY activity_type, unit, place, compound_id) SELECT activity_type, unit, place, smiles, max(bin) AS bin, arg_max(compound_id, (bin, -compound_id)) AS compound_id FROM p GROUP BY activity_type, unit, place, smiles")
def pooled_any_active(spark: SparkSession, d: str) -> DataFrame:
    return graph.pooled(_labelled(spark, d).where("target_class = 'ORGANISM'"), ["activity_type", "unit", "place"]).select("activity_type", "unit", "place", "smiles", "bin", "compound_id")


@query(f"WITH {LABELLED} SELECT smiles, count(*) AS n FROM (SELECT DISTINCT activity_type, unit, place, target_class, smiles FROM b WHERE bin = 1) GROUP BY smiles")
def occurrence_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.occurrences(_labelled(spark, d).where("bin = 1").select("activity_type", "unit", "place", "target_class", "smiles", "bin").distinct())


@query(f"WITH {M}, f AS (SELECT CASE WHEN direction = -1 THEN 'DR' ELSE 'SP' END AS bucket, activity_type, unit, compound_id, text_flag FROM m WHERE direction IS NOT NULL) SELECT CASE WHEN bucket = 'DR' AND activity_type LIKE 'MIC%' THEN 'DR_growth_MIC' WHEN bucket = 'DR' THEN 'DR_other_potency' WHEN unit = 'mm' THEN 'SP_zone' ELSE 'SP_percent' END AS pool, count(*) AS n, count(DISTINCT compound_id) AS cpds FROM f GROUP BY 1")
def family_pool(spark: SparkSession, d: str) -> DataFrame:
    rows = measurements(spark, d).where("direction IS NOT NULL").withColumn("bucket", F.when(F.col("direction") == -1, "DR").otherwise("SP"))
    return graph.STRATEGIES["family"](rows).groupBy("pool").agg(F.count("*").alias("n"), F.count_distinct("compound_id").alias("cpds"))


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("place"), F.posexplode("embedding").alias("key", "value"))


_VECTORS = "v AS (SELECT vec_id AS place, i AS key, embedding[i + 1] AS value FROM embeddings, (SELECT unnest(range((SELECT max(len(embedding)) FROM embeddings)))::INT AS i))"


@query(f"WITH {_VECTORS}, r AS (SELECT *, rank() OVER (PARTITION BY key ORDER BY value) + (count(*) OVER (PARTITION BY key, value) - 1) / 2 AS r FROM v) SELECT a.key AS key_1, b.key AS key_2, round(corr(a.r, b.r), 9) AS rho FROM r a JOIN r b ON a.place = b.place AND a.key < b.key GROUP BY a.key, b.key")
def spearman_rank(spark: SparkSession, d: str) -> DataFrame:
    return stats.spearman(_vectors(spark, d)).withColumn("rho", F.round("rho", 9))


@query(f"WITH {_VECTORS}, r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY value DESC, place) AS k, count(*) OVER (PARTITION BY key) AS n FROM v), o AS (SELECT * FROM r WHERE k <= 100), x AS (SELECT a.key AS key_1, b.key AS key_2, count(*) AS m FROM o a JOIN o b ON a.place = b.place AND a.key < b.key GROUP BY a.key, b.key), ks AS (SELECT DISTINCT key, n FROM r) SELECT a.key AS key_1, b.key AS key_2, coalesce(m, 0) AS m, round((coalesce(m, 0) - 10000 / a.n) / (100 - 10000 / a.n), 9) AS overlap FROM ks a JOIN ks b ON a.key < b.key LEFT JOIN x ON x.key_1 = a.key AND x.key_2 = b.key")
def topn_hit_overlap(spark: SparkSession, d: str) -> DataFrame:
    return stats.top_overlap(_vectors(spark, d), 100).withColumn("overlap", F.round("overlap", 9))


@query("WITH s AS (SELECT i AS key, embedding[i + 1] AS score, (label < 5)::INT AS bin FROM embeddings, (SELECT unnest(range((SELECT max(len(embedding)) FROM embeddings)))::INT AS i)), r AS (SELECT *, rank() OVER (PARTITION BY key ORDER BY score) + (count(*) OVER (PARTITION BY key, score) - 1) / 2 AS r FROM s) SELECT key, round((sum(r) FILTER (bin = 1) - sum(bin) * (sum(bin) + 1) / 2) / (sum(bin) * sum(1 - bin)), 9) AS auroc, sum(bin)::BIGINT AS positives, sum(1 - bin)::BIGINT AS negatives FROM r GROUP BY key")
def auroc_rank_formula(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "embeddings").select((F.col("label") < 5).cast("int").alias("bin"), F.posexplode("embedding").alias("key", "score"))
    return stats.auroc(s, ["key"]).withColumn("auroc", F.round("auroc", 9))


@query("SELECT vec_id, label FROM embeddings ORDER BY md5(vec_id::VARCHAR || '#42'), vec_id LIMIT 100")
def deterministic_sample(spark: SparkSession, d: str) -> DataFrame:
    return stats.sample(table(spark, d, "embeddings").select("vec_id", "label"), "vec_id", 100)


@query("SELECT vec_id, bin, ((row_number() OVER (PARTITION BY bin ORDER BY md5(vec_id::VARCHAR || '#42'), vec_id) - 1) % 4)::INT AS fold FROM (SELECT vec_id, (label < 3)::INT AS bin FROM embeddings)")
def stratified_folds(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", (F.col("label") < 3).cast("int").alias("bin"))
    return stats.folds(rows, [], "vec_id")


@query(f"WITH {LABELLED}, r AS (SELECT assay_id, activity_type, place, compound_id, bin, sum(bin) OVER w AS p, count(*) OVER w AS n, row_number() OVER (PARTITION BY assay_id, activity_type, place, bin ORDER BY md5(compound_id::VARCHAR || '#42'), compound_id) AS k FROM b WHERE direction = -1 WINDOW w AS (PARTITION BY assay_id, activity_type, place)) SELECT assay_id, activity_type, place, compound_id, bin FROM r WHERE bin = 1 OR p >= 0.05 * n OR k <= floor(p / 0.1) - p")
def downsample_negatives(spark: SparkSession, d: str) -> DataFrame:
    rows = _labelled(spark, d).where("direction = -1").select("assay_id", "activity_type", "place", "compound_id", "bin")
    return stats.downsampled(rows, ["assay_id", "activity_type", "place"], "compound_id")


_ROOTS = f"""{_EDGES}, ed AS (SELECT key_1 AS a, key_2 AS b FROM e WHERE agreement >= 0.95 UNION SELECT key_2, key_1 FROM e WHERE agreement >= 0.95),
reach AS (SELECT a AS node, a AS other FROM ed UNION SELECT reach.node, ed.b FROM reach JOIN ed ON reach.other = ed.a)"""


@query(f"WITH RECURSIVE {_ROOTS} SELECT node, min(other) AS root FROM reach GROUP BY node")
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    edges = _edges(spark, d).where("agreement >= 0.95").select(F.col("key_1").alias("u"), F.col("key_2").alias("v"))
    return graph.components(edges, Scratch(spark, "components"))


@query(f"WITH {_EDGES}, g AS (SELECT k AS key, k % 10 AS \"group\", count(*) AS size FROM r GROUP BY k), s AS (SELECT key_1 AS key, key_2 AS other, agreement, n FROM e UNION ALL SELECT key_2, key_1, agreement, n FROM e), x AS (SELECT s.key, round(sum(agreement * n) / sum(n), 12) AS mean FROM s JOIN g a ON s.key = a.key JOIN g o ON s.other = o.key AND a.\"group\" = o.\"group\" GROUP BY s.key) SELECT \"group\", arg_max(g.key, (coalesce(mean, -1), size, -g.key)) AS reference FROM g LEFT JOIN x USING (key) GROUP BY \"group\"")
def weighted_medoid(spark: SparkSession, d: str) -> DataFrame:
    members = _endpoints(spark, d).groupBy("key", (F.col("key") % 10).alias("group")).agg(F.count("*").alias("size"))
    return graph.references(_edges(spark, d), members)


_SUMS = "v AS (SELECT vec_id AS place, i AS key, embedding[i + 1] + embedding[(i + 1) % len(embedding) + 1] AS value FROM embeddings, (SELECT unnest(range((SELECT max(len(embedding)) FROM embeddings)))::INT AS i))"


def _hits(top: int) -> str:
    return (
        f"o{top} AS (SELECT * FROM r WHERE k <= {top}), x{top} AS (SELECT a.key AS key_1, b.key AS key_2, count(*) AS m FROM o{top} a JOIN o{top} b ON a.place = b.place AND a.key < b.key GROUP BY ALL), "
        f"h{top} AS (SELECT a.key AS key_1, b.key AS key_2, (coalesce(m, 0) - {top * top}.0 / a.n) / ({top} - {top * top}.0 / a.n) AS overlap FROM ks a JOIN ks b ON a.key < b.key LEFT JOIN x{top} x ON x.key_1 = a.key AND x.key_2 = b.key)"
    )


@query(
    f"WITH RECURSIVE {_SUMS}, r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY value DESC, place) AS k, count(*) OVER (PARTITION BY key) AS n, rank() OVER (PARTITION BY key ORDER BY value) + (count(*) OVER (PARTITION BY key, value) - 1) / 2 AS r FROM v), "
    f"ks AS (SELECT DISTINCT key, n FROM r), {_hits(100)}, {_hits(20)}, rho AS (SELECT a.key AS key_1, b.key AS key_2, corr(a.r, b.r) AS rho FROM r a JOIN r b ON a.place = b.place AND a.key < b.key GROUP BY ALL), "
    "c AS (SELECT vec_id AS place, key FROM embeddings JOIN ks ON vec_id % 4 = (key // 2) % 4), sz AS (SELECT key, count(*) AS n FROM c GROUP BY key), co AS (SELECT a.key AS key_1, b.key AS key_2, count(*) AS m FROM c a JOIN c b ON a.place = b.place AND a.key < b.key GROUP BY ALL), "
    "al AS (SELECT rho.key_1 AS a, rho.key_2 AS b FROM rho JOIN h100 USING (key_1, key_2) JOIN h20 USING (key_1, key_2) JOIN co USING (key_1, key_2) JOIN sz x ON x.key = rho.key_1 JOIN sz y ON y.key = rho.key_2 WHERE (rho + h100.overlap + h20.overlap) / 3 > 0.2 AND m / least(x.n, y.n) > 0.2), "
    "nb AS (SELECT a, list(b) AS near FROM (SELECT a, b FROM al UNION ALL SELECT b, a FROM al) GROUP BY a), p AS (SELECT key, row_number() OVER (ORDER BY key) AS p FROM ks), "
    "w AS (SELECT 0::BIGINT AS p, []::INT[] AS kept UNION ALL SELECT p.p, CASE WHEN list_has_any(w.kept, coalesce(nb.near, []::INT[])) THEN w.kept ELSE list_append(w.kept, p.key) END FROM w JOIN p ON p.p = w.p + 1 LEFT JOIN nb ON nb.a = p.key) "
    "SELECT key AS name, list_contains((SELECT kept FROM w ORDER BY p DESC LIMIT 1), key) AS kept FROM p"
)
def greedy_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Rank correlation, two top overlaps, and the overlap of compounds decide who is alike; neighbours of these vectors share a part."""
    e = table(spark, d, "embeddings")
    v = e.select(F.col("vec_id").alias("place"), F.posexplode(F.zip_with("embedding", F.concat(F.slice("embedding", 2, F.size("embedding") - 1), F.slice("embedding", 1, 1)), lambda a, b: a + b)).alias("key", "value"))
    members = v.select("key", "place").where("place % 4 = cast(floor(key / 2) as int) % 4")
    shared = joins.overlaps(members, "key", "place").select("key_1", "key_2", "share")
    pairs = stats.spearman(v).join(stats.top_overlap(v, 100).select("key_1", "key_2", F.col("overlap").alias("top_100")), ["key_1", "key_2"]).join(stats.top_overlap(v, 20).select("key_1", "key_2", F.col("overlap").alias("top_20")), ["key_1", "key_2"])
    pairs = pairs.join(shared, ["key_1", "key_2"]).select("key_1", "key_2", ((F.col("rho") + F.col("top_100") + F.col("top_20")) / 3).alias("score"), "share")
    names = v.select(F.col("key").alias("name")).distinct().withColumn("place", F.col("name"))
    return selection.greedy_distinct(names, pairs, selection.Limits(correlation=0.2))


@query()
def rf_cross_validation(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("features"), (F.col("label") < 3).cast("int").alias("bin"))
    return ml.summary(ml.cross_validated(rows, "vec_id"))


@query()
def rf_score(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("features"), (F.col("label") < 3).cast("int").alias("bin"))
    return ml.predict(ml.fit(rows), rows).select("vec_id", "bin", "prob")


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}, 100 * count(*) FILTER (event_type = '{t}') / greatest(count(*) FILTER (event_type IN ('click', 'view', 'error')), 1) AS pct_{t}" for t in ("click", "view", "error")) + " FROM events GROUP BY user_id")
def pivot_percent(spark: SparkSession, d: str) -> DataFrame:
    return profile.pivot_shares(table(spark, d, "events"), "user_id", "event_type", ["click", "view", "error"])


@query("SELECT CASE WHEN s > 0 AND s <= 0.6 THEN 0 WHEN s > 0.6 AND s <= 0.7 THEN 1 WHEN s > 0.7 AND s <= 1.01 THEN 2 END AS bin, floor(s * 10)::BIGINT AS tenth, count(*) AS n FROM (SELECT l_quantity / 50 AS s FROM lineitem) GROUP BY 1, 2")
def binning(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").select((F.col("l_quantity") / 50).alias("s"))
    return s.groupBy(numeric.right_closed_bin(F.col("s"), [0, 0.6, 0.7, 1.01]).alias("bin"), F.floor(F.col("s") * 10).alias("tenth")).agg(F.count("*").alias("n"))


_COMMENT_SQL = f"WITH {_CLASSIFIED}, c2 AS (SELECT CASE WHEN kind = 'none' THEN 'no_activity_data' WHEN kind = 'qualitative' THEN 'qualitative_only' WHEN cutoff IS NULL THEN 'no_cutoff' WHEN {_A} THEN 'other' WHEN cpds_qt < {SMALL.a_compounds} THEN 'too_few_compounds' WHEN pos_qt < {SMALL.a_positives} THEN 'too_few_positives' ELSE 'ratio_out_of_range' END AS category FROM k) SELECT category, count(*) AS n FROM c2 GROUP BY category"


@query(_COMMENT_SQL)
def priority_categorize(spark: SparkSession, d: str) -> DataFrame:
    rows = datasets.classify(measurements(spark, d), threshold_rules(spark), ["target_class"])
    return rows.groupBy(text.first_category(selection.comment(limits=SMALL), text.REASONS).alias("category")).agg(F.count("*").alias("n"))


@query(f"WITH {M} SELECT coalesce(region, 'ALL') AS region, coalesce(target_class, 'ALL') AS target_class, count(*) AS n, count(DISTINCT compound_id) AS cpds FROM m GROUP BY ROLLUP (region, target_class)")
def report_rollup(spark: SparkSession, d: str) -> DataFrame:
    out = measurements(spark, d).rollup("region", "target_class").agg(F.count("*").alias("n"), F.count_distinct("compound_id").alias("cpds"))
    return out.fillna("ALL", ["region", "target_class"])


@query(f"WITH {LABELLED}, {STATS}, s0 AS (SELECT DISTINCT assay_id, activity_type, unit FROM m), s1 AS (SELECT DISTINCT assay_id, activity_type, unit FROM q), s2 AS (SELECT DISTINCT assay_id, activity_type, unit FROM b), s3 AS (SELECT DISTINCT assay_id, activity_type, unit FROM ds WHERE {_A}) SELECT 0 AS step, 'all' AS stage, count(*) AS n FROM s0 UNION ALL SELECT 1, 'with values', count(*) FROM s1 UNION ALL SELECT 2, 'with thresholds', count(*) FROM s2 UNION ALL SELECT 3, 'condition A', count(*) FROM s3")
def funnel_counts(spark: SparkSession, d: str) -> DataFrame:
    members = datasets.compounds(measurements(spark, d), CONSTANTS)
    rows = datasets.labelled(datasets.actives(members, CONSTANTS), threshold_rules(spark))
    stages = [("all", members), ("with values", members.where("low IS NOT NULL")), ("with thresholds", rows), ("condition A", _counted(rows).where(selection.condition_a(SMALL)))]
    return profile.funnel(stages, TRIPLET)


@query(f"WITH {LABELLED}, {STATS} SELECT activity_type, count(*) AS n, sum(cpds_qt)::BIGINT AS cpds, sum(pos_qt)::BIGINT AS positives, round(avg(pos_qt / cpds_qt), 9) AS mean_ratio, round(avg(0.5 + pos_qt / cpds_qt), 9) AS score_mean, round(quantile_cont(0.5 + pos_qt / cpds_qt, 0.5), 9) AS score_median, round(stddev_samp(0.5 + pos_qt / cpds_qt), 9) AS score_sd, min(0.5 + pos_qt / cpds_qt) AS score_min, max(0.5 + pos_qt / cpds_qt) AS score_max FROM ds GROUP BY activity_type")
def condition_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = _datasets(spark, d).withColumns({"cpds": F.col("cpds_qt"), "positives": F.col("pos_qt"), "ratio": F.col("pos_qt") / F.col("cpds_qt")}).withColumn("score", F.lit(0.5) + F.col("ratio"))
    return profile.condition_stats(rows, "activity_type").withColumns({c: F.round(c, 9) for c in ("mean_ratio", "score_mean", "score_median", "score_sd")})


_KEYS_SQL = "SELECT o_custkey, o_orderkey || '|' || o_orderstatus || '|' || CASE WHEN o_orderpriority LIKE '%NOT%' THEN '' ELSE o_orderpriority END AS k FROM orders"


@query(f"WITH g AS (SELECT o_custkey, string_agg(k, ';' ORDER BY k) AS keys FROM ({_KEYS_SQL}) GROUP BY o_custkey), x AS (SELECT o_custkey, unnest(string_split(keys, ';')) AS k FROM g) SELECT o_custkey, split_part(k, '|', 1) AS assay, split_part(k, '|', 2) AS activity, nullif(split_part(k, '|', 3), '') AS unit FROM x")
def split_explode_keys(spark: SparkSession, d: str) -> DataFrame:
    unit = F.when(~F.col("o_orderpriority").like("%NOT%"), F.col("o_orderpriority"))
    rows = table(spark, d, "orders").select("o_custkey", text.encode_key(F.col("o_orderkey"), F.col("o_orderstatus"), unit).alias("k"))
    lists = rows.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("k")), ";").alias("keys"))
    return joins.expand_keys(lists, "keys", ["assay", "activity", "unit"]).select("o_custkey", "assay", "activity", "unit")


@query("SELECT p_partkey, regexp_replace(replace(p_name, ' ', '_') || '_x_' || p_size, '_[^_]*$', '') AS base, replace(p_name, ' ', '_') AS head, lower(p_name[1] || split_part(p_name, ' ', 2)) AS code FROM part")
def strip_suffix(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat_ws("_", F.regexp_replace("p_name", " ", "_"), F.lit("x"), "p_size")
    return table(spark, d, "part").select("p_partkey", text.without_last_token(name).alias("base"), text.first_tokens(name, 2).alias("head"), text.species_code(F.col("p_name")).alias("code"))


_STRAIN = "CASE p_partkey % 7 WHEN 0 THEN 'ATCC ' || p_partkey WHEN 1 THEN ' dsm-' || p_partkey || ' ' WHEN 2 THEN 'H37Rv_' || p_size WHEN 3 THEN 'NaN' WHEN 4 THEN 'WHO.' || p_brand WHEN 5 THEN 'atcc' END"
_COLLECTIONS = "|".join(text.NUMBERED_COLLECTIONS)


@query(
    f"WITH s AS (SELECT p_partkey, upper(trim(coalesce({_STRAIN}, ''))) AS up FROM part), k AS (SELECT p_partkey, up, regexp_replace(up, '[\\s\\-_./\\\\]', '', 'g') AS flat, "
    f"regexp_replace(regexp_replace(up, '\\b(?:(?:{_COLLECTIONS})[\\s\\-_./\\\\]*((?:[A-Z]+[\\s\\-_./\\\\]*)?[0-9])|(?:WHO|FDA)[\\s\\-_./\\\\]*([A-Z0-9]))', '\\1\\2', 'g'), '[\\s\\-_./\\\\]', '', 'g') AS bare FROM s) "
    "SELECT p_partkey, CASE WHEN up IN ('', 'NAN') THEN '' WHEN bare = '' THEN flat ELSE bare END AS key, CASE WHEN up IN ('', 'NAN') THEN '' ELSE flat END AS prefixed FROM k"
)
def strain_key_normalize(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.expr(_STRAIN).alias("strain"))
    return rows.select("p_partkey", text.strain_key(F.col("strain")).alias("key"), text.prefix_key(F.col("strain")).alias("prefixed"))


@query("SELECT text, bin, doc_id FROM (SELECT text, quality AS bin, doc_id, row_number() OVER (PARTITION BY text ORDER BY quality DESC, doc_id) AS n FROM documents JOIN labels USING (doc_id)) WHERE n = 1")
def dedupe_by_text_keep_positive(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("text", F.col("quality").alias("bin"), "doc_id")
    return datasets.positive_first(rows, "text", ["doc_id"])


@query("SELECT event_id, user_id, event_type FROM events WHERE NOT EXISTS (SELECT 1 FROM events c WHERE c.ts < TIMESTAMP '2024-01-02' AND c.user_id = events.user_id AND c.event_type = events.event_type)")
def incremental_antijoin(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return incremental.remaining(e.select("event_id", "user_id", "event_type"), e.where("ts < TIMESTAMP '2024-01-02'"), ["user_id", "event_type"])


@query("SELECT user_id, event_type, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def late_duplicate_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return incremental.keep_last(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"])


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    return incremental.windowed_counts(table(spark, d, "events"), "ts", "event_type", "value", "1 day", "1 day").withColumn("total", F.round("total", 6))


@query(f"WITH {M} SELECT assay_id, string_agg(DISTINCT smiles, ';' ORDER BY smiles) AS joined FROM m WHERE text_flag = 1 GROUP BY assay_id")
def concatenated_distinct(spark: SparkSession, d: str) -> DataFrame:
    return profile.concatenated(measurements(spark, d).where("text_flag = 1"), "assay_id", "smiles")


@query("WITH r AS (SELECT * FROM (VALUES (1, 'ring', 'A'), (2, 'red', 'B'), (3, 'bolt', 'C')) AS v(place, word, label)) SELECT p_partkey, (SELECT arg_min(label, place) FROM r WHERE contains(p_name, word)) AS label FROM part")
def first_contained_rule(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([(1, "ring", "A"), (2, "red", "B"), (3, "bolt", "C")], "place int, word string, label string")
    return joins.first_contained(table(spark, d, "part"), "p_name", rules).select("p_partkey", "label")


@query(f"WITH {M}, c AS (SELECT assay_id, count(DISTINCT compound_id) AS cpds FROM m GROUP BY assay_id) SELECT count(*) FILTER (cpds >= 100) AS at_least_100, count(*) FILTER (cpds >= 500) AS at_least_500, count(*) FILTER (cpds >= 1000) AS at_least_1000 FROM c")
def threshold_ladder(spark: SparkSession, d: str) -> DataFrame:
    c = measurements(spark, d).groupBy("assay_id").agg(F.count_distinct("compound_id").alias("cpds"))
    return profile.ladder(c, "cpds", [100, 500, 1000])


@query(f"WITH {LABELLED}, {STATS}, r AS (SELECT *, row_number() OVER (PARTITION BY activity_type ORDER BY pos_qt DESC, assay_id, place) AS n FROM ds) SELECT activity_type, assay_id, place, cutoff, pos_qt::BIGINT AS pos_qt FROM r WHERE n <= 5")
def top_rows_by_metric(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("activity_type").orderBy(F.desc("pos_qt"), "assay_id", "place")
    return _datasets(spark, d).withColumn("n", F.row_number().over(w)).where("n <= 5").select("activity_type", "assay_id", "place", "cutoff", "pos_qt")


@query(f"WITH {LABELLED}, {STATS}, s AS (SELECT DISTINCT organism, compound_id, value, bin, place, assay_id FROM b WHERE target_class = 'ORGANISM' AND activity_type = 'IC50'), k AS (SELECT organism, place, compound_id, max(bin) AS bin FROM s GROUP BY organism, place, compound_id), g AS (SELECT organism, place, count(*) AS cpds, sum(bin) AS positives FROM k GROUP BY organism, place) SELECT organism, place, cpds, positives::BIGINT AS positives, cpds >= CASE WHEN positives < 0.5 * cpds THEN 300 ELSE 100 END AND positives > 50 AS passes FROM g")
def merged_dataset_gates(spark: SparkSession, d: str) -> DataFrame:
    rows = _labelled(spark, d).where("target_class = 'ORGANISM' AND activity_type = 'IC50'").groupBy("organism", "place", "compound_id").agg(F.max("bin").alias("bin"))
    g = rows.groupBy("organism", "place").agg(F.count("*").alias("cpds"), F.sum("bin").alias("positives"))
    return g.withColumn("passes", selection.passes_gates(selection.Limits(merged_compounds=300)))


from quantarium.plans import curation, tables  # noqa: E402, F401  their queries join the catalog
