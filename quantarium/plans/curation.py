"""Queries over curation, annotation and pooling; the catalog takes them up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantarium.functions import chemistry, text
from quantarium.operators import curation, datasets, graph, joins, profile, selection, stats
from quantarium.plans.catalog import _EDGES, CONSTANTS, FIXED, LABELLED, SMALL, STATS, M, _counted, _datasets, _edges, _endpoints, _labelled, _A, query
from quantarium.session import Scratch
from quantarium.sources.measurements import TRIPLET, measurements, table, threshold_rules
from quantarium.streaming import incremental


@query("""WITH i AS (SELECT lower(trim(p_name)) AS key, min(p_partkey) AS id FROM part GROUP BY 1),
n AS (SELECT DISTINCT p_brand || ' ' || split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) || CASE WHEN p_size % 2 = 0 THEN '' ELSE '/' || p_type END AS name FROM part),
r AS (SELECT name, trim(substr(name, length(split_part(name, ' ', 1)) + 1)) AS rest FROM n),
c AS (SELECT name, 0 AS way, 0 AS at, lower(name) AS key FROM r UNION ALL SELECT name, 1, 0, lower(rest) FROM r UNION ALL SELECT name, 2, 0, lower(split_part(name, '/', 1)) FROM r WHERE contains(name, '/') UNION ALL SELECT name, 3, 0, lower(split_part(rest, '/', 1)) FROM r WHERE contains(rest, '/'))
SELECT c.name, min(i.id) AS id FROM c JOIN i USING (key) GROUP BY c.name""")
def name_resolution(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    index = curation.lookup_index(part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), part.select(F.col("p_partkey").alias("id"), F.lit("").alias("name")))
    name = F.concat(F.col("p_brand"), F.lit(" "), F.substring_index("p_name", " ", 2), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.concat(F.lit("/"), "p_type")))
    brands = part.select(F.col("p_brand").alias("prefix")).distinct()
    return curation.resolve_names(part.select(name.alias("name")).distinct(), "name", index, brands).where("id IS NOT NULL").select("name", "id")


@query("""WITH k AS (SELECT p_brand, upper(p_brand) AS u FROM part), s AS (SELECT p_brand, CASE WHEN u = 'BRAND#25' THEN 'split' WHEN u = 'BRAND#1' THEN 'first' WHEN contains(u, 'BRAND#2') THEN 'twenties' ELSE u END AS strain FROM k),
c AS (SELECT strain, p_brand, count(*) AS n FROM s GROUP BY ALL) SELECT strain, count(*) AS keys, sum(n)::BIGINT AS rows, arg_min(p_brand, (-n, p_brand)) AS dominant FROM c GROUP BY strain HAVING count(*) > 1""")
def strain_aliases(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([(1, "exact", "Brand#1", "first"), (2, "contains", "Brand#2", "twenties"), (3, "prefixed", "Brand#25", "split")], "place int, kind string, word string, label string")
    rows = curation.strain_labels(table(spark, d, "part").withColumn("other", F.lit("")), "p_brand", "other", rules)
    return curation.alias_counts(rows, "strain", "p_brand")


@query("SELECT p_type, s, CASE WHEN s IS NULL THEN 'DISCARDED' WHEN upper(p_type) = 'ECONOMY' AND upper(s) IN ('ORGANISM', 'SINGLE PROTEIN') THEN upper(s) WHEN upper(p_type) = 'PROMO' AND upper(s) = 'ORGANISM' THEN upper(s) ELSE 'DISCARDED' END AS class, count(*) AS n FROM (SELECT p_type, CASE p_size % 4 WHEN 0 THEN 'organism' WHEN 1 THEN 'Single Protein' WHEN 2 THEN 'other' END AS s FROM part) GROUP BY 1, 2, 3")
def target_collapse(spark: SparkSession, d: str) -> DataFrame:
    s = F.when(F.col("p_size") % 4 == 0, "organism").when(F.col("p_size") % 4 == 1, "Single Protein").when(F.col("p_size") % 4 == 2, "other")
    kind = F.when(F.col("p_type") == "ECONOMY", "UNCHECKED").when(F.col("p_type") == "PROMO", "NON-MOLECULAR").otherwise(F.col("p_type"))
    rows = table(spark, d, "part").select("p_type", s.alias("s"), kind.alias("kind"))
    return rows.groupBy("p_type", "s", text.target_class(F.col("kind"), F.col("s")).alias("class")).agg(F.count("*").alias("n"))


@query("WITH s AS (SELECT s_suppkey, n_name, CASE s_suppkey % 5 WHEN 0 THEN 'SINGLE PROTEIN' WHEN 1 THEN 'ORGANISM' WHEN 2 THEN 'ADMET' WHEN 3 THEN 'UNCHECKED' END AS tt FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT s_suppkey, CASE WHEN tt IN ('SINGLE PROTEIN', 'ADMET') OR (tt = 'ORGANISM' AND contains(lower(n_name), 'nation_1')) THEN 'text_only' ELSE 'full_inference' END AS triage, CASE WHEN tt = 'SINGLE PROTEIN' THEN tt WHEN tt = 'ADMET' THEN 'DISCARDED' ELSE 'ORGANISM' END AS curated, CASE WHEN tt = 'SINGLE PROTEIN' THEN 'T' || s_suppkey WHEN tt = 'ADMET' THEN '' ELSE 'E1' END AS id FROM s")
def triage_prefill(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey") % 5
    kind = F.when(k == 0, "SINGLE PROTEIN").when(k == 1, "ORGANISM").when(k == 2, "ADMET").when(k == 3, "UNCHECKED")
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("tt", kind)
    target = F.concat(F.lit("T"), F.col("s_suppkey").cast("string"))
    protein, dropped = ["SINGLE PROTEIN"], ["ADMET"]
    return rows.select(
        "s_suppkey", text.triage(F.col("tt"), target, F.lit(None).cast("string"), F.col("n_name"), "NATION_1", "T0x", protein, dropped, ["UNCHECKED"]).alias("triage"),
        text.prefill(F.col("tt"), target, F.col("s_name"), F.col("n_name"), "entity", "E1", protein, dropped).alias("p"),
    ).select("s_suppkey", "triage", F.col("p.target_type_curated").alias("curated"), F.col("p.target_id_curated").alias("id"))


@query("SELECT upper(replace(event_type, '_', '')) AS kind, count(*) AS n, string_agg(DISTINCT event_type, ' ; ' ORDER BY event_type) AS variants, count(*) FILTER (value > 50) AS high FROM events GROUP BY 1")
def variants_and_conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy(text.harmonize(F.col("event_type")).alias("kind")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("event_type")), " ; ").alias("variants"), F.count_if(F.col("value") > 50).alias("high"))


_SELECTED = f"sel AS (SELECT DISTINCT assay_id, activity_type, unit FROM ds WHERE {_A})"


@query(f"""WITH {LABELLED}, {STATS}, {_SELECTED}, tr AS (SELECT DISTINCT assay_id, activity_type, unit FROM m),
l AS (SELECT assay_id, activity_type, unit, count(*) AS n_cutoffs, max(cpds_qt) AS cpds, max(pos_qt)::BIGINT AS positives, max(pos_qt) / max(cpds_qt) AS ratio FROM ds GROUP BY assay_id, activity_type, unit)
SELECT tr.assay_id, tr.activity_type, tr.unit, n_cutoffs, l.cpds, l.positives, l.ratio, sel.assay_id IS NOT NULL AS selected, CASE WHEN sel.assay_id IS NOT NULL THEN 'Retained in final selection as A' WHEN n_cutoffs IS NULL THEN 'no expert cutoff defined' WHEN l.positives = 0 THEN 'insufficient positives' ELSE 'not selected' END AS comment
FROM tr LEFT JOIN l ON tr.assay_id = l.assay_id AND tr.activity_type = l.activity_type AND tr.unit IS NOT DISTINCT FROM l.unit LEFT JOIN sel ON tr.assay_id = sel.assay_id AND tr.activity_type = sel.activity_type AND tr.unit IS NOT DISTINCT FROM sel.unit""")
def master_annotation(spark: SparkSession, d: str) -> DataFrame:
    rows = _datasets(spark, d)
    chosen = rows.where(selection.condition_a(SMALL)).groupBy(*TRIPLET).agg(F.min("cutoff").alias("selected_cutoff")).withColumn("label", F.lit("A"))
    out = curation.annotate(measurements(spark, d).select(*TRIPLET).distinct(), rows, chosen)
    return out.select(*TRIPLET, F.size(F.split("cutoffs", ";")).cast("long").alias("n_cutoffs"), "cpds", "positives", "ratio", "selected", "comment").withColumn("n_cutoffs", F.when(F.col("cpds").isNotNull(), F.col("n_cutoffs")))


@query(f"WITH {LABELLED}, {STATS}, a AS (SELECT DISTINCT ds.assay_id, ds.activity_type, ds.unit, CASE WHEN {_A} THEN 'A' ELSE 'rest' END AS label FROM ds), c AS (SELECT DISTINCT label, compound_id FROM q JOIN a ON q.assay_id = a.assay_id AND q.activity_type = a.activity_type AND q.unit = a.unit) SELECT coalesce(label, 'ALL') AS label, count(DISTINCT compound_id) AS cpds, count(DISTINCT compound_id) / (SELECT count(DISTINCT compound_id) FROM m) AS share FROM c GROUP BY ROLLUP (label)")
def label_coverage(spark: SparkSession, d: str) -> DataFrame:
    m = datasets.compounds(measurements(spark, d), CONSTANTS)
    label = F.when(selection.condition_a(SMALL), "A").otherwise("rest")
    marked = _counted(datasets.labelled(datasets.actives(m, CONSTANTS), threshold_rules(spark))).select(*TRIPLET, label.alias("label")).distinct()
    members = m.where("low IS NOT NULL").select(*TRIPLET, "compound_id").distinct()
    rows = joins.nullsafe_join(marked, members, TRIPLET).select("label", "compound_id").distinct()
    universe = m.agg(F.count_distinct("compound_id")).first()[0]
    return rows.rollup("label").agg(F.count_distinct("compound_id").alias("cpds")).withColumn("share", F.col("cpds") / universe).fillna("ALL", ["label"])


@query(f"WITH {LABELLED}, {STATS} SELECT activity_type, unit, count(DISTINCT assay_id) AS assays, count(DISTINCT assay_id) FILTER ({_A}) AS accepted, arg_max(assay_id, (pos_qt / cpds_qt, -assay_id, -place)) AS best_assay, max(pos_qt / cpds_qt) AS best FROM ds GROUP BY activity_type, unit")
def endpoint_report(spark: SparkSession, d: str) -> DataFrame:
    ratio = F.col("pos_qt") / F.col("cpds_qt")
    order = F.struct(ratio.alias("r"), (-F.col("assay_id")).alias("a"), (-F.col("place")).alias("p"))
    return _datasets(spark, d).groupBy("activity_type", "unit").agg(F.count_distinct("assay_id").alias("assays"), F.count_distinct(F.when(selection.condition_a(SMALL), F.col("assay_id"))).alias("accepted"), F.max_by("assay_id", order).alias("best_assay"), F.max(ratio).alias("best"))


@query(f"WITH {_EDGES}, g AS (SELECT k AS key, k % 10 AS \"group\", count(*) AS size FROM r GROUP BY k), s AS (SELECT key_1 AS key, key_2 AS other, agreement, n FROM e UNION ALL SELECT key_2, key_1, agreement, n FROM e) SELECT g.key, any_value(g.\"group\") AS \"group\", any_value(size) AS size, round(sum(agreement * s.n) / sum(s.n), 9) AS mean_agreement FROM g LEFT JOIN (SELECT s.* FROM s JOIN g a ON s.key = a.key JOIN g o ON s.other = o.key AND a.\"group\" = o.\"group\") s ON g.key = s.key GROUP BY g.key")
def neighbour_agreement(spark: SparkSession, d: str) -> DataFrame:
    members = _endpoints(spark, d).groupBy("key", (F.col("key") % 10).alias("group")).agg(F.count("*").alias("size"))
    return graph.neighbour_agreement(_edges(spark, d), members).withColumn("mean_agreement", F.round("mean_agreement", 9))


@query(f"WITH {LABELLED}, lv AS (SELECT activity_type, unit, CASE place WHEN 1 THEN 'low' WHEN 2 THEN 'middle' ELSE 'high' END AS level, smiles, max(bin) AS bin FROM b WHERE target_class = 'ORGANISM' GROUP BY 1, 2, 3, 4), n AS (SELECT activity_type, unit, CASE place WHEN 1 THEN 'low' WHEN 2 THEN 'middle' ELSE 'high' END AS level, count(DISTINCT assay_id) AS n_assays FROM b WHERE target_class = 'ORGANISM' GROUP BY 1, 2, 3) SELECT lv.activity_type || '|' || lv.unit || '|' || lv.level AS pool, count(*) AS n_mols, sum(bin)::BIGINT AS n_actives, any_value(n_assays) AS n_assays FROM lv JOIN n ON lv.activity_type = n.activity_type AND lv.unit = n.unit AND lv.level = n.level GROUP BY 1")
def general_pools(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("place") == 1, "low").when(F.col("place") == 2, "middle").otherwise("high")
    rows = _labelled(spark, d).where("target_class = 'ORGANISM'").withColumn("pool", F.concat_ws("|", "activity_type", "unit", level))
    return curation.pool_records(rows, "pool", "assay_id", "smiles")


@query(f"WITH {M}, e AS (SELECT user_id AS assay_id, arg_max(event_type, event_id) AS state FROM events GROUP BY user_id) SELECT DISTINCT m.assay_id, m.activity_type, m.unit, state FROM m JOIN e ON m.assay_id = e.assay_id")
def resume_expansion(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "events").select(F.col("user_id").alias("assay_id"), F.col("event_type").alias("state"), "event_id")
    return curation.expand_to_triplets(results, measurements(spark, d), "event_id")


@query("SELECT vec_id FROM embeddings WHERE label <> 3 ORDER BY md5(vec_id::VARCHAR || '#42'), vec_id LIMIT (SELECT 3 * count(*) FROM embeddings WHERE label = 3)")
def background_sample(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "label")
    return curation.background(e.where("label = 3"), e, "vec_id").select("vec_id")


@query("SELECT DISTINCT vec_id FROM ((SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 50) UNION ALL (SELECT vec_id FROM embeddings ORDER BY vec_id DESC LIMIT 50))")
def reference_set_ends(spark: SparkSession, d: str) -> DataFrame:
    return stats.ends(table(spark, d, "embeddings").select("vec_id"), "vec_id", 50)


@query("WITH c AS (SELECT (label < 3)::INT AS bin, vec_id, row_number() OVER (PARTITION BY (label < 3)::INT ORDER BY md5(vec_id::VARCHAR || '#42'), vec_id) AS k, count(*) OVER (PARTITION BY (label < 3)::INT) AS c, count(*) OVER () AS n FROM embeddings) SELECT vec_id, bin FROM c WHERE k <= CASE WHEN n > 200 THEN greatest(4, floor(c * (200 / n))) ELSE c END")
def capped_subsample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", (F.col("label") < 3).cast("int").alias("bin"))
    return stats.capped(rows, "vec_id", 200)


@query("SELECT k.activity_type, k.unit, r.r_name, t.cutoff FROM (SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'MIC' WHEN 'R' THEN 'IC50' ELSE 'INHIBITION' END AS activity_type, CASE WHEN l_returnflag <> 'N' THEN 'umol.L-1' WHEN l_linestatus = 'F' THEN '%' END AS unit FROM lineitem) k CROSS JOIN region r LEFT JOIN (SELECT 'MIC' AS activity_type, 'umol.L-1' AS unit, 20.0 AS cutoff UNION ALL SELECT 'IC50', 'umol.L-1', 20.0 UNION ALL SELECT 'INHIBITION', '%', 50.0) t ON k.activity_type = t.activity_type AND k.unit = t.unit")
def threshold_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every endpoint kind for every region, with its most lenient threshold where there is one: both sides are a few rows."""
    kinds = measurements(spark, d).select("activity_type", "unit").distinct()
    grid = kinds.join(table(spark, d, "region").select("r_name"))
    lenient = threshold_rules(spark).where("target_class = 'ORGANISM'").select("activity_type", "unit", F.get("thresholds", 0).alias("cutoff"))
    return joins.nullsafe_join(grid, lenient, ["activity_type", "unit"], "left")


@query(f"WITH {M}, {FIXED}, g AS (SELECT organism, activity_type, unit, direction FROM q WHERE target_class = 'ORGANISM' GROUP BY organism, activity_type, unit, direction HAVING count(DISTINCT assay_id) > 1), x AS (SELECT q.*, row_number() OVER (PARTITION BY q.organism, q.activity_type, q.unit, q.direction, compound_id ORDER BY CASE WHEN q.direction = 1 THEN -value ELSE value END, assay_id) AS n FROM q JOIN g USING (organism, activity_type, unit, direction) WHERE target_class = 'ORGANISM') SELECT organism, activity_type, unit, direction, count(*) AS cpds, sum(value) AS total FROM x WHERE n = 1 GROUP BY organism, activity_type, unit, direction")
def merge_materialized(spark: SparkSession, d: str) -> DataFrame:
    keys = ["organism", "activity_type", "unit"]
    rows = datasets.quantitative(measurements(spark, d), ["target_class", "organism"]).where("target_class = 'ORGANISM'")
    several = rows.groupBy(*keys, "direction").agg(F.count_distinct("assay_id").alias("k")).where("k > 1").drop("k")
    merged = datasets.most_active(joins.nullsafe_join(rows, several, [*keys, "direction"], "left_semi"), keys)
    return merged.groupBy(*keys, "direction").agg(F.count("*").alias("cpds"), F.sum("value").alias("total"))


@query("WITH b AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), c AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) SELECT o_custkey, b.n - coalesce(c.n, 0) AS n FROM b LEFT JOIN c USING (o_custkey) WHERE b.n - coalesce(c.n, 0) > 0")
def split_off_counts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    count = lambda df: df.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return curation.split_off(count(o), count(o.where("o_orderstatus = 'P'")), "o_custkey")


@query("SELECT count(DISTINCT nullif(trim(p_type), '')) AS kinds, count(DISTINCT nullif(trim(p_brand), '')) AS brands FROM part")
def distinct_non_blank(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.agg(*(F.count_distinct(F.nullif(F.trim(c), F.lit(""))).alias(n) for c, n in (("p_type", "kinds"), ("p_brand", "brands"))))


@query("WITH e AS (SELECT vec_id, label, embedding FROM embeddings), c AS (SELECT label, min(vec_id) AS first FROM e GROUP BY label), f AS (SELECT e.label, e.embedding AS v FROM e JOIN c ON e.vec_id = c.first) SELECT e.vec_id, f.label, len(list_filter(range(len(v)), lambda i: e.embedding[i + 1] > 0 AND v[i + 1] > 0)) / len(list_filter(range(len(v)), lambda i: e.embedding[i + 1] > 0 OR v[i + 1] > 0)) AS similarity FROM e JOIN f ON true")
def reference_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Every vector against the first one of each class (one row a class)."""
    e = table(spark, d, "embeddings")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return chemistry.to_references(e.select("vec_id", "embedding"), "embedding", first, "label")


@query("WITH x AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events), y AS (SELECT *, sum((before IS NULL OR ts - before >= INTERVAL 6 HOUR)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM x) SELECT min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS \"end\", user_id, count(*) AS n FROM y GROUP BY user_id, s")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    return incremental.sessions(table(spark, d, "events"), "ts", "user_id", "6 hours", "1 day")


_LEAST, _LOSS, _CHECKS = 0.62, 0.004, 5


@query(f"""WITH RECURSIVE {_EDGES}, g AS (SELECT k AS key, (k // 10) % 6 AS grp, count(*) AS n, sum(l) AS pos FROM r GROUP BY k),
s AS (SELECT key_1 AS key, key_2 AS other, agreement, n FROM e UNION ALL SELECT key_2, key_1, agreement, n FROM e),
x AS (SELECT s.key, sum(agreement * s.n) / sum(s.n) AS mean FROM s JOIN g a ON s.key = a.key JOIN g o ON s.other = o.key AND a.grp = o.grp GROUP BY s.key),
k AS (SELECT policy, g.*, CASE policy WHEN 'largest' THEN n::DOUBLE ELSE coalesce(nullif(mean, 0), -1) END AS place FROM g LEFT JOIN x USING (key), (SELECT unnest(['largest', 'medoid']) AS policy)),
o AS (SELECT a.policy, a.grp, key_1, key_2, row_number() OVER (PARTITION BY a.policy, a.grp ORDER BY agreement, key_1, key_2) AS p, CASE WHEN a.place <= b.place THEN key_1 ELSE key_2 END AS loser
 FROM e JOIN k a ON key_1 = a.key JOIN k b ON key_2 = b.key AND a.policy = b.policy AND a.grp = b.grp WHERE agreement < {_LEAST}),
w AS (SELECT policy, grp, 0::BIGINT AS p, []::BIGINT[] AS gone, 0 AS done, sum(n)::BIGINT AS n, sum(pos)::BIGINT AS pos FROM k GROUP BY policy, grp UNION ALL
 SELECT policy, grp, p, CASE WHEN goes THEN list_append(gone, loser) ELSE gone END, done + tried::INT, CASE WHEN goes THEN n - ln ELSE n END, CASE WHEN goes THEN pos - lp ELSE pos END FROM (SELECT *, tried AND (pos - lp) / (n - ln) >= pos / n - {_LOSS} AS goes FROM (
  SELECT w.policy, w.grp, o.p, w.gone, w.done, w.n, w.pos, o.loser, g.n::BIGINT AS ln, g.pos::BIGINT AS lp, w.done < {_CHECKS} AND NOT list_contains(w.gone, o.key_1) AND NOT list_contains(w.gone, o.key_2) AS tried
  FROM w JOIN o ON o.policy = w.policy AND o.grp = w.grp AND o.p = w.p + 1 JOIN g ON g.key = o.loser)))
SELECT k.policy, k.grp AS "group", k.key, NOT list_contains(z.gone, k.key) AS kept FROM k JOIN (SELECT policy, grp, arg_max(gone, p) AS gone FROM w GROUP BY policy, grp) z ON z.policy = k.policy AND z.grp = k.grp""")
def guarded_pruning(spark: SparkSession, d: str) -> DataFrame:
    """Pools of endpoints lose members of discordant pairs while their score (here the share of actives) holds, by both policies."""
    scratch = Scratch(spark, "pruning")
    group = lambda key: (F.floor(F.col(key) / 10) % 6).cast("long")
    sizes = _endpoints(spark, d).groupBy("key", group("key").alias("group")).agg(F.count("*").alias("size"), F.sum("bin").alias("positives"))
    members, pairs = scratch.keep(sizes, "members"), scratch.keep(_edges(spark, d).where(group("key_1") == group("key_2")), "pairs")  # others are of no pool

    def score(trials: DataFrame) -> DataFrame:
        return trials.join(members.select("key", "positives", "size"), "key").groupBy("group").agg((F.sum("positives") / F.sum("size")).alias("score"))

    # each policy has pools of its own, so both go through the same rounds
    pools = (graph.ranks(pairs, members, policy).withColumn("group", F.struct(F.lit(policy).alias("policy"), "group")) for policy in ("largest", "medoid"))
    out = graph.prune_pools(pairs, reduce(DataFrame.unionByName, pools), score, scratch, _LEAST, _LOSS, _CHECKS)
    return out.select("group.policy", "group.group", "key", "kept")


@query(f"WITH {M} SELECT activity_type, count(*) AS n, count(*) FILTER (value IS NOT NULL AND text_flag = 0) AS numeric_only, count(*) FILTER (value IS NOT NULL AND text_flag <> 0) AS numeric_flagged, 100 * avg((abs(coalesce(greatest(1, least(9, value / 10)), 1) - greatest(1, least(9, mw / 300))) < 1)::INT) AS agreeing FROM m GROUP BY activity_type")
def agreement_rate(spark: SparkSession, d: str) -> DataFrame:
    from quantarium.functions.numeric import clip

    near = F.abs(F.coalesce(clip(F.col("value") / 10, 1.0, 9.0), F.lit(1.0)) - clip(F.col("mw") / 300, 1.0, 9.0)) < 1
    has = F.col("value").isNotNull()
    return measurements(spark, d).groupBy("activity_type").agg(F.count("*").alias("n"), F.count_if(has & (F.col("text_flag") == 0)).alias("numeric_only"), F.count_if(has & (F.col("text_flag") != 0)).alias("numeric_flagged"), (100 * F.avg(near.cast("int"))).alias("agreeing"))


@query(f"WITH {_EDGES}, n AS (SELECT DISTINCT key_2 FROM e) SELECT k.key_1, string_agg(coalesce(round(1000000 * agreement)::BIGINT::VARCHAR, ''), ';' ORDER BY n.key_2) AS row FROM (SELECT DISTINCT key_1 FROM e) k CROSS JOIN n LEFT JOIN e ON e.key_1 = k.key_1 AND e.key_2 = n.key_2 GROUP BY k.key_1")
def square_matrix(spark: SparkSession, d: str) -> DataFrame:
    """All endpoints against all; each row as one text, as the columns depend on the table."""
    edges = _edges(spark, d)
    names = [r["key_2"] for r in edges.select("key_2").distinct().orderBy("key_2").limit(10_001).collect()]  # endpoints; more are an error
    wide = profile.square_matrix(edges, names, "agreement")
    cells = (F.coalesce(F.round(1000000 * F.col(f"`{k}`")).cast("long").cast("string"), F.lit("")) for k in names)
    return wide.select("key_1", F.concat_ws(";", *cells).alias("row"))
