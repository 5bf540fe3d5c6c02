"""Queries over sources and sinks, exports, templates and samples; the catalog takes them up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantarium.functions import numeric, structures, text
from quantarium.operators import components, diversity, graph, joins, linkage, profile, selection, stats
from quantarium.plans.catalog import _EDGES, LABELLED, M, _edges, _endpoints, _labelled, query
from quantarium.session import Scratch
from quantarium.sources import archives, files, keyed, pages
from quantarium.sources.measurements import measurements, table
from quantarium.streaming import incremental, latest


def _folder(spark: SparkSession, label: str) -> str:
    return Scratch(spark, label).root


_CUSTOMERS = "c_custkey long, c_name string, c_acctbal double"


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as plain CSV, read with its schema."""
    path = f"{_folder(spark, 'csv')}/customers"
    files.write_csv(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return files.read_csv(spark, path, T._parse_datatype_string(_CUSTOMERS))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice FROM orders")
def gzip_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Gzip CSV with missing cells in several spellings."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.when(k % 5 != 0, F.col("o_orderpriority")).when(k % 2 == 0, "NA").alias("o_orderpriority"),
        F.when(k % 7 != 0, F.col("o_totalprice").cast("string")).when(k % 2 == 0, " N/A ").otherwise("nan").alias("o_totalprice"),
    )
    path = f"{_folder(spark, 'gzip')}/orders"
    files.write_csv(rows, path, compressed=True)
    return files.read_csv(spark, path, T._parse_datatype_string("o_orderkey long, o_orderpriority string, o_totalprice double"))


@query("SELECT r_regionkey, r_name FROM region")
def optional_sources(spark: SparkSession, d: str) -> DataFrame:
    """A table that is there and two that are not, which count as empty."""
    schema = T._parse_datatype_string("r_regionkey int, r_name string")
    here = files.read_optional(spark, f"{d}/region.parquet", schema)
    missing = files.read_optional(spark, f"{d}/no-such-table.parquet", schema).unionByName(files.read_optional(spark, f"{d}/no-such-table.csv", schema, "csv"))
    return here.unionByName(missing)


@query("SELECT DISTINCT trim(x) AS id FROM (SELECT unnest(string_split(p_type || ', ' || p_brand, ',')) AS x FROM part) WHERE trim(x) <> ''")
def id_list_source(spark: SparkSession, d: str) -> DataFrame:
    """Ids of a text file, several a line."""
    path = f"{_folder(spark, 'ids')}/ids"
    table(spark, d, "part").select(F.concat_ws(", ", "p_type", "p_brand")).write.text(path)
    return files.read_ids(spark, path, split=",")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def archive_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """One archive a region with its nations as gzip CSV, read back as a table."""
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    archives = Scratch(spark, "archives").keep(files.zipped(rows, "r_name", rows=3), "zip")
    out = files.read_zipped(archives, T._parse_datatype_string("n_nationkey int, n_name string"))
    return out.select("n_nationkey", "n_name", F.regexp_extract("member", r"^(.*)-\d+\.csv\.gz$", 1).alias("r_name"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def tabbed_source(spark: SparkSession, d: str) -> DataFrame:
    """Customers as tab-separated lines without a header, each file's first line a comment."""
    path = f"{_folder(spark, 'tabbed')}/customers"
    line = F.concat_ws("\t", "c_custkey", "c_name", "c_acctbal")
    note = F.when(F.col("c_custkey") % 50 == 1, F.array(F.lit("# customers"), line)).otherwise(F.array(line))
    table(spark, d, "customer").select(F.explode(note).alias("value")).write.text(path)
    return files.read_csv(spark, path, T._parse_datatype_string(_CUSTOMERS), separator="\t", comment="#", header=False)


@query("SELECT p_partkey, list_aggregate(list_sort(list_distinct([p_brand, p_type, p_name])), 'string_agg', ';') AS codes FROM part")
def nested_key_search(spark: SparkSession, d: str) -> DataFrame:
    """The values of one key wherever it stands in a JSON text, split at commas; other keys and levels are around it."""
    inner = F.struct(F.lit("x").alias("note"), F.concat("p_type", F.lit(" , "), "p_brand").alias("codes no."))
    deep = F.struct(F.array(inner, inner).alias("list"), F.col("p_name").alias("codes no."), F.lit("w").alias("codes"))
    return table(spark, d, "part").select("p_partkey", F.array_join(files.nested_values(F.to_json(F.struct(deep.alias("top"))), "codes no."), ";").alias("codes"))


@query("SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN event_id * 2 END AS answer FROM events")
def batched_answers(spark: SparkSession, d: str) -> DataFrame:
    """Events sent to a service six at a time; it refuses every batch with an item that it can't answer, so the others go alone."""

    def service(items: list[int]) -> list[int]:
        if any(i % 50 == 0 for i in items):
            raise ValueError("one of these has no answer")
        return [2 * i for i in items]

    return incremental.answered(table(spark, d, "events").select("event_id"), "event_id", service, "long")


@query(f"""WITH {_EDGES}, s AS (SELECT key_1 AS name, key_2 AS other, agreement FROM e UNION ALL SELECT key_2, key_1, agreement FROM e)
SELECT name, arg_max(other, (agreement, other)) AS cause, max(agreement) AS score FROM s WHERE (name // 10) % 3 <> 0 AND (other // 10) % 3 = 0 GROUP BY name""")
def best_correlated_cause(spark: SparkSession, d: str) -> DataFrame:
    """For endpoints that a rule drops, the kept one each agrees with best."""
    pairs = Scratch(spark, "causes").keep(_edges(spark, d).withColumnRenamed("agreement", "score"), "pairs")
    names = pairs.select(F.explode(F.array("key_1", "key_2")).alias("name")).distinct()
    return selection.causes(names.select("name", (F.floor(F.col("name") / 10) % 3 == 0).alias("kept")), pairs)


@query("SELECT n_nationkey, n_name FROM nation")
def paginated_source(spark: SparkSession, d: str) -> DataFrame:
    """Pages of five nations each as JSON answers, fetched by their addresses."""
    root = f"{_folder(spark, 'pages')}/answers"
    nations = table(spark, d, "nation").withColumn("page", F.floor(F.col("n_nationkey") / 5))
    answers = nations.groupBy("page").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("results"))).alias("value"))
    answers.repartition("page").write.partitionBy("page").text(root)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).load(root)
    urls = found.select(F.regexp_replace("path", "^file:/+", "file:///").alias("url"))
    return files.read_pages(spark, urls, "struct<n_nationkey: int, n_name: string>").drop("url")


@query("SELECT user_id, count(*) AS n, sum(value) AS total FROM events GROUP BY user_id")
def append_with_resume(spark: SparkSession, d: str) -> DataFrame:
    """Batches appended one by one, the second one written twice; each counts once."""
    path = f"{_folder(spark, 'batches')}/events"
    rows = table(spark, d, "events").select("event_id", "user_id", "value")
    for batch in (0, 1, 1, 2):
        files.append_batch(rows.where(F.col("event_id") % 3 == batch), path, batch)
    return spark.read.parquet(path).groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY ALL")
def partitioned_sink(spark: SparkSession, d: str) -> DataFrame:
    """A folder a label, read back by its folders."""
    path = f"{_folder(spark, 'datasets')}/orders"
    counts = files.write_datasets(table(spark, d, "orders"), path, ["o_orderstatus", "o_orderpriority"])
    total = spark.read.parquet(path).groupBy("o_orderstatus", "o_orderpriority").agg(F.sum("o_totalprice").alias("total"))
    return counts.select("o_orderstatus", "o_orderpriority", F.col("count").alias("n")).join(total, ["o_orderstatus", "o_orderpriority"])


@query(f"WITH {LABELLED} SELECT assay_id || '_' || activity_type || '_qt_' || place AS name, count(*) AS rows, sum(bin)::BIGINT AS positives FROM b GROUP BY assay_id, activity_type, place")
def export_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Name, rows and positives of each exported dataset."""
    name = text.dataset_name(F.col("assay_id"), F.col("activity_type"), F.lit("quantitative"), F.col("place"))
    return _labelled(spark, d).groupBy("assay_id", "activity_type", "place").agg(F.count("*").alias("rows"), F.sum("bin").alias("positives")).select(name.alias("name"), "rows", "positives")


@query("SELECT DISTINCT coalesce(trim(CASE WHEN p_size % 3 > 0 THEN ' ' || p_type || ' ' END), '<NA>') AS type, coalesce(trim(CASE WHEN p_size % 2 = 0 THEN p_brand END), '<NA>') AS brand FROM part")
def sentinel_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    kind = F.when(F.col("p_size") % 3 > 0, F.concat(F.lit(" "), "p_type", F.lit(" ")))
    return p.select(text.sentinel(kind).alias("type"), text.sentinel(F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))).alias("brand")).distinct()


@query("SELECT p_partkey, 'name: ' || p_name || CASE WHEN p_size % 2 = 0 THEN chr(10) || 'type: ' || p_type ELSE '' END || chr(10) || 'abstract: ' || substr(repeat(p_name || ' ', 60), 1, 1000) || CASE WHEN length(repeat(p_name || ' ', 60)) > 1000 THEN '...' ELSE '' END AS prompt FROM part")
def prompt_context(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", text.context(name=F.col("p_name"), type=F.when(F.col("p_size") % 2 == 0, F.col("p_type")), abstract=F.expr("repeat(p_name || ' ', 60)")).alias("prompt"))


@query("""WITH t AS (SELECT n_regionkey, list('- N' || n_nationkey || ': ' || n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' (also ' || lower(n_name) || ')' ELSE '' END ORDER BY n_nationkey) AS l FROM nation GROUP BY n_regionkey)
SELECT r_regionkey, r_name || ' (' || CASE r_regionkey % 3 WHEN 0 THEN 'fungus' WHEN 1 THEN 'parasite' ELSE 'bacteria' END || '), id ' || CASE WHEN r_regionkey = 1 THEN 'UNKNOWN' ELSE 'R' || r_regionkey END || '. Measured: ' ||
 CASE r_regionkey % 3 WHEN 0 THEN 'antifungal activity, growth inhibition' WHEN 1 THEN 'antiparasitic activity, growth inhibition' ELSE 'antibacterial activity, growth inhibition, MIC determination' END || '.' || chr(10) || array_to_string(l, chr(10)) AS paragraph
FROM region JOIN t ON n_regionkey = r_regionkey""")
def class_paragraph(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    one = F.struct(F.col("n_nationkey"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lower("n_name"))).otherwise(F.array().cast("array<string>")).alias("synonyms"))
    targets = n.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(one)).alias("targets"))  # an organism's targets
    k = F.col("r_regionkey")
    rows = table(spark, d, "region").join(targets, k == F.col("n_regionkey"))
    kind = F.when(k % 3 == 0, "fungus").when(k % 3 == 1, "parasite").otherwise("bacteria")
    return rows.select("r_regionkey", text.class_template(F.col("r_name"), F.when(k != 1, F.concat(F.lit("R"), k.cast("string"))), kind, F.col("targets")).alias("paragraph"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS selected FROM customer WHERE coalesce(c_custkey % 4 IN (0, 2), false) OR c_custkey % 2 = 1")
def boolean_coercion(spark: SparkSession, d: str) -> DataFrame:
    """Cells ` TRUE `, `0` and `yes` as booleans, null for others."""
    k = F.col("c_custkey") % 4
    rows = table(spark, d, "customer").select("c_custkey", text.truth(F.when(k == 0, " TRUE ").when(k == 1, "0").when(k == 2, "yes").otherwise("maybe")).alias("selected"))
    return rows.where(F.coalesce("selected", F.lit(False)) | (F.col("c_custkey") % 2 == 1))


@query("SELECT event_id, user_id, lag(value) OVER w AS before, lead(value) OVER w AS behind, ntile(4) OVER w::INT AS part, percent_rank() OVER w AS share, sum(value) OVER (PARTITION BY user_id ORDER BY epoch(ts)::BIGINT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS near FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)".replace("epoch(ts)::BIGINT", "floor(epoch(ts))::BIGINT"))
def window_steps(spark: SparkSession, d: str) -> DataFrame:
    return profile.steps(table(spark, d, "events"), "user_id", "ts", "value")


@query("SELECT event_type, true AS members_near, true AS median_near FROM events GROUP BY event_type")
def approximate_aggregates(spark: SparkSession, d: str) -> DataFrame:
    """Sketches beside exact values: both within 10 % of them."""
    e = table(spark, d, "events")
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("m"), F.percentile("value", F.lit(0.5)).alias("p"))
    both = profile.approximate(e, ["event_type"], "user_id", "value").join(exact, "event_type")
    return both.select("event_type", (F.abs(F.col("members") - F.col("m")) <= 0.1 * F.col("m") + 1).alias("members_near"), (F.abs(F.col("median") - F.col("p")) <= 0.1 * F.abs("p") + 1).alias("median_near"))


@query(f"WITH {LABELLED}, k AS (SELECT count(*) AS n, sum(bin)::BIGINT AS p FROM (SELECT compound_id, max(bin) AS bin FROM b WHERE assay_id = (SELECT min(assay_id) FROM b) GROUP BY compound_id)) SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT compound_id FROM b WHERE assay_id = (SELECT min(assay_id) FROM b)) ORDER BY md5(o_orderkey::VARCHAR || '#42'), o_orderkey LIMIT (SELECT greatest(0, least(100, floor(p / 0.1)::BIGINT - n)) FROM k)")
def decoy_rows(spark: SparkSession, d: str) -> DataFrame:
    """Pool members that the first assay has never tested, as many as bring its positives to 10 % (100 at most here, the pool being small)."""
    rows = _labelled(spark, d)
    rows = rows.where(F.col("assay_id") == rows.agg(F.min("assay_id")).first()[0]).groupBy(F.col("compound_id").alias("o_orderkey")).agg(F.max("bin").alias("bin"))
    n, p = rows.agg(F.count("*"), F.sum("bin")).first()
    most = max(0, min(100, int(p / 0.1) - n))
    return stats.decoys(table(spark, d, "orders").select("o_orderkey"), rows, "o_orderkey", n + most, n, 1.0)


@query(
    f"WITH RECURSIVE {_EDGES}, ed AS (SELECT key_1 AS a, key_2 AS b FROM e WHERE agreement >= 0.9 UNION SELECT key_2, key_1 FROM e WHERE agreement >= 0.9), reach AS (SELECT a AS node, a AS other FROM ed UNION SELECT reach.node, ed.b FROM reach JOIN ed ON reach.other = ed.a), "
    "roots AS (SELECT node AS key, min(other) AS root FROM reach GROUP BY node), g AS (SELECT DISTINCT k AS key, 'B' || k % 10 AS bucket FROM r), s AS (SELECT g.key, g.bucket, root FROM g LEFT JOIN roots USING (key)), "
    "z AS (SELECT bucket, root, row_number() OVER (PARTITION BY bucket ORDER BY count(*) DESC, root) AS place FROM s WHERE root IS NOT NULL GROUP BY bucket, root) "
    "SELECT s.key, s.bucket, s.bucket || '_' || coalesce(CASE WHEN place <= 2 THEN place::VARCHAR END, 'residual') AS pool FROM s LEFT JOIN z ON z.bucket = s.bucket AND z.root = s.root"
)
def component_pools(spark: SparkSession, d: str) -> DataFrame:
    """Pools by component of agreement, the two largest of each bucket and its residual."""
    ends = _endpoints(spark, d).select("key", F.concat(F.lit("B"), (F.col("key") % 10).cast("string")).alias("bucket")).distinct()
    return graph.pool_by_component(ends, _edges(spark, d), Scratch(spark, "pools"), least=0.9, most=2).select("key", "bucket", "pool")


@query("SELECT doc_id, CASE WHEN n > 0 AND n <= 3 THEN doc_id % 3 END AS first FROM (SELECT doc_id, 1 + doc_id % 4 AS n FROM documents)")
def answer_records(spark: SparkSession, d: str) -> DataFrame:
    """Answers parsed as records, null where their number is not the asked one (at most three here)."""
    n = (1 + F.col("doc_id") % 4).cast("int")
    rows = table(spark, d, "documents").select("doc_id", F.to_json(F.struct(F.array_repeat(F.struct((F.col("doc_id") % 3).alias("a")), n).alias("results"))).alias("answer"), F.least(n, F.lit(3)).alias("asked"))
    return rows.select("doc_id", files.records(F.col("answer"), "struct<a: bigint>", F.col("asked"))[0]["a"].alias("first"))


@query("SELECT p_partkey, round(pow(10, 5 * (p_size / 50)), 6) AS value, round(log10(p_retailprice) / 5, 9) AS axis, format('{:.2f}', p_size / 4) || ';nan;' || format('{:.2f}', p_size::DOUBLE) AS listed, least(p_size * 5, 127) AS clipped, CASE WHEN p_size > 10 AND p_size <= 20 THEN 0 WHEN p_size > 20 AND p_size <= 50 THEN 1 END AS bin FROM part")
def numeric_functions(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    counts = F.create_map(F.lit(1), size * 5)
    return table(spark, d, "part").select(
        "p_partkey", F.round(numeric.axis_to_value(size / 50), 6).alias("value"), F.round(numeric.value_to_axis(F.col("p_retailprice")), 9).alias("axis"),
        numeric.formatted(F.array(size / 4, F.lit(None).cast("double"), size.cast("double"))).alias("listed"), numeric.clipped_counts(counts, 3)[1].cast("int").alias("clipped"), numeric.right_closed_bin(size, [10, 20, 50]).alias("bin"),
    )


@query("SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'Merged OK' WHEN o_orderkey % 5 = 1 THEN 'Frac. contribution < 5%' WHEN o_orderkey % 5 = 2 THEN 'Too few compounds' WHEN o_orderkey % 5 = 3 THEN 'No group partner' ELSE 'Other' END AS reason, count(*) AS n FROM orders GROUP BY 1")
def reason_groups(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    reason = F.when(k == 0, "successfully_merged").when(k == 1, "insufficient_fractional_contribution").when(k == 2, "insufficient_compounds (12)").when(k == 3, "group_qualified_pass1").otherwise("else")
    return table(spark, d, "orders").groupBy(text.reason_group(reason).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {M}, t AS (SELECT region, assay_id, activity_type, unit, count(*) AS n FROM m GROUP BY ALL), q AS (SELECT region, median(n) AS middle, max(n) AS most FROM t GROUP BY region)
SELECT region, count(*) AS rows, count(DISTINCT compound_id) AS cpds, count(DISTINCT assay_id) AS assays, count(DISTINCT doc_id) AS documents, count(*) FILTER (value IS NULL) AS without_value, count(*) FILTER (unit IS NULL) AS without_unit,
 count(*) FILTER (text_flag = 1) AS flagged_active, count(*) FILTER (text_flag = -1) AS flagged_inactive, count(*) FILTER (relation = '=') AS equal, count(*) FILTER (relation = '<') AS lower, count(*) FILTER (relation = '>') AS higher,
 count(DISTINCT compound_id) FILTER (target_class = 'ORGANISM') AS organism_cpds, count(*) FILTER (target_class = 'ORGANISM') AS organism_rows, count(DISTINCT compound_id) FILTER (activity_type = 'MIC') AS mic_cpds, count(DISTINCT compound_id) FILTER (activity_type = 'IC50') AS ic50_cpds,
 count(*) FILTER (direction = 1) AS rising, count(*) FILTER (direction = -1) AS falling, count(*) FILTER (direction IS NULL) AS undirected, min(value) AS low, max(value) AS high, any_value(middle) AS middle, any_value(most)::BIGINT AS most,
 count(*) FILTER (value IS NULL) / count(*) AS null_share, count(DISTINCT compound_id) / (SELECT count(DISTINCT compound_id) FROM m) AS space_share FROM m JOIN q USING (region) GROUP BY region""")
def entity_report(spark: SparkSession, d: str) -> DataFrame:
    """One row of metrics for each region: rows, compounds, assays, flags, relations, classes, types, shares."""
    m = measurements(spark, d)
    n, has = F.count_if, F.col
    distinct = {"cpds": None, "organism_cpds": has("target_class") == "ORGANISM", "mic_cpds": has("activity_type") == "MIC", "ic50_cpds": has("activity_type") == "IC50"}
    # distinct compounds by one pass over (region, compound), with flags for the filters
    per = m.groupBy("region", "compound_id").agg(*(F.bool_or(c).alias(k) for k, c in distinct.items() if c is not None))
    per = per.where("compound_id IS NOT NULL").groupBy("region").agg(F.count("*").alias("cpds"), *(F.count_if(F.col(k)).alias(k) for k, c in distinct.items() if c is not None))
    sizes = m.groupBy("region", "assay_id", "activity_type", "unit").agg(F.count("*").alias("n")).groupBy("region").agg(F.percentile("n", F.lit(0.5)).alias("middle"), F.max("n").alias("most"))
    few = [m.groupBy("region", c).agg(F.lit(1)).where(F.col(c).isNotNull()).groupBy("region").agg(F.count("*").alias(a)) for c, a in (("assay_id", "assays"), ("doc_id", "documents"))]
    rows = m.groupBy("region").agg(
        F.count("*").alias("rows"), n(has("value").isNull()).alias("without_value"), n(has("unit").isNull()).alias("without_unit"), n(has("text_flag") == 1).alias("flagged_active"), n(has("text_flag") == -1).alias("flagged_inactive"),
        *(n(has("relation") == r).alias(a) for r, a in (("=", "equal"), ("<", "lower"), (">", "higher"))), n(has("target_class") == "ORGANISM").alias("organism_rows"),
        n(has("direction") == 1).alias("rising"), n(has("direction") == -1).alias("falling"), n(has("direction").isNull()).alias("undirected"), F.min("value").alias("low"), F.max("value").alias("high"), (n(has("value").isNull()) / F.count("*")).alias("null_share"),
    )
    universe = m.select("compound_id").where("compound_id IS NOT NULL").distinct().count()
    out = rows.join(per, "region").join(sizes, "region")
    for other in few:
        out = out.join(other, "region")
    return out.withColumn("space_share", F.col("cpds") / F.lit(universe))


_CONFORMING = "c_custkey long NOT NULL, c_name string NOT NULL, c_acctbal double NOT NULL, c_note string"


@query("""WITH r AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 11 = 0 THEN c_nationkey END AS c_note FROM customer)
SELECT 'c_custkey' AS field, 'integer' AS kind, true AS required, count(*) AS present, 0::BIGINT AS missing, 0::BIGINT AS mistyped FROM r
UNION ALL SELECT 'c_name', 'string', true, count(*), 0, 0 FROM r
UNION ALL SELECT 'c_acctbal', 'number', true, count(c_acctbal), count(*) - count(c_acctbal), 0 FROM r
UNION ALL SELECT 'c_note', 'string', false, count(c_note), count(*) - count(c_note), count(c_note) FROM r""")
def type_schema(spark: SparkSession, d: str) -> DataFrame:
    """Customers as JSON answers, some without a required field, some with a number for a text, held against the JSON schema of a type."""
    schema = files.json_schema(spark.createDataFrame([], _CONFORMING).schema)
    key = F.col("c_custkey")
    answers = table(spark, d, "customer").select(F.to_json(F.struct("c_custkey", "c_name", F.when(key % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"), F.when(key % 11 == 0, F.col("c_nationkey")).alias("c_note"))).alias("answer"))
    return files.conformance(answers, "answer", schema)


@query(None)
def diversity_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of like vectors (by their signs) in each class, at three thresholds; tests hold it against a recursive restatement."""
    rows = table(spark, d, "embeddings").select("label", diversity.fingerprint(F.col("embedding")).alias("words"))
    return diversity.cluster_counts(rows, ["label"], "words")


@query("""SELECT 'chain-' || n_regionkey || '-' || i // 2 || '.json' AS page_file, i // 2 AS page, n_nationkey, n_name FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i FROM nation)""")
def linked_pages(spark: SparkSession, d: str) -> DataFrame:
    """Nations written as pages of two, a chain for each region; only first pages are told, links lead to the rest."""
    folder = _folder(spark, "pages")
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    nations = table(spark, d, "nation").withColumn("page", F.floor((F.row_number().over(w) - 1) / 2).cast("int"))
    made = nations.groupBy("n_regionkey", "page").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("results"))
    name = lambda page: F.concat(F.lit("chain-"), F.col("n_regionkey"), F.lit("-"), page, F.lit(".json"))
    last = F.max("page").over(Window.partitionBy("n_regionkey"))
    following = F.when(F.col("page") < last, F.concat(F.lit(f"{folder}/"), name(F.col("page") + 1)))
    made = made.select(name(F.col("page")).alias("file"), F.lit(None).cast("string").alias("member"), F.lit(0).alias("part"), F.encode(F.to_json(F.struct("results", following.alias("next"))), "UTF-8").alias("content"))
    archives.write_files(made, folder, zipped=False)
    first = [f"{folder}/chain-{r.n_regionkey}-0.json" for r in nations.select("n_regionkey").distinct().collect()]  # a chain each
    read = pages.read_linked(spark, first, "n_nationkey int, n_name string", pause="0.01")
    return read.select(F.substring_index("address", "/", -1).alias("page_file"), F.col("page").cast("long").alias("page"), "n_nationkey", "n_name")



@query("""WITH o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'high' ELSE 'middle' END AS level, o_orderstatus AS dataset, o_orderkey, o_totalprice FROM orders), g AS (SELECT level, dataset, count(*) AS n, sum(o_orderkey)::BIGINT AS keys, count(o_totalprice) AS priced FROM o GROUP BY ALL)
SELECT level || '.zip' AS file, dataset || '.csv.gz' AS member, n, n AS told, keys, priced, 0 AS malformed FROM g UNION ALL SELECT 'low.zip', NULL, 0, 0, 0, 0, 0""")
def archives_with_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Orders as archives by level, a member for each status and one of metadata; the level without orders is there too. Read back and counted."""
    folder = f"{_folder(spark, 'archives')}/exports"
    level = F.when(F.col("o_orderkey") % 3 == 0, "high").otherwise("middle").alias("level")
    orders = table(spark, d, "orders").select(level, F.col("o_orderstatus").alias("dataset"), "o_orderkey", "o_totalprice")
    archives.write_archives(orders, folder, "level", "dataset", always=["low", "middle", "high"])
    read = archives.read_members(spark, folder, T._parse_datatype_string("o_orderkey long, o_totalprice double"))
    rows = read.groupBy("file", "member").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.count("o_totalprice").alias("priced"), F.count("malformed").alias("malformed"))
    told = archives.read_members(spark, folder, T._parse_datatype_string("dataset string, rows long"), archives.METADATA)
    told = told.select("file", F.concat("dataset", F.lit(".csv.gz")).alias("member"), F.col("rows").alias("told"))
    files_ = archives.list_members(spark, folder).select("file").distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return files_.join(rows.join(told, ["file", "member"], "full"), "file", "left").select("file", "member", *map(zero, ("n", "told", "keys", "priced", "malformed")))


@query("SELECT vec_id, label, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings WHERE vec_id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def keyed_subset(spark: SparkSession, d: str) -> DataFrame:
    """Vectors in a keyed store, read for the keys of another table."""
    path = f"{_folder(spark, 'keyed')}/vectors"
    keyed.write_keyed(table(spark, d, "embeddings"), path, "vec_id", buckets=16)
    keys = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("vec_id"))
    return keyed.read_keyed(spark, path, "vec_id", keys).select("vec_id", "label", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"))


@query("""WITH k AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'short' WHEN o_orderkey % 13 = 0 THEN 'long' WHEN o_orderkey % 7 = 0 THEN 'no number' ELSE 'good' END AS kind, o_orderkey, o_totalprice FROM orders)
SELECT count(*) AS lines, count(*) FILTER (kind IN ('short', 'long')) AS malformed, count(*) FILTER (kind = 'no number') AS without_price, sum(o_orderkey) FILTER (kind IN ('good', 'no number'))::BIGINT AS keys FROM k""")
def malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with too few or too many cells are told, cells of another type are null, and all lines add up."""
    path = f"{_folder(spark, 'lines')}/orders"
    k = F.col("o_orderkey")
    price = F.when(k % 7 == 0, F.lit("dear")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.when(k % 11 == 0, k.cast("string")).when(k % 13 == 0, F.concat_ws(",", k, "o_totalprice", F.lit("x"))).otherwise(F.concat_ws(",", k, price))
    table(spark, d, "orders").select(line.alias("value")).unionByName(spark.createDataFrame([("o_orderkey,o_totalprice",)], "value string")).write.text(path)
    read = files.read_lines(spark, path, T._parse_datatype_string("o_orderkey long, o_totalprice double"))
    good = F.col("malformed").isNull()
    return read.agg(F.count("*").alias("lines"), F.count("malformed").alias("malformed"), F.count_if(good & F.col("o_totalprice").isNull()).alias("without_price"), F.sum("o_orderkey").alias("keys"))


@query(None)
def leaf_order(spark: SparkSession, d: str) -> DataFrame:
    """Assays (of 50 compounds at least) in the order of average linkage by their overlaps; tests hold it against one-at-a-time linkage."""
    sets = measurements(spark, d)
    shares = Scratch(spark, "shares").keep(joins.overlaps(sets, "assay_id", "compound_id", least=50).select("key_1", "key_2", "share"), "rows")  # read for pairs and for leaves
    pairs = shares.where("key_1 < key_2").select(F.col("key_1").alias("a"), F.col("key_2").alias("b"), F.col("share").alias("similarity"))
    return linkage.leaf_order(pairs, shares.where("key_1 = key_2").select(F.col("key_1").alias("leaf")))


@query("""WITH e AS (SELECT user_id, event_type, epoch_us(ts) AS micros, event_id, value FROM events), old AS (SELECT user_id, event_type, max((micros, event_id)) AS top FROM e WHERE event_id % 3 <> 0 GROUP BY ALL)
SELECT e.user_id, e.event_type, max(micros) AS micros, arg_max(event_id, (micros, event_id)) AS event_id, arg_max(value, (micros, event_id)) AS value, count(*) FILTER (event_id % 3 = 0 AND (micros, event_id) <= top) AS late_rows FROM e LEFT JOIN old USING (user_id, event_type) GROUP BY ALL""")
def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream of files in two runs, the second from the first's checkpoint: each user's latest of each type, and rows that came late."""
    folder = _folder(spark, "latest")
    events = table(spark, d, "events").select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), "event_id", "value")
    for rows in (events.where("event_id % 3 <> 0"), events.where("event_id % 3 = 0")):
        rows.repartition(3).write.mode("append").parquet(f"{folder}/in")
        latest.run_latest(f"{folder}/in", events.schema, f"{folder}/out", f"{folder}/checkpoint", ["user_id", "event_type"], ["micros", "event_id"], ["value"], spark)
    return latest.as_of_now(spark, f"{folder}/out", ["user_id", "event_type"])


_BINS = 12


@query(f"""WITH p AS (SELECT embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), w AS (SELECT count(*) AS n, min(x) AS lx, (max(x) - min(x)) / {_BINS} AS sx, min(y) AS ly, (max(y) - min(y)) / {_BINS} AS sy, stddev_samp(x) * pow(count(*), -1.0 / 6) AS hx, stddev_samp(y) * pow(count(*), -1.0 / 6) AS hy FROM p),
c AS (SELECT least(floor((x - lx) / sx), {_BINS - 1})::INT AS i, least(floor((y - ly) / sy), {_BINS - 1})::INT AS j, count(*) AS n FROM p, w GROUP BY 1, 2), g AS (SELECT a.i::INT AS i, b.i::INT AS j FROM range({_BINS}) a(i), range({_BINS}) b(i))
SELECT g.i, g.j, coalesce(any_value(c.n) FILTER (c.i = g.i AND c.j = g.j), 0) AS n, round(sum(c.n * exp(-0.5 * pow((g.i - c.i) * sx / hx, 2)) * exp(-0.5 * pow((g.j - c.j) * sy / hy, 2))) / any_value(2 * pi() * w.n * hx * hy), 9) AS density FROM g, c, w GROUP BY g.i, g.j""")
def density_grid(spark: SparkSession, d: str) -> DataFrame:
    """Density of the vectors over their first two dimensions."""
    e = table(spark, d, "embeddings").select(F.get("embedding", F.lit(0)).alias("x"), F.get("embedding", F.lit(1)).alias("y"))
    return components.density(e, "x", "y", _BINS).select("i", "j", "n", F.round("density", 9).alias("density"))


@query(None)
def principal_components(spark: SparkSession, d: str) -> DataFrame:
    """Each vector's coordinates along the first two principal components, with these components' shares of the variance; tests hold it against a whole decomposition."""
    e = table(spark, d, "embeddings")
    _, mean, covariance = components.moments(e, "embedding")
    values, directions = components.principal(covariance, 2)
    shares = values / covariance.trace()
    at = components.projected(e, "embedding", mean, directions)
    return e.select("vec_id", "label", at.alias("at")).select("vec_id", "label", *(F.get("at", F.lit(i)).alias(f"pc{i + 1}") for i in range(2)), *(F.lit(float(s)).alias(f"share{i + 1}") for i, s in enumerate(shares)))


#: Links that read the same from both ends: letter, spelling, other spelling, atoms, weight.
_LINKS = [
    ("a", "C", "[CH2]", 1, 14.027), ("b", "N", "[NH]", 1, 15.015), ("c", "O", "[O]", 1, 15.999), ("d", "C(=O)", "C(=[O])", 2, 28.01),
    ("e", "c1ccc(cc1)", "c7ccc(cc7)", 6, 76.098), ("f", "C(C)(C)", "C([CH3])(C)", 3, 42.081), ("g", "S(=O)(=O)", "S(=O)(=O)", 3, 64.058),
]
_LETTERS = "translate(lower(replace(p_name, ' ', '')), 'abcdefghijklmnopqrstuvwxyz', 'abcdefgabcdefgabcdefgabcde')"
_ATOMS = " + ".join(f"{x[3]} * (length(w) - length(replace(w, '{x[0]}', '')))" for x in _LINKS)
_WEIGHT = " + ".join(f"{x[4]}::DOUBLE * (length(w) - length(replace(w, '{x[0]}', '')))" for x in _LINKS)
_CHAIN = f"'a' || {_LETTERS} || repeat('a', (p_partkey % 5)::INT) || repeat('b', (p_size % 3)::INT) || 'a'"


@query(f"""WITH p AS (SELECT p_partkey, {_CHAIN} AS w FROM part)
SELECT p_partkey, min(p_partkey) OVER (PARTITION BY least(w, reverse(w))) AS first_key, {_ATOMS} AS n_atoms, round(2.016 + {_WEIGHT}, 3) AS weight, 4 * ({_ATOMS}) AS fragments, true AS same_print FROM p""")
def structure_keys(spark: SparkSession, d: str) -> DataFrame:
    """Chains spelled by the parts' names, the one half from their ends and with a salt: the first part of each structure, its weight and its fragments."""
    letters = F.expr(_CHAIN.replace("::INT", "")).alias("w")
    spell = lambda w, column: F.array_join(F.transform(F.filter(F.split(w, ""), lambda x: x != ""), lambda x: F.create_map(*(F.lit(y) for link in _LINKS for y in (link[0], link[column])))[x]), "")
    w = table(spark, d, "part").select("p_partkey", letters)
    inner = F.substring("w", F.lit(2), F.length("w") - 2)
    texts = w.select("p_partkey", spell(F.col("w"), 1).alias("there"), F.concat(F.lit("[Na+].[Cl-].C"), spell(F.reverse(inner), 2), F.lit("C")).alias("back"))
    spelled = texts.select(F.explode(F.array("there", "back")).alias("text"))
    known = Scratch(spark, "structures").keep(structures.dictionary(spelled, "text").drop("structure"), "rows")
    there = known.select(F.col("text").alias("there"), "key", F.size("parent.atoms").cast("long").alias("n_atoms"), F.col("fingerprint").alias("f"))
    back = known.select(F.col("text").alias("back"), F.col("key").alias("key_back"), "weight", F.col("fingerprint").alias("g"))
    told = texts.join(there, "there").join(back, "back")
    told = told.withColumn("key", F.when(F.col("p_partkey") % 2 == 0, F.col("key")).otherwise(F.col("key_back")))
    first = told.groupBy("key").agg(F.min("p_partkey").alias("first_key"))
    fragments = F.aggregate("f", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return told.select("p_partkey", "key", "n_atoms", "weight", fragments.alias("fragments"), (F.col("f") == F.col("g")).alias("same_print")).join(first, "key").drop("key")
