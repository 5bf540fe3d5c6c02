"""The measurement model over the star-schema tables, and its rule tables.

Columns: assay_id, compound_id, smiles (structure text), mw, doc_id, organism, region, activity_type,
unit (nullable), direction (nullable), value (nullable), relation, text_flag, target_class, and the
row's own keys. A triplet is (assay_id, activity_type, unit).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIPLET = ["assay_id", "activity_type", "unit"]

#: activity_type, unit, target_class, direction, thresholds as written (ascending).
THRESHOLDS = [
    ("MIC", "umol.L-1", "ORGANISM", -1, "5;10;20"),
    ("IC50", "umol.L-1", "ORGANISM", -1, "5;10;20"),
    ("IC50", "umol.L-1", "SINGLE PROTEIN", -1, "0.5;1;5"),
    ("INHIBITION", "%", "ORGANISM", 1, "50;75;90"),
    ("INHIBITION", "%", "SINGLE PROTEIN", 1, "50;75;90"),
]
THRESHOLD_SCHEMA = T.StructType(
    [T.StructField("activity_type", T.StringType(), False), T.StructField("unit", T.StringType()), T.StructField("target_class", T.StringType(), False),
     T.StructField("direction", T.IntegerType(), False), T.StructField("threshold_text", T.StringType(), False)]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def measurements(spark: SparkSession, folder: str) -> DataFrame:
    """One row a measurement; small dimensions are joined by Spark's own choice of strategy."""
    items, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    suppliers, nations, regions = table(spark, folder, "supplier"), table(spark, folder, "nation"), table(spark, folder, "region")
    assays = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    df = items.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").join(assays, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    tax, discount, n = F.round("l_tax", 2), F.round("l_discount", 2), F.col("l_returnflag") == "N"
    filled = F.col("l_linestatus") == "F"
    return df.select(
        F.col("l_suppkey").alias("assay_id"), F.col("l_partkey").alias("compound_id"), F.concat_ws(" ", "p_name", "p_brand").alias("smiles"), F.col("p_retailprice").alias("mw"),
        F.col("s_nationkey").alias("doc_id"), F.col("n_name").alias("organism"), F.col("r_name").alias("region"),
        F.when(F.col("l_returnflag") == "A", "MIC").when(F.col("l_returnflag") == "R", "IC50").otherwise("INHIBITION").alias("activity_type"),
        F.when(~n, "umol.L-1").when(filled, "%").alias("unit"),
        F.when(~n, -1).when(filled, 1).alias("direction"),
        F.when(tax != 0.08, F.col("l_quantity") * F.when(n, 2).otherwise(1)).alias("value"),
        F.when(discount == 0.10, ">").when(discount == 0.0, "<").otherwise("=").alias("relation"),
        F.when((tax == 0.0) & filled, 1).when(tax == 0.08, -1).otherwise(0).alias("text_flag"),
        F.when(F.col("l_suppkey") % 10 < 6, "ORGANISM").when(F.col("l_suppkey") % 10 < 9, "SINGLE PROTEIN").otherwise("DISCARDED").alias("target_class"),
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"), F.col("l_shipdate").alias("measured_at"),
    )


#: The same model in SQL, for the queries' checks.
MEASUREMENTS_SQL = """m AS (
SELECT l_suppkey AS assay_id, l_partkey AS compound_id, p_name || ' ' || p_brand AS smiles, p_retailprice AS mw, s_nationkey AS doc_id, n_name AS organism, r_name AS region,
 CASE l_returnflag WHEN 'A' THEN 'MIC' WHEN 'R' THEN 'IC50' ELSE 'INHIBITION' END AS activity_type,
 CASE WHEN l_returnflag <> 'N' THEN 'umol.L-1' WHEN l_linestatus = 'F' THEN '%' END AS unit,
 CASE WHEN l_returnflag <> 'N' THEN -1 WHEN l_linestatus = 'F' THEN 1 END AS direction,
 CASE WHEN round(l_tax, 2) <> 0.08 THEN l_quantity * CASE WHEN l_returnflag = 'N' THEN 2 ELSE 1 END END AS value,
 CASE WHEN round(l_discount, 2) = 0.10 THEN '>' WHEN round(l_discount, 2) = 0 THEN '<' ELSE '=' END AS relation,
 CASE WHEN round(l_tax, 2) = 0 AND l_linestatus = 'F' THEN 1 WHEN round(l_tax, 2) = 0.08 THEN -1 ELSE 0 END AS text_flag,
 CASE WHEN l_suppkey % 10 < 6 THEN 'ORGANISM' WHEN l_suppkey % 10 < 9 THEN 'SINGLE PROTEIN' ELSE 'DISCARDED' END AS target_class,
 l_orderkey AS order_id, l_linenumber AS line_id, l_shipdate AS measured_at
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

#: Thresholds in SQL: position 1 is the most lenient.
THRESHOLDS_SQL = """t AS (
SELECT * FROM (VALUES ('MIC', 'umol.L-1', 'ORGANISM', 1, 20.0::DOUBLE), ('MIC', 'umol.L-1', 'ORGANISM', 2, 10.0), ('MIC', 'umol.L-1', 'ORGANISM', 3, 5.0),
 ('IC50', 'umol.L-1', 'ORGANISM', 1, 20.0), ('IC50', 'umol.L-1', 'ORGANISM', 2, 10.0), ('IC50', 'umol.L-1', 'ORGANISM', 3, 5.0),
 ('IC50', 'umol.L-1', 'SINGLE PROTEIN', 1, 5.0), ('IC50', 'umol.L-1', 'SINGLE PROTEIN', 2, 1.0), ('IC50', 'umol.L-1', 'SINGLE PROTEIN', 3, 0.5),
 ('INHIBITION', '%', 'ORGANISM', 1, 50.0), ('INHIBITION', '%', 'ORGANISM', 2, 75.0), ('INHIBITION', '%', 'ORGANISM', 3, 90.0),
 ('INHIBITION', '%', 'SINGLE PROTEIN', 1, 50.0), ('INHIBITION', '%', 'SINGLE PROTEIN', 2, 75.0), ('INHIBITION', '%', 'SINGLE PROTEIN', 3, 90.0)) AS v(activity_type, unit, target_class, place, cutoff))"""


def threshold_rules(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Thresholds with an array, most lenient first (`thresholds`)."""
    from quantarium.functions.numeric import thresholds

    df = spark.createDataFrame(rows or THRESHOLDS, THRESHOLD_SCHEMA)
    return df.withColumn("thresholds", thresholds(F.col("threshold_text"), F.col("direction")))
