"""Rows to be found by a key: buckets of sorted files with Bloom filters, of which a read of some keys opens few."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys up to which a read tells the files each key, for their Bloom filters and row groups; beyond it joins.
PUSHED_KEYS = 1_000


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = 64, group_bytes: int = 8 << 20) -> None:
    """A folder a bucket of the key's hash, rows in order of the key; row groups are small, so that their statistics and filters tell keys apart."""
    rows = df.withColumns({"buckets": F.lit(buckets), "bucket": _bucket(F.col(f"`{key}`"), buckets)})
    ordered = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", f"`{key}`")
    options = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.block.size": str(group_bytes), "compression": "zstd"}
    ordered.write.partitionBy("buckets", "bucket").options(**options).mode("overwrite").parquet(path)


def read_keyed(spark: SparkSession, path: str, key: str, keys: DataFrame | list | None = None) -> DataFrame:
    """All rows, or those of the keys (a list, or a table with the column); keys that aren't there have no row.

    The buckets of a table's keys, at most as many as there are buckets, come to the driver first, so that only their folders are opened.
    """
    stored = spark.read.parquet(path)
    rows = stored.drop("buckets", "bucket")
    if keys is None:
        return rows
    if isinstance(keys, list):
        keys = spark.createDataFrame([(k,) for k in keys], f"`{key}` {rows.schema[key].dataType.simpleString()}")
    buckets = stored.select(F.max("buckets")).first()[0]
    if buckets is None:
        return rows
    wanted = keys.select(F.col(f"`{key}`").cast(rows.schema[key].dataType).alias(key)).where(F.col(f"`{key}`").isNotNull()).distinct()
    opened = [r[0] for r in wanted.select(_bucket(F.col(f"`{key}`"), buckets)).distinct().collect()]
    found = stored.where(F.col("bucket").isin(opened))
    few = [r[0] for r in wanted.limit(PUSHED_KEYS + 1).collect()]
    if len(few) <= PUSHED_KEYS:
        found = found.where(F.col(f"`{key}`").isin(few))
    else:
        found = found.join(wanted, key, "left_semi")
    return found.drop("buckets", "bucket")
