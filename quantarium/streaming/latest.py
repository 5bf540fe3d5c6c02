"""The latest row of each key of a stream, kept as state with a time to live, and how many rows came late.

A key's state is one row, so its size is that of the keys seen within the time to live, however many rows come. The state after each
batch is a table beside the checkpoint's own files: a batch joins its rows with the state of the batch before, in Spark's own rows, so no key
costs a call of Python. A stream that is stopped goes on where it was, and a batch that runs twice reads the same state and
overwrites what it wrote. Each batch writes the whole state anew, which suits batches of many keys.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantarium.operators.joins import nullsafe_join


def touched(batch: DataFrame, state: DataFrame | None, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """keys, order, values and late_rows of each key of the batch, as of that batch; order columns are numbers without nulls.

    A row is late if the state's, from before its batch, is at or after it. The state's row stays if none of the batch is after it.
    """
    row, at = F.struct(*order, *values), F.struct(*order)
    rows = batch.select(*keys, row.alias("_row"), at.alias("_at"))
    if state is None:
        best = rows.groupBy(*keys).agg(F.max_by("_row", "_at").alias("_row"))
        return best.select(*keys, "_row.*", F.lit(0).cast("long").alias("late_rows"))
    told = nullsafe_join(rows, state.select(*keys, row.alias("_old"), at.alias("_before"), F.col("late_rows").alias("_late")), keys, "left")
    late = F.count_if(F.coalesce(F.col("_at") <= F.col("_before"), F.lit(False)))
    # a key has one row in the state, so any of its rows has it
    best = told.groupBy(*keys).agg(F.max_by("_row", "_at").alias("_row"), F.max("_at").alias("_at"), F.first("_old").alias("_old"), F.first("_before").alias("_before"), F.first("_late").alias("_late"), late.alias("_n"))
    new = F.coalesce(F.col("_at") > F.col("_before"), F.lit(True))
    best = best.select(*keys, F.when(new, F.col("_row")).otherwise(F.col("_old")).alias("_row"), (F.coalesce("_late", F.lit(0)) + F.col("_n")).alias("late_rows"))
    return best.select(*keys, "_row.*", "late_rows")


def run_latest(source: str, schema: T.StructType, target: str, checkpoint: str, keys: list[str], order: list[str], values: list[str], spark, ttl_ms: int | None = None) -> None:
    """Takes in the files that are new since the last run, and stops; each batch's keys are a table of their own under the target."""
    fields = {f.name: f.dataType for f in schema}
    kind = T.StructType([*(T.StructField(c, fields[c]) for c in [*keys, *order, *values]), T.StructField("late_rows", T.LongType())])
    folder = f"{checkpoint}/latest"

    def write(batch: DataFrame, number: int) -> None:
        session, now = batch.sparkSession, int(time.time() * 1000)
        state = None
        if number:
            state = session.read.schema(T.StructType([*kind, T.StructField("seen", T.LongType())])).parquet(f"{folder}/batch={number - 1}")
            state = state if ttl_ms is None else state.where(F.col("seen") + ttl_ms > now)
        touched(batch, state, keys, order, values).write.mode("overwrite").parquet(f"{target}/batch={number}")
        told = session.read.schema(kind).parquet(f"{target}/batch={number}")
        after = told.withColumn("seen", F.lit(now))
        after = after if state is None else after.unionByName(nullsafe_join(state, told.select(*keys), keys, "left_anti"))
        after.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        # the batch may run again, for which it needs the state before it
        path = session._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch={number - 2}")
        path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def as_of_now(spark, target: str, keys: list[str]) -> DataFrame:
    """Each key's row of the last batch that touched it."""
    told = spark.read.parquet(target)
    rest = [c for c in told.columns if c not in (*keys, "batch")]
    return told.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")
