"""Work in batches that can stop and go on: committed keys, late duplicates, streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quantarium.operators.joins import nullsafe_join
from quantarium.session import ship_package


def remaining(source: DataFrame, committed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not committed yet; null keys count as equal."""
    return nullsafe_join(source, committed.select(*keys).distinct(), keys, "left_anti")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def windowed_counts(events: DataFrame, time: str, key: str, value: str, width: str, late: str) -> DataFrame:
    """Counts and sums of tumbling windows; works on tables and on streams (rows later than `late` are dropped there)."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), key, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str) -> DataFrame:
    """Runs of a key's events with pauses shorter than gap."""
    out = events.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def process_new_files(spark: SparkSession, source: str, schema, target: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Apply step to the files that are new since the last run and stop; a batch that runs twice writes once."""

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retried(step: Callable[[list], list], items: list, size: int = 6, tries: int = 3) -> list:
    """step's answers in batches of `size`: a batch that fails `tries` times is tried item by item, and an item that fails is None."""
    out: list = []
    for at in range(0, len(items), size):
        batch = items[at : at + size]
        for _ in range(tries):
            try:
                found = step(batch)
                if len(found) == len(batch):
                    break
            except Exception:  # noqa: BLE001  a step is a foreign service
                continue
        else:
            found = [None] if len(batch) == 1 else [x for item in batch for x in retried(step, [item], 1, tries)]
        out += found
    return out


def answered(df: DataFrame, item: str, step: Callable[[list], list], kind: str = "string", size: int = 6, tries: int = 3) -> DataFrame:
    """The rows and step's `answer` to each item, asked by the tasks in batches of `size` with retries, then item by item; null if it fails.

    A task that is lost asks its rows again, so step should not count its calls. Null items are not asked.
    """
    if "answer" in df.columns:
        raise ValueError("the rows have an answer already")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            there = frame[item].notna().to_numpy()
            answers = pd.Series([None] * len(frame), index=frame.index, dtype=object)
            answers[there] = retried(step, frame.loc[there, item].tolist(), size, tries)
            yield frame.assign(answer=answers)

    ship_package(df.sparkSession)
    return df.mapInPandas(ask, T.StructType([*df.schema.fields, *T._parse_datatype_string(f"answer {kind}").fields]))
