"""Answers of a paginated service as a Spark data source that follows the links from page to page.

Each first address is a chain of pages and one partition; its pages are known only by their links, so a chain is read in order by one
task and chains in parallel. An answer that can't be had or read is asked for again, after a pause that doubles; a link back is an error.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quantarium.session import ship_package
from quantarium.sources.archives import opened

RETRIES = 3
PAUSE = 0.2
SECONDS = 30


@dataclass
class Chain(InputPartition):
    first: str


def answer(address: str) -> dict:
    if address.startswith(("http://", "https://")):
        request = urllib.request.Request(address, headers={"Accept": "application/json"})
        with urllib.request.urlopen(request, timeout=SECONDS) as found:
            return json.load(found)
    store, path = opened(address)
    with store.open_input_file(path) as found:
        return json.load(found)


class ChainReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.first = json.loads(options["first"])
        self.retries, self.pause = int(options.get("retries", RETRIES)), float(options.get("pause", PAUSE))
        self.results, self.next = options.get("results", "results"), options.get("next", "next")

    def partitions(self) -> list[Chain]:
        return [Chain(x) for x in self.first]

    def ask(self, address: str) -> dict:
        for turn in range(self.retries + 1):
            try:
                return answer(address)
            except (OSError, json.JSONDecodeError):  # urllib's errors are OSErrors
                if turn == self.retries:
                    raise
                time.sleep(self.pause * 2**turn)
        raise AssertionError

    def read(self, partition: Chain) -> Iterator[tuple]:
        address, seen = partition.first, set()
        while address:
            if address in seen:
                raise ValueError(f"the links lead back to {address}")
            found = self.ask(address)
            for result in found.get(self.results) or []:
                yield partition.first, address, len(seen), json.dumps(result)
            seen.add(address)
            address = found.get(self.next)
            if address:
                time.sleep(self.pause)


class LinkedPages(DataSource):
    """Options: first (a JSON list of addresses), retries, pause (seconds), and the names of the fields with results and with the link."""

    @classmethod
    def name(cls) -> str:
        return "linked_pages"

    def schema(self) -> str:
        return "first string, address string, page int, result string"

    def reader(self, schema: T.StructType) -> ChainReader:
        return ChainReader(dict(self.options))


def read_linked(spark: SparkSession, first: list[str], schema: str, **options: str) -> DataFrame:
    """first, address and page (from 0) of each result, and its fields by the schema (a scalar result: the schema `value <type>`)."""
    ship_package(spark)
    spark.dataSource.register(LinkedPages)
    raw = spark.read.format("linked_pages").options(first=json.dumps(first), **options).load()
    whole = F.when(F.col("result").startswith("{"), F.col("result")).otherwise(F.concat(F.lit('{"value":'), "result", F.lit("}")))
    return raw.select("first", "address", "page", F.from_json(whole, schema).alias("r")).select("first", "address", "page", "r.*")
