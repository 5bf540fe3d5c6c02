"""Files, databases and archives as DataFrames, and back."""

from __future__ import annotations

import gzip
import io
import re
import urllib.request
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cell texts that count as missing.
MISSING = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "<NA>"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",", comment: str | None = None, header: bool = True, multi_line: bool = False) -> DataFrame:
    """CSV (gzip by its ending) with an explicit schema; all spellings of a missing cell are null.

    Line breaks inside cells need multi_line, with which a file is one task's however large it is.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.schema(text).option("header", header).option("sep", separator).option("multiLine", multi_line).option("escape", '"')
    raw = (reader.option("comment", comment) if comment else reader).csv(path)
    cells = (F.when(~F.trim(F.col(f"`{f.name}`")).isin(MISSING), F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name) for f in schema)
    return raw.select(*cells)


def read_lines(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Lines of CSV files with a header, cut anywhere for the tasks: typed columns, and `malformed`, the line itself if it hasn't the schema's cells.

    No line is lost: good and malformed ones add up to the files' lines less the headers. A cell that isn't of its type is null.
    """
    names = [f"c{i}" for i in range(len(schema))]
    cells = ", ".join(f"{n} string" for n in names) + ", malformed string"
    lines = spark.read.text(path).where(F.col("value") != separator.join(schema.names))
    read = lines.select("value", F.from_csv("value", cells, {"sep": separator, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}).alias("r"))
    whole = F.col("r.malformed").isNull()
    columns = (F.when(whole & ~F.trim(F.col(f"r.{n}")).isin(MISSING), F.col(f"r.{n}")).try_cast(f.dataType).alias(f.name) for n, f in zip(names, schema))
    return read.select(*columns, F.when(~whole, F.col("value")).alias("malformed"))


def read_optional(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet") -> DataFrame:
    """The table at path, or an empty one if nothing is there."""
    try:
        df = read_csv(spark, path, schema) if form == "csv" else spark.read.format(form).load(path)
        return df.select(*(f"`{n}`" for n in schema.names))
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_ids(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """One id a line, or several with a separator; blanks are dropped, a missing file is empty."""
    schema = T.StructType([T.StructField("id", T.StringType())])
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    lines = lines.select(F.explode(F.split("value", split)).alias("value")) if split else lines
    return lines.select(F.trim("value").alias("id")).where("id <> ''").distinct()


def read_database(spark: SparkSession, url: str, relation: str, columns: list[str] | None = None, key: str | None = None, low: int = 0, high: int = 0, parts: int = 32, **options: str) -> DataFrame:
    """A table over JDBC, read in parts of a numeric key; the columns are pushed to the source."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=relation, **options)
    if key:
        reader = reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    df = reader.load()
    return df.select(*columns) if columns else df


def read_archives(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Members (gzip CSV) of zip archives as one table with a `member` column; a broken member is empty."""
    return _unzipped(spark.read.format("binaryFile").load(path).select("content"), schema)


def read_zipped(archives: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of archives kept in a table (a column content)."""
    return _unzipped(archives.select("content"), schema)


def _unzipped(contents: DataFrame, schema: T.StructType) -> DataFrame:
    names = [f.name for f in schema]

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in sorted(n for n in archive.namelist() if n.endswith(".csv.gz")):
                        try:
                            part = pd.read_csv(io.BytesIO(archive.read(member)), compression="gzip", on_bad_lines="skip", dtype=str)
                        except (OSError, EOFError, pd.errors.EmptyDataError):
                            continue
                        yield part.reindex(columns=names).assign(member=member).astype(object).where(lambda x: x.notna(), None)

    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "member"]])
    raw = contents.mapInPandas(unpack, text)
    return raw.select("member", *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))


def zipped(df: DataFrame, by: str, rows: int = 100_000) -> DataFrame:
    """`by`, member and content: zip archives with one gzip CSV each, of at most about `rows` rows of one value.

    Large values have several archives, so that no task holds a value whole; read_zipped reads them back.
    """
    order = [c for c in df.columns if c != by]
    sizes = df.groupBy(by).agg(F.ceil(F.count("*") / rows).cast("int").alias("_parts"))
    parts = df.join(sizes, by).withColumn("_part", F.pmod(F.xxhash64(*order), "_parts")).drop("_parts")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        name = f"{frame[by].iloc[0]}-{frame['_part'].iloc[0]}.csv.gz"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr(name, gzip.compress(frame[order].sort_values(order).to_csv(index=False).encode(), mtime=0))
        return pd.DataFrame({by: [frame[by].iloc[0]], "member": [name], "content": [out.getvalue()]})

    kind = df.schema[by].dataType.simpleString()
    return parts.groupBy(by, "_part").applyInPandas(pack, f"`{by}` {kind}, member string, content binary")


def read_pages(spark: SparkSession, pages: DataFrame, schema: str, fetch: Callable[[str], str] | None = None) -> DataFrame:
    """Results of a paginated source: pages (url) are fetched by the tasks, each an answer with `results`.

    fetch(url) gives the answer's text; by default urllib reads http, https and file addresses.
    """

    def read(url: str) -> str:
        with urllib.request.urlopen(url, timeout=60) as answer:
            return answer.read().decode()

    get = fetch or read

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"url": frame["url"], "answer": [get(u) for u in frame["url"]]})

    answers = pages.select("url").mapInPandas(run, "url string, answer string")
    return answers.select("url", F.explode(records(F.col("answer"), schema)).alias("r")).select("url", "r.*")


def json_schema(schema: T.DataType) -> dict:
    """JSON schema of a Spark type: fields that may not be null are required."""
    if isinstance(schema, T.StructType):
        return {"type": "object", "properties": {f.name: json_schema(f.dataType) for f in schema}, "required": [f.name for f in schema if not f.nullable]}
    if isinstance(schema, T.ArrayType):
        return {"type": "array", "items": json_schema(schema.elementType)}
    if isinstance(schema, T.MapType):
        return {"type": "object", "additionalProperties": json_schema(schema.valueType)}
    return {"type": "boolean" if isinstance(schema, T.BooleanType) else "integer" if isinstance(schema, T.IntegralType) else "number" if isinstance(schema, T.NumericType) else "string"}


def conformance(df: DataFrame, answer: str, schema: dict) -> DataFrame:
    """field, kind, required, present, missing, mistyped: how JSON texts meet the fields of an object's schema.

    One pass with a few counts a field. A field is missing if the text lacks it, holds null there or is no object;
    an integer is a number too. Kinds are looked at one level deep.
    """
    value = F.try_parse_json(df[f"`{answer}`"])
    sorts = {"integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "FLOAT", "DECIMAL"], "string": ["STRING"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}
    # the sort of a value without what it is made of: DECIMAL(3,1) is DECIMAL
    sort = lambda name: F.regexp_extract(F.schema_of_variant(F.col(f"`{name}`")), "^[A-Z]+", 0)
    names = list(schema["properties"])
    fields = df.select(*(F.try_variant_get(value, f'$["{n}"]', "variant").alias(n) for n in names))
    there = {n: F.coalesce(~F.is_variant_null(F.col(f"`{n}`")) & F.col(f"`{n}`").isNotNull(), F.lit(False)) for n in names}
    counts = [F.struct(F.count_if(there[n]).alias("present"), F.count_if(~there[n]).alias("missing"), F.count_if(there[n] & ~sort(n).isin(sorts[schema["properties"][n]["type"]])).alias("mistyped")) for n in names]
    told = [F.struct(F.lit(n).alias("field"), F.lit(schema["properties"][n]["type"]).alias("kind"), F.lit(n in schema["required"]).alias("required"), c.alias("c")) for n, c in zip(names, counts)]
    return fields.agg(F.array(*told).alias("told")).select(F.explode("told").alias("t")).select("t.field", "t.kind", "t.required", "t.c.*")


def nested_values(document: Column, key: str) -> Column:
    """All comma-separated values of a key anywhere in a JSON text, escapes read: trimmed, distinct, in order; none for a null."""
    found = F.regexp_extract_all(F.coalesce(document, F.lit("")), F.lit(rf'"{re.escape(key)}"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))
    read = F.transform(found, lambda x: F.from_json(F.concat(F.lit('{"v":"'), x, F.lit('"}')), "v string")["v"])
    parts = F.flatten(F.transform(F.filter(read, lambda x: x.isNotNull()), lambda x: F.split(x, ",")))
    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")))


def records(answer: Column, schema: str, size: Column | None = None) -> Column:
    """The `results` array of a JSON answer; null if it can't be read or has another length."""
    found = F.from_json(answer, f"struct<results: array<{schema}>>")["results"]
    return F.when(F.size(found) == size, found) if size is not None else found


def last_of_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A dimension with one row a key: the last in the given order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last")).select(*keys, "_last.*")


# sinks


def write_csv(df: DataFrame, path: str, compressed: bool = False) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("compression", "gzip" if compressed else "none").csv(path)


def write_datasets(df: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Rows to one table with a folder for each value of `by`; returns the counts of each."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.groupBy(*by).count()


def append_batch(df: DataFrame, path: str, batch: int) -> None:
    """Results of one batch; written again, they replace themselves."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")
