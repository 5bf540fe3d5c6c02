"""Files of several members as a Spark data source: zip archives of datasets with a metadata member, workbooks, plain files.

Written rows are (file, member, part, content): pieces of members, each of bounded size and made by tasks. A task gets whole
files, in order, and streams their pieces into an attempt folder of its own; the commit moves finished files to their names and the abort
deletes them, so a lost task leaves nothing behind and no file is ever half there. Read rows are (file, member, cells) of the members'
CSV lines, or a listing of the members. Addresses are whatever pyarrow opens (file, hdfs, s3, ...).
"""

from __future__ import annotations

import csv
import gzip
import io
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from quantarium.session import ship_package

PIECES = "file string, member string, part int, content binary"
CELLS = "file string, member string, line long, cells array<string>"
LISTING = "file string, member string, bytes long"
#: Rows of one piece of a member.
PIECE_ROWS = 20_000
METADATA = "metadata.csv"


def opened(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address if "://" in address else f"file://{address}")


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class FilesWriter(DataSourceWriter):
    def __init__(self, root: str, zipped: bool):
        self.root, self.zipped = root, zipped
        self.attempts = f"{root}/_attempts-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[T.Row]) -> Written:
        store, folder = opened(f"{self.attempts}/{uuid.uuid4().hex}")
        store.create_dir(folder)
        done: list[tuple[str, str]] = []
        name = member = sink = archive = piece = None
        try:
            for row in rows:
                if row.file != name:
                    self._close(piece, archive, sink)
                    name, member, piece = row.file, None, None
                    path = f"{folder}/{len(done)}"
                    sink = store.open_output_stream(path)
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) if self.zipped else None
                    done.append((path, name))
                if archive is not None and row.member is not None and row.member != member:
                    if piece is not None:
                        piece.close()
                    member, piece = row.member, archive.open(zipfile.ZipInfo(row.member, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True)
                if row.content is not None:
                    (piece if archive is not None else sink).write(row.content)
        finally:
            self._close(piece, archive, sink)
        return Written(done)

    @staticmethod
    def _close(*parts) -> None:
        for part in parts:
            if part is not None:
                part.close()

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.root)
        for message in messages:
            for path, name in message.files if message else []:
                store.move(path, f"{root}/{name}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        store, folder = opened(self.attempts)
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


@dataclass
class OneFile(InputPartition):
    address: str
    name: str


class MembersReader(DataSourceReader):
    """A partition for each file; members are read as they stream."""

    def __init__(self, root: str, listing: bool):
        self.root, self.listing = root, listing

    def partitions(self) -> list[OneFile]:
        store, root = opened(self.root)
        found = [x for x in store.get_file_info(fs.FileSelector(root)) if x.type == fs.FileType.File]
        return [OneFile(f"{self.root}/{x.base_name}", x.base_name) for x in sorted(found, key=lambda x: x.base_name)]

    def read(self, partition: OneFile) -> Iterator[tuple]:
        store, path = opened(partition.address)
        with store.open_input_file(path) as source, zipfile.ZipFile(source) as archive:
            for info in archive.infolist():
                if self.listing:
                    yield partition.name, info.filename, info.file_size
                    continue
                with archive.open(info) as raw:
                    lines = io.TextIOWrapper(gzip.open(raw) if info.filename.endswith(".gz") else raw, "utf-8", newline="")
                    for at, cells in enumerate(csv.reader(lines)):
                        yield partition.name, info.filename, at, cells


class MemberFiles(DataSource):
    """Options: path; zipped (true: zip archives, false: plain files, written only); listing (true: read names and sizes)."""

    @classmethod
    def name(cls) -> str:
        return "member_files"

    def schema(self) -> str:
        return LISTING if self.options.get("listing") == "true" else CELLS

    def reader(self, schema: T.StructType) -> MembersReader:
        return MembersReader(self.options["path"], self.options.get("listing") == "true")

    def writer(self, schema: T.StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options["path"], self.options.get("zipped", "true") == "true")


def write_files(pieces: DataFrame, path: str, zipped: bool = True) -> None:
    """Pieces (file, member, part, content) as files in the folder; a file is one task's, whose memory holds a piece."""
    spark = pieces.sparkSession
    ship_package(spark)
    spark.dataSource.register(MemberFiles)
    pieces = pieces.select("file", "member", F.col("part").cast("int").alias("part"), F.col("content").cast("binary").alias("content"))
    ordered = pieces.repartition("file").sortWithinPartitions("file", "member", "part")
    ordered.write.format("member_files").mode("append").options(path=path, zipped=str(zipped).lower()).save()


def csv_pieces(df: DataFrame, file: str, member: str, rows: int = PIECE_ROWS) -> DataFrame:
    """Each member's rows as gzip CSV, cut into pieces of about `rows` rows, so that no task holds a large member."""
    names = [c for c in df.columns if c not in (file, member)]
    body = F.struct(*(F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(names)))
    told = df.select(F.col(f"`{file}`").cast("string").alias("file"), F.col(f"`{member}`").cast("string").alias("member"), body.alias("body"))
    sizes = told.groupBy("file", "member").agg(F.ceil(F.count("*") / rows).cast("int").alias("parts"))
    dealt = told.join(sizes, ["file", "member"]).select("file", "member", (1 + F.pmod(F.xxhash64("body"), "parts")).alias("part"), "body")

    def pack(table: pa.Table) -> pa.Table:
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(sorted(tuple("" if x is None else x for x in r.values()) for r in table["body"].to_pylist()))
        first = table.slice(0, 1).select(["file", "member", "part"])
        return first.append_column("content", pa.array([gzip.compress(out.getvalue().encode(), mtime=0)], pa.binary()))

    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(names)
    # gzip streams one after the other are one gzip stream
    heads = sizes.select("file", "member", F.lit(0).alias("part"), F.lit(gzip.compress(header.getvalue().encode(), mtime=0)).alias("content"))
    dealt = dealt.withColumn("part", F.col("part").cast("int"))
    body = dealt.groupBy("file", "member", "part").applyInArrow(pack, PIECES)
    return heads.unionByName(body).withColumn("member", F.concat("member", F.lit(".csv.gz"))).withColumn("file", F.concat("file", F.lit(".zip")))


def write_archives(df: DataFrame, path: str, archive: str, member: str, always: list[str] = (), metadata: DataFrame | None = None) -> None:
    """One zip for each value of `archive` and of `always` (even without rows), with a gzip CSV for each member and a metadata member.

    metadata has the archive's column; by default it tells the members' rows.
    """
    if metadata is None:
        metadata = df.groupBy(archive, member).agg(F.count("*").alias("rows"))
    names = [c for c in metadata.columns if c != archive]
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in names)))
    spark = df.sparkSession
    files = df.select(F.col(f"`{archive}`").cast("string").alias("file")).union(spark.createDataFrame([(x,) for x in always], "file string")).distinct()
    # a line for each member of an archive, as many as it has members
    lines = metadata.select(F.col(f"`{archive}`").cast("string").alias("file"), line.alias("line")).groupBy("file").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("lines"))
    head = ",".join(names) + "\n"
    told = files.join(lines, "file", "left").select(F.concat("file", F.lit(".zip")).alias("file"), F.lit(METADATA).alias("member"), F.lit(0).alias("part"), F.encode(F.concat(F.lit(head), F.coalesce(F.concat("lines", F.lit("\n")), F.lit(""))), "UTF-8").alias("content"))
    write_files(csv_pieces(df, archive, member).unionByName(told), path)


def read_members(spark: SparkSession, path: str, schema: T.StructType, members: str = "%.csv.gz") -> DataFrame:
    """file, member and typed columns of the CSV members; `malformed` holds the cells of a line whose number isn't the schema's, empty cells are null."""
    ship_package(spark)
    spark.dataSource.register(MemberFiles)
    lines = spark.read.format("member_files").option("path", path).load().where((F.col("line") > 0) & F.col("member").like(members))
    whole = F.size("cells") == len(schema)
    columns = [F.when(whole, F.nullif(F.get("cells", F.lit(i)), F.lit(""))).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    return lines.select("file", "member", *columns, F.when(~whole, F.col("cells")).alias("malformed"))


def list_members(spark: SparkSession, path: str) -> DataFrame:
    ship_package(spark)
    spark.dataSource.register(MemberFiles)
    return spark.read.format("member_files").options(path=path, listing="true").load()


# workbooks

#: Rows that a sheet may have, by the format.
SHEET_ROWS = 1_048_576
WIDEST = 60
_SHEETS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def _cell(value: Column, kind: T.DataType) -> Column:
    text = F.replace(F.replace(F.replace(value.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    # characters that the format forbids
    text = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    if isinstance(kind, T.NumericType):
        # a number may not be infinite or none there
        finite = value.isNotNull() & value.cast("double").between(-1.7976931348623157e308, 1.7976931348623157e308)
        return F.when(finite, F.concat(F.lit("<c><v>"), text, F.lit("</v></c>"))).otherwise("<c/>")
    return F.when(value.isNotNull(), F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), text, F.lit("</t></is></c>"))).otherwise("<c/>")


def sheet_pieces(sheet: DataFrame, order: list[str], rows: int = PIECE_ROWS) -> tuple[DataFrame, int]:
    """Pieces (part, content) of a sheet's XML, rows in that order, and how many rows it has."""
    widths = [F.max(F.length(F.col(f"`{c}`").cast("string"))).alias(f"w{i}") for i, c in enumerate(sheet.columns)]
    told = sheet.agg(F.count("*").alias("n"), *widths).first()
    if told.n >= SHEET_ROWS:
        raise ValueError(f"a sheet has {SHEET_ROWS} rows at most, not {told.n + 1}")
    width = [min(WIDEST, max(len(c), told[f"w{i}"] or 0) + 2) for i, c in enumerate(sheet.columns)]
    columns = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(width, 1))
    names = "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(c)}</t></is></c>' for c in sheet.columns)
    head = f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_SHEETS}"><cols>{columns}</cols><sheetData><row>{names}</row>'
    line = F.concat(F.lit("<row>"), *(_cell(F.col(f"`{f.name}`"), f.dataType) for f in sheet.schema), F.lit("</row>"))
    parts = max(1, -(-told.n // rows))
    ranged = sheet.repartitionByRange(parts, *(F.col(f"`{c}`") for c in order)).select(F.struct(*(F.col(f"`{c}`") for c in order)).alias("at"), (1 + F.spark_partition_id()).alias("part"), line.alias("line"))
    body = ranged.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "").alias("text"))
    ends = sheet.sparkSession.createDataFrame([(0, head), (1 << 30, "</sheetData></worksheet>")], "part int, text string")
    return ends.unionByName(body).select("part", F.encode("text", "UTF-8").alias("content")), told.n


def write_workbook(sheets: dict[str, tuple[DataFrame, list[str]]], path: str, name: str) -> dict[str, int]:
    """A workbook `name` in the folder with a sheet for each frame, its rows in order of the given columns; rows of each."""
    relations = "".join(f'<Relationship Id="r{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
    listed = "".join(f'<sheet name="{escape(s, {chr(34): "&quot;"})}" sheetId="{i}" r:id="r{i}"/>' for i, s in enumerate(sheets, 1))
    kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
    xml = '<?xml version="1.0" encoding="UTF-8"?>'
    fixed = {
        "[Content_Types].xml": f'{xml}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>',
        "_rels/.rels": f'{xml}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{xml}<workbook xmlns="{_SHEETS}" xmlns:r="{_OFFICE}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{xml}<Relationships xmlns="{_PACKAGE}/relationships">{relations}</Relationships>',
    }
    spark = next(iter(sheets.values()))[0].sparkSession
    pieces = spark.createDataFrame([(name, member, 0, text.encode()) for member, text in fixed.items()], PIECES)
    counts = {}
    for i, (sheet, (df, order)) in enumerate(sheets.items(), 1):
        made, counts[sheet] = sheet_pieces(df, order)
        pieces = pieces.unionByName(made.select(F.lit(name).alias("file"), F.lit(f"xl/worksheets/sheet{i}.xml").alias("member"), "part", "content"))
    write_files(pieces, path)
    return counts
