from __future__ import annotations

import glob
import http.server
import json
import threading
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantarium.sources import archives, pages

SCHEMA = T.StructType().add("name", "string").add("value", "double")


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a", f"set {i % 3}", f'n{i}, "q"\n', i / 2 if i % 5 else None) for i in range(200)] + [("b", "one", None, 1.0)]
    return spark.createDataFrame(data, "level string, dataset string, name string, value double").repartition(4)


def test_archives_round_trip(spark, rows, tmp_path):
    path = f"file://{tmp_path}/out"
    archives.write_files(archives.csv_pieces(rows, "level", "dataset", rows=10), path)
    got = archives.read_members(spark, path, SCHEMA).select("file", "member", "name", "value", "malformed").collect()
    want = [(f"{r.level}.zip", f"{r.dataset}.csv.gz", r.name, r.value, None) for r in rows.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sorted(x.split("/")[-1] for x in glob.glob(f"{tmp_path}/out/*")) == ["a.zip", "b.zip"]


def test_metadata_and_empty_levels(spark, rows, tmp_path):
    path = f"file://{tmp_path}/out"
    archives.write_archives(rows, path, "level", "dataset", always=["none"])
    with zipfile.ZipFile(f"{tmp_path}/out/none.zip") as empty:
        assert empty.namelist() == [archives.METADATA] and empty.read(archives.METADATA) == b"dataset,rows\n"
    with zipfile.ZipFile(f"{tmp_path}/out/a.zip") as full:
        assert full.read(archives.METADATA).decode().splitlines() == ["dataset,rows", "set 0,67", "set 1,67", "set 2,66"] and full.testzip() is None
    listed = archives.list_members(spark, path).collect()
    assert {(r.file, r.member) for r in listed} == {("a.zip", f"set {i}.csv.gz") for i in range(3)} | {("b.zip", "one.csv.gz")} | {(f"{x}.zip", archives.METADATA) for x in ("a", "b", "none")}


def test_failed_task_leaves_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    fails = F.when(F.col("part") == 3, F.raise_error(F.lit("lost"))).otherwise(F.encode(F.lit("x"), "UTF-8"))
    pieces = spark.range(5).select(F.lit("f.zip").alias("file"), F.concat(F.lit("m"), "id").alias("member"), F.col("id").cast("int").alias("part")).withColumn("content", fails)
    with pytest.raises(Exception, match="lost"):
        archives.write_files(pieces, path)
    assert glob.glob(f"{tmp_path}/out/*") == []


def test_malformed_lines_are_told(spark, tmp_path):
    (tmp_path / "out").mkdir()
    with zipfile.ZipFile(tmp_path / "out" / "x.zip", "w") as z:
        z.writestr("m.csv", "name,value\na,1\nb\nc,2,3\n,4\nd,no\n")
    got = archives.read_members(spark, str(tmp_path / "out"), SCHEMA, "%.csv").select("name", "value", "malformed").collect()
    assert [tuple(r) for r in got] == [("a", 1.0, None), (None, None, ["b"]), (None, None, ["c", "2", "3"]), (None, 4.0, None), ("d", None, None)]


def test_workbook(spark, tmp_path):
    first = spark.createDataFrame([(2, "b < & \x01", None), (1, None, float("nan")), (3, "c" * 100, 2.5)], "id int, text string, x double")
    counts = archives.write_workbook({"one": (first, ["id"]), 'a "q"': (spark.range(50_000).withColumnRenamed("id", "n"), ["n"])}, f"file://{tmp_path}/out", "report.xlsx")
    assert counts == {"one": 3, 'a "q"': 50_000}
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(tmp_path / "out" / "report.xlsx") as z:
        assert [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{space}sheet")] == ["one", 'a "q"']

        def cells(n):
            return [["".join(c.itertext()) for c in row] for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{n}.xml")).iter(f"{space}row")]

        assert cells(1) == [["id", "text", "x"], ["1", "", ""], ["2", "b < & ", ""], ["3", "c" * 100, "2.5"]]
        assert [c.get("width") for c in ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")).iter(f"{space}col")] == ["4", "60", "5"]
        assert cells(2) == [["n"], *([str(i)] for i in range(50_000))]


@pytest.fixture
def service():
    """Three pages of numbers behind links; the second fails twice, once with half an answer."""
    seen: dict = {}

    class Answers(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            seen[self.path] = turn = seen.get(self.path, 0) + 1
            if self.path == "/gone" or (self.path == "/p2" and turn == 1):
                return self.send_error(503)
            links = {"/p1": "/p2", "/p2": "/p3", "/loop": "/loop"}
            text = json.dumps({"results": [10 * int(self.path[-1]) + i for i in range(2)] if self.path[1] == "p" else [], "next": f"http://{self.headers['Host']}{links[self.path]}" if self.path in links else None})
            self.send_response(200)
            self.end_headers()
            self.wfile.write((text[:10] if self.path == "/p2" and turn == 2 else text).encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen
    server.shutdown()


def test_links_are_followed_and_failures_retried(spark, service):
    address, seen = service
    got = pages.read_linked(spark, [f"{address}/p1"], "value int", pause="0.01").collect()
    assert [(r.page, r.value) for r in got] == [(0, 10), (0, 11), (1, 20), (1, 21), (2, 30), (2, 31)] and seen["/p2"] == 3
    with pytest.raises(Exception, match="503"):
        pages.read_linked(spark, [f"{address}/gone"], "value int", pause="0.01", retries="1").collect()
    with pytest.raises(Exception, match="lead back"):
        pages.read_linked(spark, [f"{address}/loop"], "value int", pause="0.01").collect()


def test_records_of_several_chains(spark, tmp_path):
    for c in "ab":
        for i in range(3):
            (tmp_path / f"{c}{i}.json").write_text(json.dumps({"items": [{"id": i, "of": c}], "more": f"file://{tmp_path}/{c}{i + 1}.json" if i < 2 else None}))
    got = pages.read_linked(spark, [f"file://{tmp_path}/{c}0.json" for c in "ab"], "id int, of string", results="items", next="more", pause="0")
    assert sorted((r.of, r.page, r.id) for r in got.collect()) == [(c, i, i) for c in "ab" for i in range(3)] and got.rdd.getNumPartitions() == 2
