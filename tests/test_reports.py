"""Files that are written for people: read back and compared."""

import csv
import glob
import json

from factloom.sources import formats, reports
from pyspark.sql import functions as F


def lines(path):
    return [x for name in sorted(glob.glob(f"{path}/part-*")) for x in open(name).read().splitlines()]


def test_scores_and_rankings(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v|{i}", i % 3 == 0) for i in range(10)], "id int, name string, same boolean")
    summary = rows.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.avg("id").alias("mean")).orderBy("same")
    reports.write_scores(rows, summary, str(tmp_path / "s"), ~F.col("same"))
    assert len(lines(tmp_path / "s/all_rows.csv")) - len(glob.glob(str(tmp_path / "s/all_rows.csv/part-*"))) == 10
    assert {json.loads(x)["n"] for x in lines(tmp_path / "s/summary.json")} == {4, 6}
    assert "| same | n | mean |" in open(tmp_path / "s/report.md").read() and "| false | 6 | 4.500 |".replace("false", "False") in open(tmp_path / "s/report.md").read()
    reports.write_scores(rows, summary, str(tmp_path / "s"), ~F.col("same"))  # again: replaced as a whole
    reports.write_ranking(rows.withColumn("reasons", F.array(F.lit("a"))), str(tmp_path / "r"), [F.col("id").desc()], "id", 3)
    assert lines(tmp_path / "r/selected.txt") == ["9", "8", "7"]
    reports.write_worksheet(rows, str(tmp_path / "w"))
    head = list(csv.reader(lines(tmp_path / "w")))[0]
    assert head == ["id", "name", "same", "verdict", "notes"]
    assert reports.markdown("T", []) == "# T\n\nNothing to report.\n"


def test_manifest_and_papers(spark, tmp_path):
    rows = spark.createDataFrame([("1", "ok"), ("2", "failed"), ("3", None), ("4", "ok")], "pmid string, status string")
    said = reports.write_manifest(spark, str(tmp_path / "m.json"), "fetch", rows, "pmid", "status")
    assert said["by_status"] == {"ok": 2, "failed": 1, "none": 1} and json.load(open(tmp_path / "m.json")) == said
    reports.write_per_paper(rows, str(tmp_path / "p"))
    reports.write_per_paper(rows.where("pmid = '1'").withColumn("status", F.lit("new")), str(tmp_path / "p"))
    found = {str(r.pmid): r.status for r in spark.read.json(str(tmp_path / "p")).collect()}
    assert found == {"1": "new", "2": "failed", "3": None, "4": "ok"}


def test_format_scan_and_sequences(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    (tmp_path / "GENE1.fasta").write_text(">head 1\nmka\nVL\n")
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.problem) for r in formats.scan(spark, str(tmp_path)).collect()}
    assert got["x.csv"] == ("| a | b |\n| --- | --- |\n| 1 | 2 |", None) and got["GENE1.fasta"] == (None, "unknown format")
    assert [(r.gene, r.sequence, r.length) for r in formats.sequences(spark, str(tmp_path)).collect()] == [("GENE1", "MKAVL", 5)]


def test_readers_of_broken_files():
    assert list(formats.members("a.zip", b"no zip")) == [("a.zip", None, "BadZipFile")]
    assert list(formats.members("a.docx", b"")) == [("a.docx", None, "BadZipFile")]
    assert list(formats.members("a.html", b"")) == [("a.html", "", None)]
    assert list(formats.members("a.xml", b"<a>" * 100_000))[0][2] in ("ParseError", "RecursionError")
    deep = b"<sec>" * 20_000 + b"<p>deep</p>" + b"</sec>" * 20_000
    assert formats.xml_text(deep) == "deep"
