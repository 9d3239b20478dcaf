"""Files for people and other programs: scores, rankings, worksheets, queues, stage manifests. Rows are written by the tasks that have them."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, name: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(name)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """A small file, whole or not at all: written beside its place and renamed."""
    place, files = _path(spark, name)
    half, _ = _path(spark, f"{name}.{uuid.uuid4().hex}.part")
    out = files.create(half, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(place):
        files.delete(place, False)
    if not files.rename(half, place):
        raise OSError(f"cannot write {name}")


#: Statuses of a stage; a manifest that named only some of them would count wrongly.
MOST_STATUSES = 1000


def write_manifest(spark: SparkSession, name: str, stage: str, entries: DataFrame, key: str, status: str) -> dict:
    """The manifest of a stage: how many entries of each status, and where their rows are; entries go beside it as JSON lines."""
    entries.write.mode("overwrite").json(f"{name}.entries")
    tally = {r[0]: r[1] for r in entries.groupBy(F.coalesce(status, F.lit("none"))).agg(F.count(F.lit(1))).orderBy(F.lit(1)).limit(MOST_STATUSES + 1).collect()}
    if len(tally) > MOST_STATUSES:
        raise ValueError(f"over {MOST_STATUSES} statuses; is this column one of free text?")
    said = {"stage": stage, "entries": sum(tally.values()), "by_status": tally, "files": f"{name}.entries", "key": key}
    write_text(spark, name, json.dumps(said, indent=2, sort_keys=True))
    return said


def markdown(title: str, rows: list[dict]) -> str:
    """A heading and a pipe table of few rows; numbers with three places, what is not stated as a dash."""
    show = lambda v: "-" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v).replace("|", "/")
    if not rows:
        return f"# {title}\n\nNothing to report.\n"
    names = list(rows[0])
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join([f"# {title}", "", line(names), line(["---"] * len(names)), *(line([show(r[n]) for n in names]) for r in rows), ""])


def write_scores(compared: DataFrame, summary: DataFrame, folder: str, differs: Column, top: int = 200) -> None:
    """All compared rows and those that differ as CSV, the summary as JSON and Markdown.

    The summary has a row per stratum; its first `top` rows go into the Markdown
    text, all of them into the JSON.
    """
    compared.write.mode("overwrite").option("header", True).csv(f"{folder}/all_rows.csv")
    compared.where(differs).write.mode("overwrite").option("header", True).csv(f"{folder}/discrepancies.csv")
    summary.write.mode("overwrite").json(f"{folder}/summary.json")
    write_text(compared.sparkSession, f"{folder}/report.md", markdown("Comparison", [r.asDict() for r in summary.limit(top).collect()]))


def write_ranking(candidates: DataFrame, folder: str, order: list[Column], key: str, selected: int) -> None:
    """Candidates by rank as JSON lines and tab-separated, and the keys of the best as text, in rank order."""
    ranked = candidates.orderBy(*order)
    ranked.write.mode("overwrite").json(f"{folder}/candidates.json")
    flat = ranked.select(*[F.to_json(c).alias(c) if f.dataType.typeName() in ("array", "struct", "map") else F.col(c) for c, f in zip(ranked.columns, ranked.schema.fields, strict=True)])
    flat.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{folder}/candidates.tsv")
    ranked.limit(selected).select(F.col(key).cast("string")).write.mode("overwrite").text(f"{folder}/selected.txt")


def write_worksheet(rows: DataFrame, path: str, blank: tuple[str, ...] = ("verdict", "notes")) -> None:
    """Rows as CSV with empty columns for a reviewer to fill."""
    rows.select("*", *[F.lit("").alias(c) for c in blank if c not in rows.columns]).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_per_paper(rows: DataFrame, path: str, paper: str = "pmid") -> None:
    """JSON lines by paper, each paper in a folder of its own; papers not at hand keep theirs."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(paper).json(path)
