"""Scans and sinks: strict schemas, tolerant of bad rows, idempotent writes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The document that an extraction leaves for each paper.
EXTRACTION = """
  paper_metadata struct<pmid:string, title:string, gene_symbol:string, extraction_summary:string>,
  variants array<struct<gene_symbol:string, cdna_notation:string, protein_notation:string, legacy_notation:string, genomic_position:string,
    clinical_significance:string, evidence_level:string, variant_class:string, structural_description:string,
    patients:struct<count:string, demographics:string, phenotype:string>,
    penetrance_data:struct<total_carriers_observed:string, affected_count:string, unaffected_count:string, uncertain_count:string, penetrance_percentage:string,
      age_dependent_penetrance:array<struct<age_range:string, penetrance_percentage:string, carriers_in_range:string, affected_in_range:string>>>,
    individual_records:array<struct<individual_id:string, age_at_evaluation:string, age_at_onset:string, age_at_diagnosis:string, sex:string, affected_status:string, phenotype_details:string, evidence_sentence:string>>,
    functional_data:struct<summary:string, assays:array<string>>, count_provenance:map<string,string>, source_location:string, additional_notes:string, key_quotes:array<string>>>,
  _corrupt_record string
"""
FILE_NAME = r"([A-Za-z0-9]+)_PMID_(\d{1,8})"


def extraction_files(spark: SparkSession, folder: str, pattern: str = FILE_NAME) -> DataFrame:
    """One row per JSON document whose file name fits; unreadable ones keep their text in _corrupt_record."""
    rows = spark.read.schema(EXTRACTION).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(folder)
    return rows.withColumn("file", F.input_file_name()).where(F.col("file").rlike(pattern)).withColumn("file_id", F.regexp_extract("file", pattern, 2))


def flatten(documents: DataFrame) -> dict[str, DataFrame]:
    """The relational rows of extraction documents: papers, variants with counts, people, age bins, assays."""
    from factloom.functions.counts import affected_status, clean_text, first_int

    good = documents.where("_corrupt_record is null").withColumn("pmid", F.coalesce(clean_text(F.col("paper_metadata.pmid")), "file_id"))
    papers = good.select("pmid", "paper_metadata.title", "paper_metadata.gene_symbol", F.col("paper_metadata.extraction_summary").alias("summary"))
    v = good.select("pmid", F.posexplode("variants").alias("ordinal", "v"))
    p = F.col("v.penetrance_data")
    variants = v.select(
        "pmid", "ordinal", *[clean_text(F.col(f"v.{c}")).alias(c) for c in ("gene_symbol", "cdna_notation", "protein_notation", "legacy_notation", "genomic_position", "structural_description", "source_location")],
        first_int(p["total_carriers_observed"]).alias("carriers"), first_int(p["affected_count"]).alias("affected"),
        first_int(p["unaffected_count"]).alias("unaffected"), first_int(p["uncertain_count"]).alias("uncertain"), first_int(F.col("v.patients.count")).alias("patient_count"), F.col("v.count_provenance"),
    )
    people = v.select("pmid", "ordinal", F.inline("v.individual_records")).withColumn("affected_status", affected_status(F.col("affected_status")))
    bins = v.select("pmid", "ordinal", F.inline(p["age_dependent_penetrance"]))
    assays = v.select("pmid", "ordinal", F.explode("v.functional_data.assays").alias("assay"))
    return {"papers": papers, "variants": variants, "individual_records": people, "age_dependent_penetrance": bins, "functional_data": assays}


def progress(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(decisions, malformed lines) of a JSON-lines log; blank lines count for neither."""
    form = "pmid string, final_decision string, reason string, stage string, tier1 struct<decision:string, reason:string, confidence:double>, tier2 struct<decision:string, reason:string, confidence:double>, _corrupt_record string"
    rows = spark.read.text(path).where("trim(value) <> ''").select(F.from_json("value", form, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    return rows.where("_corrupt_record is null").drop("_corrupt_record"), rows.where("_corrupt_record is not null").select("_corrupt_record")


# Spellings of the columns of a reference table, in the order they are tried.
HEADERS = {
    "variant": ("variant", "proteinchange", "mutation", "hgvs", "cdna"),
    "pmid": ("pmid", "pubmedid", "paper", "reference"),
    "carriers": ("carriers", "totalcarriers", "heterozygotes", "het", "n"),
    "affected": ("affected", "cases", "symptomatic"),
    "unaffected": ("unaffected", "asymptomatic", "controls"),
}


def header_key(name: str) -> str:
    import re

    return re.sub(r"[\s_\-]+", "", name.strip().lower())


def detect_columns(columns: list[str], mapping: dict[str, str] | None = None) -> dict[str, str]:
    """role -> column: the given mapping, else an equal spelling, else one of 4 letters or more inside the name."""
    out = dict(mapping or {})
    keys = {c: header_key(c) for c in columns}
    for role, names in HEADERS.items():
        if role in out:
            continue
        exact = next((c for n in names for c, k in keys.items() if k == n), None)
        inside = next((c for n in names if len(n) >= 4 for c, k in keys.items() if n in k and not (role == "affected" and "unaffected" in k)), None)
        if exact or inside:
            out[role] = exact or inside
    return out


def reference_table(spark: SparkSession, path: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """A curated CSV with its columns named by role, ids and counts normalised."""
    from factloom.functions.counts import normal_id, safe_int

    rows = spark.read.option("header", True).csv(path)
    roles = detect_columns(rows.columns, mapping)
    missing = {"variant", "pmid"} - set(roles)
    if missing:
        raise ValueError(f"no column for {sorted(missing)} in {rows.columns}")
    change: dict[str, Callable[[Column], Column]] = {"pmid": normal_id, "variant": F.trim}
    return rows.select(*[change.get(r, safe_int)(F.col(f"`{c}`")).alias(r) for r, c in roles.items()])


def delimited_text(spark: SparkSession, path: str, limit: int = 10_000) -> DataFrame:
    """Tab-separated lines as cells; the first `limit` of a file, which is the feature of this reader."""
    from pyspark.sql import Window

    rows = spark.read.text(path).withColumn("file", F.input_file_name()).withColumn("_n", F.monotonically_increasing_id())
    numbered = rows.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("_n")))
    return numbered.where(F.col("line") <= limit).select("file", "line", F.split("value", "\t", -1).alias("cells"))


def merge_ids(sources: list[DataFrame], key: str, most: int | None = None) -> DataFrame:
    """Ids of all sources, each once, in text order, up to a cap."""
    if not sources:
        raise ValueError("no source is enabled")
    out = sources[0].select(F.col(key).cast("string").alias(key))
    for s in sources[1:]:
        out = out.union(s.select(F.col(key).cast("string").alias(key)))
    out = out.distinct().orderBy(key)
    return out.limit(most) if most else out


def expand_queries(spark: SparkSession, names: list[str], clauses: list[str], disease: str | None = None) -> DataFrame:
    """One query per clause: all names OR-ed, and the clause; the plain query first."""
    base = "(" + " OR ".join(f'"{n}"[Title/Abstract]' for n in dict.fromkeys(names)) + ")" if names else ""
    if not base:
        raise ValueError("no name to search for")
    parts = [base, *(f"{base} AND ({c})" for c in [*clauses, *([disease] if disease else [])])]
    return spark.createDataFrame(list(enumerate(dict.fromkeys(parts))), "ordinal int, query string")


def overwrite_papers(rows: DataFrame, path: str, key: str = "pmid") -> None:
    """Replace the partitions of the papers at hand, leave the others: safe to repeat."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def hash_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """path, size and SHA-256 of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def check_manifest(before: DataFrame, now: DataFrame) -> DataFrame:
    """path and problem: missing, new or changed."""
    both = before.select("path", F.col("sha256").alias("_b")).join(now.select("path", F.col("sha256").alias("_n")), "path", "full_outer")
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_b").isNull(), "new").when(F.col("_b") != F.col("_n"), "changed")
    return both.select("path", problem.alias("problem")).where("problem is not null")


class StubSource(DataSource):
    """A remote source without a network: `spark.read.format("factloom_stub").option("ids", "1,2").load()` gives made rows of the ids, dealt over partitions."""

    @classmethod
    def name(cls) -> str:
        return "factloom_stub"

    def schema(self) -> str:
        return "pmid string, title string, abstract string"

    def reader(self, schema) -> DataSourceReader:
        return _StubReader(self.options)


class _StubReader(DataSourceReader):
    def __init__(self, options: dict):
        self.ids = [x for x in options.get("ids", "").split(",") if x]
        self.batch = int(options.get("batch", 100))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.ids[i : i + self.batch]) for i in range(0, len(self.ids), self.batch)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for pmid in partition.value:
            yield pmid, f"Title of {pmid}", None


def register(spark: SparkSession, *sources: type[DataSource]) -> None:
    """Make sources known to a session; a real one replaces the stub by having its name, the last registered standing."""
    for source in sources or (StubSource,):
        spark.dataSource.register(source)
