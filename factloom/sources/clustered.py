"""A reference table in the order of its key: few files are read for few keys.

The rows are written in the order of (leading, following) key, in files of
small row groups, with a table of zones beside them: the first and last key of
each file. A lookup takes the files whose zones hold its keys, and pushes its
keys down to their row groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many keys, and files, a lookup chooses its files on the driver; beyond it the whole table is joined.
MOST_KEYS, MOST_FILES = 10_000, 1_000_000
ROW_GROUP = 1 << 20
#: Rows of a file: what one task sorts does not grow with the table.
ROWS_A_FILE = 250_000


@dataclass(frozen=True)
class Clustered:
    """A clustered table below `folder`; `lead` and `follow` are its key columns. Rows without a leading key are in it, but no lookup finds them."""

    spark: SparkSession
    folder: str
    lead: str = "gene"
    follow: str = "position"

    def write(self, rows: DataFrame, files: int | None = None) -> None:
        """Range partitions by both keys, so a leading key of a third of the rows is many files; sorted within. Without `files` their number goes by the rows."""
        key = [F.col(self.lead), F.col(self.follow)]
        files = files or max(1, -(-rows.count() // ROWS_A_FILE))
        dealt = rows.repartitionByRange(files, *key)
        dealt.sortWithinPartitions(*key).write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(f"{self.folder}/rows")
        self._ends().groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{self.folder}/zones")

    def _ends(self) -> DataFrame:
        """First and last key of the rows of each file in an Arrow batch: they come in order, so that no task sorts the rows of its files by file."""

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                runs = pc.run_end_encode(batch.column(0))
                stops = runs.run_ends.to_pylist()
                starts = [0, *stops[:-1]]
                at = [batch.column(c).take(pa.array(rows)) for rows in (starts, [s - 1 for s in stops]) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays([runs.values, *at, pa.array([b - a for a, b in zip(starts, stops, strict=True)], pa.int64())], names=["file", "a", "b", "y", "z", "n"])

        rows = self.rows().select(F.col("_metadata.file_path").alias("file"), self.lead, self.follow)
        lead, follow = (rows.schema[c].dataType.simpleString() for c in (self.lead, self.follow))
        said = rows.mapInArrow(ends, f"file string, a {lead}, b {follow}, y {lead}, z {follow}, n long")
        key = lambda a, b: F.struct(F.col(a).alias(self.lead), F.col(b).alias(self.follow))
        return said.select("file", key("a", "b").alias("first"), key("y", "z").alias("last"), "n")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/rows")

    def zones(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/zones")

    def _bounds(self) -> list | None:
        """(first, last, file) of all files in order; None where they are too many. Null keys come first, as in Spark's order."""
        found = self.zones().limit(MOST_FILES + 1).collect()
        if len(found) > MOST_FILES:
            return None
        low = lambda v: (v is not None, v)
        return sorted(((low(r["first"][0]), low(r["first"][1])), (low(r["last"][0]), low(r["last"][1])), r["file"]) for r in found)

    def _read(self, files: list[str]) -> DataFrame:
        whole = self.rows()
        return self.spark.read.schema(whole.schema).parquet(*files) if files else whole.where("false")

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows whose keys are among those of `wanted` (both key columns); other columns of it are ignored, repeated and null keys too."""
        keys = wanted.select(self.lead, self.follow).where(F.col(self.lead).isNotNull() & F.col(self.follow).isNotNull()).distinct()
        asked = keys.limit(MOST_KEYS + 1).collect()
        bounds = self._bounds() if len(asked) <= MOST_KEYS else None
        if bounds is None:
            return self.rows().join(keys, [self.lead, self.follow], "left_semi")
        firsts, lasts, files = [b[0] for b in bounds], [b[1] for b in bounds], [b[2] for b in bounds]
        touched = set()
        for lead, follow in asked:
            k = ((True, lead), (True, follow))
            touched.update(files[bisect_left(lasts, k) : bisect_right(firsts, k)])
        near = self._read(sorted(touched)).where(F.col(self.lead).isin(sorted({a for a, _ in asked})) & F.col(self.follow).between(min((b for _, b in asked), default=0), max((b for _, b in asked), default=0)))
        # At most MOST_KEYS keys.
        return near.join(F.broadcast(self.spark.createDataFrame(asked, keys.schema)), [self.lead, self.follow], "left_semi")

    def slice(self, lead) -> DataFrame:  # noqa: ANN001
        """All rows of one leading key, from the files that can have it."""
        bounds = self._bounds()
        rows = self.rows() if bounds is None else self._read([f for a, b, f in bounds if a[0] <= (True, lead) <= b[0]])
        return rows.where(F.col(self.lead) == F.lit(lead))

    def leading(self) -> DataFrame:
        """The distinct leading keys. A file that begins and ends with one key has no other, so only the others are read."""
        ends = self.zones().select(F.explode(F.array(f"first.{self.lead}", f"last.{self.lead}")).alias(self.lead))
        bounds = self._bounds()
        within = self.rows() if bounds is None else self._read([f for a, b, f in bounds if a[0] != b[0]])
        return ends.union(within.select(self.lead)).where(F.col(self.lead).isNotNull()).distinct()
