"""Tables that a stream may write to again and again: a ledger of (query, batch) and versions of buckets that are swapped by one rename.

A batch is merged into the buckets that it touches, and these are written as new
versions beside the old ones. The table changes when a ledger entry that names
them is renamed into place. A batch that the ledger has is not written again; a
writer that dies before the rename leaves files that nobody reads, and that the
batch overwrites when it comes again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class LedgerTable:
    """Rows of one `key`, the newest by `order` each, in a number of hash buckets below `folder`."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str, order: str, buckets: int = 16):
        self.spark, self.folder, self.schema, self.key, self.order, self.buckets = spark, folder.rstrip("/"), schema, key, order, buckets

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/ledger")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files, path

    def entry(self) -> dict:
        """The last entry: its number, the last batch of each query, and the place of each bucket."""
        files, path = self._files()
        names = sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []
        last = max((n for n in names if n.endswith(".json") and not n.startswith((".", "_"))), default=None)
        if last is None:
            return {"number": 0, "batches": {}, "buckets": {}}
        stream = files.open(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/ledger/{last}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, entry: dict) -> None:
        files, _ = self._files()
        make = self.spark._jvm.org.apache.hadoop.fs.Path
        half, place = make(f"{self.folder}/ledger/.{entry['number']}.half"), make(f"{self.folder}/ledger/{entry['number']:012d}.json")
        out = files.create(half, True)
        out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        out.close()
        if files.exists(place) or not files.rename(half, place):
            raise RuntimeError(f"ledger entry {entry['number']} is there already: another writer came first")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def rows(self, entry: dict | None = None, only: list[int] | None = None) -> DataFrame:
        entry = entry or self.entry()
        paths = [f"{self.folder}/{p}" for b, p in sorted(entry["buckets"].items()) if only is None or int(b) in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def upsert(self, rows: DataFrame, query: str, batch: int, before_commit: Callable[[], None] = lambda: None) -> bool:
        """Merge a batch, whose rows stand before equally new ones of the table; False if the ledger has it. Only the buckets that the batch touches are read and written."""
        entry = self.entry()
        if entry["batches"].get(query, -1) >= batch:
            return False
        fresh = rows.select(*self.spark.createDataFrame([], self.schema).columns)
        touched = sorted(r[0] for r in fresh.select(self._bucket().alias("b")).distinct().collect())  # at most `buckets` numbers
        if touched:
            both = self.rows(entry, touched).withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True)))
            newest = both.groupBy(self.key).agg(F.max_by(F.struct(*fresh.columns), F.struct(self.order, "_fresh")).alias("r")).select("r.*")
            to = f"data/{query}-{batch}"
            newest.withColumn("_bucket", self._bucket()).repartition(len(touched), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/{to}")
            entry["buckets"] |= {str(b): f"{to}/_bucket={b}" for b in touched}
        before_commit()
        self._commit({"number": entry["number"] + 1, "batches": entry["batches"] | {query: batch}, "buckets": entry["buckets"]})
        return True
