"""The keys that are written, as a bucketed table beside the records: a resume reads these and no record.

The table is bucketed and sorted by the key, so joins with it on the key leave it where it is and shuffle the other side
alone. A batch of a run adds its keys after its records; one that is done again adds nothing twice, and a batch whose
records were written and whose keys were lost is read from its records once (`repair`).
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import read_written_keys

#: Fixed for a table when it is made.
BUCKETS = 64


class KeyTable:
    """key, day (of publication, if given), run and batch of every record under `records`."""

    def __init__(self, spark: SparkSession, records: str, key: str = "disclosure_index", buckets: int = BUCKETS):
        self.spark, self.records, self.key, self.buckets = spark, records.rstrip("/"), key, buckets
        self.path = f"{self.records}_keys"
        self.name = "written_" + hashlib.md5(self.path.encode()).hexdigest()[:16]
        columns = f"{key} BIGINT, day DATE, run STRING, batch BIGINT"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)  # another session may have added to its files
        return self.spark.table(self.name)

    def add(self, rows: DataFrame, run: str, batch: int) -> None:
        """Adds the keys of a batch's records; `rows`: key and, if there, publish_date."""
        day = F.to_date("publish_date") if "publish_date" in rows.columns else F.lit(None).cast("date")
        there = self.read().where((F.col("run") == run) & (F.col("batch") == batch)).select(self.key)
        new = rows.select(F.col(self.key).cast("long").alias(self.key), day.alias("day")).join(there, self.key, "left_anti")
        new.select(self.key, "day", F.lit(run).alias("run"), F.lit(batch).cast("long").alias("batch")).repartition(self.buckets, self.key).write.insertInto(self.name)

    def repair(self) -> int:
        """Adds the keys of batches whose records are there and none of whose keys are; their number."""
        part = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.records)  # contents are not read
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        folders = files.select("path", part("run").alias("run"), part("batch").try_cast("long").alias("batch")).where("batch is not null")
        known = self.read().select("run", "batch").distinct()
        lost = folders.join(known, ["run", "batch"], "left_anti").groupBy("run", "batch").agg(F.collect_list("path").alias("paths")).collect()  # of batches that broke off
        for r in lost:
            self.add(read_written_keys(self.spark, r.paths, self.key), r.run, r.batch)
        return len(lost)
