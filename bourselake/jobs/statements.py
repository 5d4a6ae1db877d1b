"""Financial reports to a flat table of numeric facts, kept up to date load by load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.statements import is_financial_report, statement_cells, statement_items
from ..sources.pages import parse_pages
from ..sources.tables import checkpoint


def facts(pages: DataFrame, listed: DataFrame, key: str = "disclosure_index") -> DataFrame:
    """pages: key and html; listed: key and disclosure_class. Only reports are parsed."""
    reports = pages.join(listed.select(key, "disclosure_class"), key).where(is_financial_report(F.col("disclosure_class"), F.col("html")))
    return statement_items(statement_cells(parse_pages(reports.select(key, "html"), key=key), key), key)


def read_facts(spark: SparkSession, path: str) -> DataFrame | None:
    """The table of facts, or None before the first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def upsert_facts(spark: SparkSession, path: str, new: DataFrame, loaded: DataFrame, month: str = "month", key: str = "disclosure_index") -> None:
    """Puts a load's facts in place of those of its disclosures; a fact is (disclosure, table, row).

    loaded: key and `month` (date) of every disclosure of the load, also of those that have no facts (any more); a
    disclosure stays in its month. Only the months of the load are read and written again, by partition.
    """
    new = new.join(loaded.select(key, month), key)
    old = read_facts(spark, path)
    if old is not None:
        months = [r[0] for r in loaded.select(month).distinct().collect()]  # a load is of a few months
        kept = old.where(F.col(month).isin(months)).join(loaded.select(key), key, "left_anti")
        touched = spark.createDataFrame([(m,) for m in months], f"{month} date")
        new = checkpoint(kept.unionByName(new))
        gone = [r[0] for r in touched.join(new.select(month).distinct(), month, "left_anti").collect()]
        if gone:  # a month without facts is written as an empty one
            for m in gone:
                new.limit(0).drop(month).write.mode("overwrite").parquet(f"{path}/{month}={m}")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)
