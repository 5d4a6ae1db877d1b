"""Registered queries on what lands, breaks and is written again, made by Spark from the given tables, and SQL twins."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import names
from ..operators import resume
from ..schemas import LISTING
from ..sources import keys, records
from ..sources import listing as listing_files
from ..sources.tables import scratch
from ..streaming import progress
from .queries import NOW, query, table
from .statements import read_facts, upsert_facts


@query("""
    with f as (select o_orderkey // 4000 as list, count(*) as n from orders group by 1)
    select count(*) as lists, count(*) filter (list % 3 = 1) as failed_lists, cast(coalesce(sum(n) filter (list % 3 <> 1), 0) as bigint) as listed from f
""")
def failed_lists(spark, sf_dir):
    """Orders as lists, of which every third was cut off when it landed: the others are read, these are counted."""
    path = scratch(spark, "lists")
    basic = F.struct(F.col("o_orderkey").alias("disclosureIndex"), F.concat(F.lit("d"), "o_orderkey").alias("disclosureId"), F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss").alias("publishDate"))
    number = F.floor(F.col("o_orderkey") / 4000)
    lists = table(spark, sf_dir, "orders").groupBy(number.alias("list")).agg(F.to_json(F.collect_list(F.struct(basic.alias("disclosureBasic")))).alias("value"))
    lists.withColumn("value", F.when(F.col("list") % 3 == 1, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))).write.partitionBy("list").text(path)
    rows = listing_files.read_lists(spark, f"{path}/list=*")
    return rows.agg(F.count_distinct("file").alias("lists"), F.count_distinct(F.when(F.col("failed"), F.col("file"))).alias("failed_lists"), F.count_if(~F.col("failed")).alias("listed"))


@query("select event_id, event_type from events where cast(ts as date) between date '2024-01-10' and date '2024-01-17'")
def landed_by_day(spark, sf_dir):
    """Events as listing rows in a folder per day; only those of the range are read."""
    path = scratch(spark, "days")
    given = {"disclosureIndex": F.col("event_id"), "disclosureId": F.lit("d"), "publishDate": F.date_format("ts", "dd.MM.yyyy HH:mm:ss"), "title": F.col("event_type")}
    rows = table(spark, sf_dir, "events").select([given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING])
    listing_files.write_by_day(rows, path)
    days = listing_files.read_by_day(spark, path, datetime.date(2024, 1, 10), datetime.date(2024, 1, 17))
    return days.select(F.col("disclosureIndex").alias("event_id"), F.col("title").alias("event_type"))


@query("select o_orderkey as disclosure_index from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def resume_from_keys(spark, sf_dir):
    """The orders of lines are written, in two batches; the keys of the second were lost and are read from its records."""
    path = scratch(spark, "records")
    written = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("disclosure_index"), F.lit("x").alias("title")).dropDuplicates(["disclosure_index"])
    done = keys.KeyTable(spark, path)
    for number in range(2):
        part = written.where(F.col("disclosure_index") % 2 == number)
        records.write_batch(part, path, "run", number)
        if number == 0:
            done.add(part, "run", number)
    done.repair()
    return resume.not_written(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("disclosure_index")), done.read())


@query("select event_id % 4 as batch, count(*) as n, count(distinct event_id) as keys from events where event_id % 4 < 3 or event_type = 'error' group by 1")
def batches_again(spark, sf_dir):
    """Events in four batches; all are written twice, the last the second time with fewer rows: its folder is replaced."""
    path, rows = scratch(spark, "again"), table(spark, sf_dir, "events").select("event_id", "event_type")
    for again in range(2):
        for number in range(4):
            part = rows.where((F.col("event_id") % 4 == number) & (F.lit(number < 3 or not again) | (F.col("event_type") == "error")))
            records.write_batch(part, path, "run", number)
    lines = records.read_records(spark, path, rows.schema)
    return lines.groupBy((F.col("event_id") % 4).alias("batch")).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("keys"))


@query("select event_id, event_type from events")
def periodic_flush(spark, sf_dir):
    """Events land in three parts, the last two while the stream runs; it flushes each second until all are written."""
    path, rows = scratch(spark, "flush"), table(spark, sf_dir, "events").select("event_id", "event_type")
    land = lambda k: rows.where(F.col("event_id") % 3 == k).write.mode("append").parquet(f"{path}/in")
    land(0)
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    start = lambda: stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(processingTime="1 second").start(f"{path}/out")
    total = rows.count()
    progress.run_until(spark, start, lambda seen, _: seen >= total, 300, lambda heard: [land(k) for k in (1, 2)])
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


@query(f"""
    with d as (select event_id % 3 as batch, date_diff('second', date_trunc('second', ts), timestamp '{NOW}') + 3 * 3600 as s from events)
    select cast(batch as bigint) as batch, count(*) as records, cast(min(s) as double) as least, round(avg(s), 3) as mean, cast(max(s) as double) as most from d group by 1
""")
def write_delays(spark, sf_dir):
    """Events as records that three batches write; what each observed of its delays."""
    path = scratch(spark, "delays")
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("disclosure_index"), F.date_trunc("SECOND", "ts").cast("timestamp_ntz").alias("publish_date"))
    now = F.to_utc_timestamp(F.lit(NOW).cast("timestamp"), "UTC")
    for number in range(3):
        progress.write_delays(rows.where(F.col("disclosure_index") % 3 == number), "publish_date", path, "run", number, now=now)
    return spark.read.parquet(f"{path}_batches").select(F.col("batch").cast("long").alias("batch"), "records", "least", F.round("mean", 3).alias("mean"), "most")


@query("""
    select l_orderkey as disclosure_index, cast(0 as integer) as table_no, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) - 1 as integer) as row_no, l_quantity as value
    from lineitem join orders on o_orderkey = l_orderkey where l_orderkey % 3 <> 0 or l_returnflag <> 'R'
""")
def facts_upsert(spark, sf_dir):
    """Lines as facts of their orders. The second load has every third order again, without its returned lines: facts that
    are gone go, months without such orders stay as they are."""
    path = scratch(spark, "facts")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("disclosure_index"), F.trunc("o_orderdate", "MM").alias("month"))
    order = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax"
    lines = table(spark, sf_dir, "lineitem")
    for load in (lines, lines.where("l_orderkey % 3 = 0 and l_returnflag <> 'R'")):
        rows = load.selectExpr("l_orderkey as disclosure_index", "0 as table_no", f"cast(row_number() over (partition by l_orderkey order by {order}) - 1 as int) as row_no", "l_quantity as value")
        upsert_facts(spark, path, rows, orders.where(F.lit(load is lines) | (F.col("disclosure_index") % 3 == 0)))
    return read_facts(spark, path).select("disclosure_index", "table_no", "row_no", "value")


@query("""
    with f as (select doc_id, doc_id // 4 as filing, case doc_id % 3 when 0 then 'bericht ' || lang when 1 then 'summary report ' || source else 'annex ' || lang end as n from documents),
         w as (select *, regexp_extract_all(lower(n), '[a-z0-9]+') as w from f),
         e as (select *, case when list_contains(w, 'summary') or w[-1] = 'fr' then true when list_contains(w, 'bericht') then false else list_contains(w, 'annex') and not list_contains(w, 'de') end as english from w)
    select doc_id, filing, n as file_name, not english or bool_and(english) over (partition by filing) as to_read from e
""")
def other_vocabulary(spark, sf_dir):
    """The same choice of files with the tags and words of another pair of languages."""
    kind = F.col("doc_id") % 3
    name = F.when(kind == 0, F.concat(F.lit("bericht "), "lang")).when(kind == 1, F.concat(F.lit("summary report "), "source")).otherwise(F.concat(F.lit("annex "), "lang"))
    files = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 4).alias("filing"), name.alias("file_name"))
    own = names.Vocabulary(english_tags=("summary",), turkish_tags=("bericht",), english_words=("annex",), turkish_words=("de",), last_tag="fr")
    return names.mark_to_read(files, "filing", vocabulary=own)
