"""Registered queries: every operator on the given tables, which stand in for landed disclosures, and SQL twins."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import binary, names, ranges, text, values
from ..operators import attachments, listing, pages, records, resume, statements
from ..schemas import RECORD, RESULT
from ..sources import attachments as attachment_files
from ..sources import listing as listing_files
from ..sources import pages as page_files
from ..sources import records as record_files
from ..sources.tables import checkpoint, scratch
from ..streaming import retry, watch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "2024-02-01 00:00:00"
URL = "https://disclosures.example/{}"
#: Selectors of the generic web pages that stand in for disclosure pages.
WEB = page_files.Selectors(link="/", area_tag="article", area_class="", header_tags=("title", "h1"))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- listing ---


@query("""
    with codes as (select *, list_distinct(list_concat([p_brand], string_split(p_name, ' '))) c from part)
    select p_partkey, p_brand, p_name from codes
    where list_has_any(c, (select list(distinct p_brand) from part where p_brand like '%1' ) || ['ring'])
""")
def watchlist_filter(spark, sf_dir):
    """Own code: the brand; related codes: the words of the name."""
    part = table(spark, sf_dir, "part")
    lines = part.where(F.endswith("p_brand", F.lit("1"))).select(F.concat("p_brand", F.lit("  - a company")).alias("value"))
    lines = lines.unionByName(spark.createDataFrame([("# blue",), ("",), ("ring",)], "value string"))
    related = F.array_join(F.split("p_name", " "), ", ")
    return listing.on_watchlist(part, listing_files.watchlist(lines), F.col("p_brand"), related, "p_partkey").select("p_partkey", "p_brand", "p_name")


@query("""
    select event_id as disclosure_index, 'd' || event_id as disclosure_id, date_trunc('second', ts) as publish_date,
           'https://disclosures.example/' || event_id as url, event_type as disclosure_class, cast(null as varchar) as stock_code
    from events
""")
def listing_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("disclosureIndex"), F.concat(F.lit("d"), "event_id").alias("disclosureId"), F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("publishDate"), F.col("event_type").alias("disclosureClass")
    )
    for f in listing.LISTING_KEYS:
        if f not in rows.columns:
            rows = rows.withColumn(f, F.lit(None).cast(listing.LISTING_KEYS[f][1]))
    out = listing.list_fields(rows, URL)
    return out.select("disclosure_index", "disclosure_id", "publish_date", "url", "disclosure_class", "stock_code")


@query("select * from orders where o_orderstatus in ('F', 'P')")
def member_types(spark, sf_dir):
    return listing.member_type_in(table(spark, sf_dir, "orders"), "o_orderstatus", ("F", "P"))


@query("select o_orderkey, o_orderdate from orders where cast(o_orderdate as date) between date '1996-02-10' and date '1997-03-31'")
def date_range(spark, sf_dir):
    days = ranges.in_date_range(F.col("o_orderdate"), datetime.date(1996, 2, 10), datetime.date(1997, 3, 31))
    return table(spark, sf_dir, "orders").where(days).select("o_orderkey", "o_orderdate")


@query("select event_id, ts from events where ts >= timestamp '2024-01-20 11:50:00'")
def catch_up(spark, sf_dir):
    return watch.catch_up(table(spark, sf_dir, "events"), "ts", datetime.datetime(2024, 1, 20, 12)).select("event_id", "ts")


@query("""
    select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as listed,
           count(*) filter (where o_orderkey not in (select l_orderkey from lineitem)) as to_fetch
    from orders group by 1
""")
def month_counts(spark, sf_dir):
    written = resume.distinct_keys(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey").withColumn("there", F.lit(1))
    return listing.month_counts(table(spark, sf_dir, "orders").join(written, "o_orderkey", "left"), "o_orderdate", F.col("there").isNull())


@query("""
    select o_orderkey, row_number() over (partition by date_trunc('month', o_orderdate) order by o_orderdate desc, o_orderkey) as rank
    from orders
""")
def newest_first_rank(spark, sf_dir):
    return listing.newest_first(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey").select("o_orderkey", F.col("rank").cast("long").alias("rank"))


# --- ranges ---


@query("""
    with r as (select cast(min(o_orderdate) as date) a, cast(max(o_orderdate) as date) b from orders group by o_orderpriority),
         m as (select a, b, unnest(generate_series(cast(date_trunc('month', a) as timestamp), cast(b as timestamp), interval 1 month)) as m from r)
    select distinct greatest(cast(m as date), a) as first, least(last_day(cast(m as date)), b) as last,
           strftime(greatest(cast(m as date), a), '%Y-%m-%d') || '_' || strftime(least(last_day(cast(m as date)), b), '%Y-%m-%d') as range_id
    from m
""")
def month_ranges(spark, sf_dir):
    span = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))
    return ranges.month_ranges(span).select("first", "last", ranges.range_id(F.col("first"), F.col("last")).alias("range_id")).distinct()


@query("""
    with r as (select o_custkey, cast(min(o_orderdate) as date) a, cast(max(o_orderdate) as date) b from orders group by o_custkey),
         p as (select *, unnest(range(7)) as i, (b - a) + 1 as days from r)
    select o_custkey, cast(i as integer) as part, a + cast((days * i) // 7 as integer) as first, a + cast((days * (i + 1)) // 7 as integer) - 1 as last from p
""")
def equal_parts(spark, sf_dir):
    span = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))
    return ranges.equal_parts(span, 7).select("o_custkey", "part", "first", "last")


# --- resuming ---


@query("select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def resume_anti_join(spark, sf_dir):
    written = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return resume.not_written(table(spark, sf_dir, "orders"), written, "o_orderkey").select("o_orderkey", "o_custkey")


@query("""
    select count(*) as listed, count(*) filter (where o_orderkey not in (select l_orderkey from lineitem)) as missing,
           count(*) filter (where o_orderkey not in (select l_orderkey from lineitem)) = 0 as complete
    from orders
""")
def completeness(spark, sf_dir):
    written = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return resume.completeness(table(spark, sf_dir, "orders"), written, "o_orderkey")


@query("select user_id, count(*) as attempts, count(*) >= 3 as given_up from events where event_type = 'error' group by 1")
def attempt_counts(spark, sf_dir):
    return resume.attempt_counts(table(spark, sf_dir, "events").where("event_type = 'error'"), "user_id")


# --- text and values ---


@query(r"""
    with t as (select doc_id as id, 'd' as of, text from documents union all select conv_id * 1000 + turn, 'c', text from conversations)
    select id, of, trim(regexp_replace(coalesce(text, ''), '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) as text
    from t
""")
def collapse_ws(spark, sf_dir):
    return _texts(spark, sf_dir).select("id", "of", text.collapse_ws(F.col("text")).alias("text"))


def _texts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("d").alias("of"), "text")
    return documents.unionByName(table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("c").alias("of"), "text"))


_STRIPPED = r"regexp_replace(x, '^[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '', 'g')"


@query(rf"""
    with t as (select doc_id as id, 'd' as of, text from documents union all select conv_id * 1000 + turn, 'c', text from conversations)
    select id, of, array_to_string(list_filter(list_transform(string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: {_STRIPPED}), lambda x: x <> ''), chr(10)) as text
    from t
""")
def clean_lines(spark, sf_dir):
    return _texts(spark, sf_dir).select("id", "of", text.clean_lines(F.col("text")).alias("text"))


@query("select l_orderkey, l_linenumber, l_quantity, case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as value from lineitem")
def parse_number(spark, sf_dir):
    """Prices printed the Turkish way, returned ones in parentheses."""
    plain = F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2)
    printed = F.translate(plain, ",.", ".,")
    printed = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("("), printed, F.lit(")"))).otherwise(printed)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", values.parse_number(printed).alias("value"))


@query("""
    select o_orderkey, case when o_orderkey % 3 = 2 then null else o_orderpriority end as label,
           case when o_orderkey % 3 = 0 then cast(o_orderdate as date) end as start,
           case when o_orderkey % 3 <> 2 then cast(o_orderdate as date) + case when o_orderkey % 3 = 0 then 90 else 0 end end as end
    from orders
""")
def parse_period(spark, sf_dir):
    day = lambda c: F.date_format(c, "dd.MM.yyyy")
    two = F.concat("o_orderpriority", day("o_orderdate"), F.lit(" - "), day(F.date_add("o_orderdate", 90)))
    printed = F.when(F.col("o_orderkey") % 3 == 0, two).when(F.col("o_orderkey") % 3 == 1, F.concat("o_orderpriority", F.lit(" "), day("o_orderdate"))).otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", values.parse_period(printed).alias("p")).select("o_orderkey", "p.label", "p.start", "p.end")


@query(f"select event_id, date_diff('second', date_trunc('second', ts), timestamp '{NOW}') + 3 * 3600 as delay_seconds from events")
def publish_delay(spark, sf_dir):
    """Times are wall-clock times three hours east of Greenwich."""
    now = F.to_utc_timestamp(F.lit(NOW).cast("timestamp"), "UTC")
    out = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("SECOND", "ts").cast("timestamp_ntz"))
    return watch.write_delay(out, "ts", now).select("event_id", "delay_seconds")


_FOLD = "lower(regexp_replace(translate(strip_accents(regexp_replace(n, '\\.[^.]*$', '')), 'ıİ', 'iI'), '[^\\x00-\\x7F]', '', 'g'))"


@query(rf"""
    with f as (select doc_id, doc_id // 3 as filing, case doc_id % 4 when 0 then 'Rapor ' || source || ' ENG.pdf' when 1 then 'annual report ' || source || '.docx' when 2 then lang || ' ' || source || '.pdf' else lang || ' ' || source || 'e.pdf' end as n from documents),
         w as (select *, regexp_extract_all({_FOLD}, '[a-z0-9]+') as w from f),
         e as (select *, array_to_string(w, '') as j,
                      case when list_has_any(w, ['eng', 'english', 'ingilizce']) or w[-1] = 'en' then true when list_has_any(w, ['tr', 'tur', 'turkce']) then false
                           else len(list_filter(['annual', 'report'], lambda x: list_contains(w, x))) > len(list_filter(['rapor'], lambda x: list_contains(w, x))) end as tagged from w),
         t as (select *, tagged or exists (select 1 from e o where o.filing = e.filing and e.j in (o.j || 'e', o.j || 'en')) as english from e)
    select doc_id, filing, n as file_name, not english or bool_and(english) over (partition by filing) as to_read from t
""")
def files_to_read(spark, sf_dir):
    kind = F.col("doc_id") % 4
    name = F.when(kind == 0, F.concat(F.lit("Rapor "), "source", F.lit(" ENG.pdf"))).when(kind == 1, F.concat(F.lit("annual report "), "source", F.lit(".docx")))
    name = name.when(kind == 2, F.concat("lang", F.lit(" "), "source", F.lit(".pdf"))).otherwise(F.concat("lang", F.lit(" "), "source", F.lit("e.pdf")))
    files = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 3).alias("filing"), name.alias("file_name"))
    return names.mark_to_read(files, "filing")


# --- windows, nests, joins ---


@query("""
    select conv_id, turn, role, last_value(case when role = 'user' then text end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as section
    from conversations
""")
def carry_section(spark, sf_dir):
    section = pages.carry_forward(F.when(F.col("role") == "user", F.col("text")), ["conv_id"], ["turn"])
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", section.alias("section"))


@query("""
    select l_orderkey, l_suppkey, min(l_partkey) as pos, arg_max(l_returnflag, struct_pack(a := l_partkey, b := l_returnflag, c := l_linestatus)) as file_name, arg_max(l_linestatus, struct_pack(a := l_partkey, b := l_returnflag, c := l_linestatus)) as url from lineitem group by 1, 2
""")
def dedupe_links(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", F.col("l_partkey").alias("pos"), F.col("l_returnflag").alias("file_name"), F.col("l_linestatus").alias("url"))
    return pages.dedupe_links(rows, ["l_orderkey", "l_suppkey"], ["pos"], ["file_name", "url"])


def _cells(spark, sf_dir):
    """Orders as header rows, their lines as item rows of one value cell each."""
    lines = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax")
    lines = lines.withColumn("row", F.row_number().over(order))
    day = F.date_format("o_orderdate", "dd.MM.yyyy")
    head = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderpriority", F.concat("o_orderpriority", day).alias("text"))
    cell = lambda kind, row, at, css, text: F.struct(F.lit(kind).alias("kind"), row.alias("row_pos"), F.lit(at).alias("cell_pos"), css.alias("css"), text.alias("text"))
    price = F.translate(F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2), ",.", ".,")
    item = F.array(
        cell("cell", F.col("row"), 0, F.lit("taxonomy-field-name-cell"), F.concat(F.col("l_partkey").cast("string"), F.lit("|x"))),
        cell("cell", F.col("row"), 1, F.lit("taxonomy-field-title"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string"))),
        cell("cell", F.col("row"), 2, F.concat(F.lit("taxonomy-context-value col-order-class-"), F.col("l_linenumber").cast("string")), F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(price)),
    )
    of_member = cell("member", F.lit(-1), 0, F.concat(F.lit("x col-index-"), F.col("l_linenumber").cast("string")), F.concat(F.lit("member "), F.col("l_linenumber").cast("string")))
    items = lines.select(F.col("l_orderkey").alias("key"), F.explode(F.concat(item, F.array(of_member))).alias("c"))
    heads = head.select("key", cell("cell", F.lit(0), 0, F.lit("row-header"), F.col("text")).alias("c"))
    return heads.unionByName(items).select(F.col("key").alias("disclosure_index"), F.lit(0).alias("table_no"), F.lit("equity").alias("title"), "c.*", F.col("c.text").alias("text_tr"))


@query("""
    with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) as r from lineitem),
         n as (select * from l where l_returnflag <> 'R')
    select l_orderkey as disclosure_index, cast(row_number() over (partition by l_orderkey order by r) - 1 as integer) as row_no, cast(l_partkey as varchar) as concept, 'line ' || l_linenumber as label,
           'member ' || l_linenumber as member, o_orderpriority as period_label, cast(o_orderdate as date) as period_end, l_extendedprice as value
    from n left join orders on o_orderkey = l_orderkey
""")
def statement_items(spark, sf_dir):
    items = statements.statement_items(_cells(spark, sf_dir))
    return items.select("disclosure_index", "row_no", "concept", "label", "member", "period_label", "period_end", "value")


def _nested(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("disclosure_index"), F.lit(0).alias("table_no"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("statement"),
        F.lit("TRY").alias("currency"), F.lit(None).cast("string").alias("consolidation"), F.col("o_orderkey").alias("row_no"), F.col("o_orderpriority").alias("concept"), F.col("o_totalprice").alias("value"),
    )
    return statements.nest_statements(rows, columns=["concept", "value"])


@query("""
    with s as (select o_custkey, nullif(o_orderstatus, 'P') as s, string_agg(o_orderpriority, ',' order by o_orderkey) as items, count(*) as n from orders group by 1, 2)
    select o_custkey as disclosure_index, string_agg(coalesce(s, '-') || '=' || items, ';' order by s is null, coalesce(s, '')) as nested from s group by 1
""")
def nest_statements(spark, sf_dir):
    flat = F.array_join(F.transform("financial_statements", lambda s: F.concat(F.coalesce(s["statement"], F.lit("-")), F.lit("="), F.array_join(F.transform(s["items"], lambda i: i["concept"]), ","))), ";")
    return _nested(spark, sf_dir).select("disclosure_index", flat.alias("nested"))


@query("""
    select o_custkey as disclosure_index,
           string_agg('f' || o_orderkey || ':' || case when o_orderkey % 2 = 0 then 'pdf' else 'skipped' end || ':' || case when o_orderkey % 2 = 0 then (o_orderkey % 5) else 0 end, ',' order by o_orderpriority, o_orderkey) as attachments
    from orders group by 1
""")
def nest_attachments(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    links = orders.select(F.col("o_custkey").alias("disclosure_index"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("f"), "o_orderkey").alias("file_id"), F.col("o_orderpriority").alias("file_name"), F.lit("u").alias("url"))
    parts = {f.name: F.lit(None).cast(f.dataType) for f in RESULT} | {"file_type": F.lit("pdf"), "page_count": (F.col("o_orderkey") % 5).cast("int"), "tables": F.array().cast(RESULT["tables"].dataType)}
    results = orders.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("disclosure_index"), F.concat(F.lit("f"), "o_orderkey").alias("file_id"), F.struct(*[parts[f.name].alias(f.name) for f in RESULT]).alias("result"))
    nested = attachments.nest_attachments(links, results)
    flat = F.array_join(F.transform("attachments", lambda a: F.concat_ws(":", a["file_id"], a["file_type"], a["page_count"].cast("string"))), ",")
    return nested.select("disclosure_index", flat.alias("attachments"))


@query("""
    select o_orderkey as disclosure_index from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'A' and l_linestatus = 'O')
""")
def complete_only(spark, sf_dir):
    """Lines are links, those returned are to be read; a finished one has a result."""
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("disclosure_index"), F.concat_ws("-", *table(spark, sf_dir, "lineitem").columns).alias("file_id"), (F.col("l_returnflag") == "A").alias("to_read"), "l_linestatus")
    listed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("disclosure_index"))
    return attachments.complete_only(listed, links, links.where("l_linestatus = 'F'"))


# --- pages of files ---


def _file_pages(spark, sf_dir):
    """Conversations as files, turns as pages; every second turn has images."""
    rows = table(spark, sf_dir, "conversations")
    return rows.select(F.col("conv_id").alias("file_id"), F.col("turn").alias("page_no"), "text", (F.col("turn") % 2 == 0).alias("has_images"))


_METHODS = """
    p as (select conv_id as file_id, turn as page_no, text, length(text) < 50 and turn % 2 = 0 as scanned from conversations),
    m as (select *, case when not scanned then 'text' when row_number() over (partition by file_id, scanned order by page_no) <= 1 then 'ocr' else 'skipped' end as method from p)
"""


@query(f"with {_METHODS} select file_id, page_no, method from m")
def ocr_budget(spark, sf_dir):
    return attachments.ocr_budget(_file_pages(spark, sf_dir), most=1).select("file_id", "page_no", "method")


@query(f"""
    with {_METHODS}
    select file_id, count(*) as page_count, count(*) filter (where method = 'ocr') as ocr_pages, count(*) filter (where method = 'skipped') as skipped_pages,
           string_agg('[Page ' || page_no || ']' || chr(10) || coalesce(text, ''), chr(10) || chr(10) order by page_no, text) as text
    from m group by 1
""")
def assemble_document(spark, sf_dir):
    return attachments.assemble_document(attachments.ocr_budget(_file_pages(spark, sf_dir), most=1))


def _boxes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("file_id"), (F.col("l_linenumber")).alias("page_no"), F.lit(0).alias("table_id"), (F.col("l_partkey") % 997).cast("int").alias("x"), (F.col("l_orderkey") % 499).cast("int").alias("y"),
        F.col("l_quantity").cast("int").alias("w"), F.lit(30).alias("h"), F.concat_ws("/", "l_orderkey", "l_partkey").alias("text"), F.lit(1000).alias("page_w"), F.lit(520).alias("page_h"),
    )


@query("""
    with recursive b as (select l_suppkey as f, l_linenumber as p, cast(l_partkey % 997 as integer) as x, cast(l_orderkey % 499 as integer) as y, cast(l_quantity as integer) as w, l_orderkey || '/' || l_partkey as t from lineitem),
        c as (select * from b where w >= 20 and x <> 0 and y <> 0 and x + w < 1000 and y + 30 < 520),
        k as (select *, row_number() over (partition by f, p order by y, x, t) as i, count(*) over (partition by f, p) as n from c),
        s as (select * from k where n >= 4),
        r as (select f, p, i, x, t, y as top, 1 as row from s where i = 1
              union all select s.f, s.p, s.i, s.x, s.t, case when s.y - r.top < 15 then r.top else s.y end, case when s.y - r.top < 15 then r.row else r.row + 1 end from r join s on s.f = r.f and s.p = r.p and s.i = r.i + 1),
        l as (select f, p, row, string_agg(t, ',' order by x, t) as cells from r group by 1, 2, 3)
    select f as file_id, p as page_no, string_agg(cells, ';' order by row) as rows from l group by 1, 2
""")
def grid_rows(spark, sf_dir):
    by = ["file_id", "page_no", "table_id"]
    tables = attachments.grid_rows(attachments.cell_boxes(_boxes(spark, sf_dir), by), by)
    return tables.select("file_id", "page_no", F.array_join(F.transform("rows", lambda r: F.array_join(r, ",")), ";").alias("rows"))


# --- web pages ---


@query(r"""
    with a as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as url from pages)
    select page_id, url, regexp_extract(url, '[^/]*$') as file_id from a group by all
""")
def page_links(spark, sf_dir):
    parsed = page_files.parse_pages(table(spark, sf_dir, "pages"), WEB, "page_id")
    return pages.page_links(parsed, "page_id").select("page_id", "url", "file_id")


@query(r"""
    with t as (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as t from pages)
    select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(t, '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) as title from t
""")
def page_titles(spark, sf_dir):
    parsed = page_files.parse_pages(table(spark, sf_dir, "pages"), WEB, "page_id")
    return pages.page_headers(parsed, "page_id").where("title = 'title'").select("page_id", F.col("value").alias("title"))


@query(r"""
    with a as (select page_id, regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->|<[^>]*>', chr(10), 'g') as t from pages),
         u as (select page_id, replace(replace(replace(replace(replace(t, '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as t from a)
    select page_id, 'legacy' as page_format,
           array_to_string(list_filter(list_transform(string_split_regex(t, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'), lambda x: trim(regexp_replace(x, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) as text
    from u
""")
def page_text(spark, sf_dir):
    parsed = page_files.parse_pages(table(spark, sf_dir, "pages"), WEB, "page_id")
    return parsed.select("page_id", pages.page_format().alias("page_format"), pages.page_text().alias("text"))


# --- bytes ---


@query("""
    select page_id, strlen(html) as size, md5(html) as payload,
           case page_id % 4 when 0 then 'pdf' when 1 then 'png' when 2 then 'jpeg' else 'unsupported' end as file_type
    from pages
""")
def unwrap_and_sniff(spark, sf_dir):
    """Pages in the envelope, some with the first bytes of another type before them."""
    data = F.encode("html", "UTF-8")
    size = F.lpad(F.hex(F.octet_length(data)), 8, "0")
    wrapped = F.concat(F.unhex(F.lit(binary.ENVELOPE + "00" * 13)), F.unhex(size), data)
    magic = F.when(F.col("page_id") % 4 == 0, "25504446").when(F.col("page_id") % 4 == 1, "89504E470D0A1A0A").when(F.col("page_id") % 4 == 2, "FFD8FF").otherwise("")
    payload = binary.unwrap_bytes(wrapped)
    kind = binary.sniff_type(binary.unwrap_bytes(F.concat(F.unhex(magic), payload)))
    return table(spark, sf_dir, "pages").select("page_id", F.octet_length(payload).cast("long").alias("size"), F.md5(payload).alias("payload"), kind.alias("file_type"))


@query("""
    select case when page_id % 7 = 0 then 'error' else 'text' end as file_type, count(*) as files, cast(sum(case when page_id % 7 = 0 then 0 else 1 end) as bigint) as pages,
           cast(0 as bigint) as ocr_pages, cast(0 as bigint) as tables
    from pages group by 1
""")
def attachment_stats(spark, sf_dir):
    """Pages as attachments, read by a plug-in that fails on every seventh."""
    files = table(spark, sf_dir, "pages").select(F.col("page_id").alias("file_id"), F.encode(F.concat_ws("|", "page_id", "html"), "UTF-8").alias("content"))

    def read(data: bytes) -> dict:
        number, _, body = data.partition(b"|")
        if int(number) % 7 == 0:
            raise ValueError("unreadable")
        return {"file_type": "text", "page_count": 1, "text": body.decode()}

    results = attachment_files.extract_with(files, read)
    return attachments.attachment_stats(results.select("result.*"))


# --- records, files and streams ---


@query("select o_orderkey as disclosure_index, o_orderdate as published, case when o_orderkey % 5 = 0 then null else o_orderpriority end as title from orders")
def jsonl_round_trip(spark, sf_dir):
    path = scratch(spark, "jsonl")
    title = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("disclosure_index"), F.col("o_orderdate").alias("published"), title.alias("title"))
    record_files.write_records(rows, path)
    return record_files.read_records(spark, path, rows.schema)


@query("select distinct o_orderkey as disclosure_index from orders")
def written_keys(spark, sf_dir):
    """Lines of either JSON writer's spacing."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("disclosure_index"), "o_orderpriority")
    line = record_files.record_json("disclosure_index", "o_orderpriority")
    line = F.when(F.col("disclosure_index") % 2 == 0, F.regexp_replace(line, '":', '": ')).otherwise(line)
    return resume.distinct_keys(record_files.written_keys(orders.select(line.alias("value"))))


@query("select year(o_orderdate) || '-01-01_' || year(o_orderdate) || '-12-31' as range_id, count(*) as n, count(distinct o_orderkey) as keys from orders group by 1")
def range_output(spark, sf_dir):
    """Written by range, twice, as two writers might; read together, each key once."""
    path = scratch(spark, "ranges")
    year = F.trunc("o_orderdate", "YYYY")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("disclosure_index"), ranges.range_id(year, F.date_sub(F.add_months(year, 12), 1)).alias("range_id"))
    for _ in range(2):
        record_files.write_records(rows, path, by="range_id")
    once = record_files.read_all_ranges(spark, path, rows.schema)
    return once.groupBy("range_id").agg(F.count("*").alias("n"), F.count_distinct("disclosure_index").alias("keys"))


def _landed_events(spark, sf_dir, path):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    for copy in range(2):
        events.where(f"event_id % 3 <> {copy}").write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("select event_id, ts, event_type from events")
def stream_dedupe(spark, sf_dir):
    """Overlapping snapshots of the events as a stream; each comes out once."""
    path = scratch(spark, "stream")
    stream = watch.once_each(_landed_events(spark, sf_dir, f"{path}/in"), "ts", "event_id", "400 days")
    run = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/out")
    run.awaitTermination()
    return spark.read.schema(table(spark, sf_dir, "events").select("event_id", "ts", "event_type").schema).parquet(f"{path}/out")


@query("select count(*) as n, count(distinct event_id) as keys from events where ts >= timestamp '2024-01-10 11:50:00'")
def stream_resume(spark, sf_dir):
    """Two runs of the append, the second from the start: it adds nothing."""
    path, schema = scratch(spark, "resume"), table(spark, sf_dir, "events").select("event_id", "ts", "event_type").schema
    stream = watch.catch_up(_landed_events(spark, sf_dir, f"{path}/in"), "ts", datetime.datetime(2024, 1, 10, 12))
    spark.createDataFrame([], schema).write.parquet(f"{path}/out")
    written = lambda: spark.read.schema(schema).parquet(f"{path}/out")
    write = lambda rows, _: rows.write.mode("append").parquet(f"{path}/out")
    for k in range(2):
        watch.append_once(stream, "event_id", written, write, f"{path}/state{k}", order=F.col("ts")).awaitTermination()
    return written().agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("keys"))


@query("""
    with e as (select user_id, ts, event_type = 'error' as failed, row_number() over (partition by user_id order by ts, event_id) as i from events where event_type in ('error', 'purchase')),
         s as (select user_id, coalesce(min(case when not failed then i end), 1000000000) as ok, coalesce(min(case when failed and f = 3 then i end), 1000000000) as third
               from (select *, count(*) filter (where failed) over (partition by user_id order by i) as f from e) group by 1)
    select e.user_id as key, cast(count(*) filter (where failed and i < least(ok, third + 1)) as integer) as attempts,
           case when ok < third then 'done' when third < 1000000000 then 'given_up' else 'waiting' end as status,
           case when least(ok, third) = 1000000000 then max(ts) + interval 300 seconds end as next_try
    from e join s using (user_id) group by 1, ok, third
""")
def stream_retry(spark, sf_dir):
    """Errors are failed attempts of a user, purchases successes; every user's state at the end. The second half of the
    time lands after the first, and a stream that goes on from the checkpoint of the one before reads it."""
    path = scratch(spark, "retry")
    retry.use_timers(spark)
    events = table(spark, sf_dir, "events").where("event_type in ('error', 'purchase')")
    rows = events.select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("time"), (F.col("event_type") == "purchase").alias("ok"), F.lit(None).cast("string").alias("row"))
    half = rows.agg(F.timestamp_seconds((F.unix_seconds(F.min("time")) + F.unix_seconds(F.max("time"))) / 2)).first()[0]
    write = lambda states, number: watch.write_batch(states, f"{path}/out", "all", number)
    for part in (F.col("time") < half, F.col("time") >= half):
        rows.where(part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in").withWatermark("time", "0 seconds")
        retry.attempts(stream, keep=400 * 86_400).writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    states = spark.read.parquet(f"{path}/out").where(F.col("status") != retry.TRY)
    last = lambda c: F.max_by(c, "batch").alias(c)
    return states.groupBy("key").agg(last("attempts"), last("status"), F.max_by(F.struct("next_try"), "batch")["next_try"].cast("timestamp_ntz").alias("next_try"))


@query()
def full_record(spark, sf_dir):
    """Finished records, as JSON: documents as listing rows, web pages as their pages, the files that these link to as
    attachments, read if the document has a label. Those of documents without one have not landed."""
    docs = table(spark, sf_dir, "documents")
    listed = docs.select(F.col("doc_id").alias("disclosure_index"), F.concat(F.lit("d"), "doc_id").alias("disclosure_id"), F.lit("2026-10-08 09:15:00").cast("timestamp_ntz").alias("publish_date"), F.col("source").alias("stock_code"), F.col("lang").alias("disclosure_class"))
    for f in RECORD.fields[:21]:
        if f.name not in listed.columns:
            listed = listed.withColumn(f.name, F.lit(None).cast(f.dataType))
    parsed = checkpoint(page_files.parse_pages(table(spark, sf_dir, "pages").withColumnRenamed("page_id", "disclosure_index"), WEB))
    label = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("disclosure_index"), "quality")
    result = F.when(F.col("quality") == 1, attachment_files.result_struct("text")).otherwise(attachment_files.result_struct("unsupported"))
    results = pages.page_links(parsed).join(label, "disclosure_index").select("disclosure_index", "file_id", result.alias("result"))
    out = records.records(listed, parsed, results)
    return out.select("disclosure_index", record_files.record_json(*[f.name for f in RECORD]).alias("record"))
