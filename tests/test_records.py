import datetime
import json
import pathlib

from pyspark.sql import functions as F

from bourselake import schemas
from bourselake.jobs import backfill, page_queries, statements, watch
from bourselake.operators import attachments, listing, resume
from bourselake.sources import attachments as files
from bourselake.sources import listing as listings
from bourselake.sources import records

URL = "https://disclosures.example/{}"
PAGE = '<a href="/api/file/download/f{0}">rapor.pdf</a><a href="/api/file/download/e{0}">rapor en.pdf</a><div class="disclosureScrollableArea"><table><tr><td class="txtWhite">S</td></tr><tr><td><div class="bold font14">L</div></td><td>v{0}</td></tr></table></div>'


def land(tmp_path, rows, name="a.json"):
    folder = tmp_path / "listing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps([{"disclosureBasic": r, "other": 1} for r in rows]), encoding="utf-8")


def row(i, day="08.10.2026", stock="AAA, BBB", **more):
    return {k: None for k in schemas.LISTING_KEYS} | {"disclosureIndex": i, "disclosureId": f"d{i}", "publishDate": f"{day} 09:15:00", "stockCode": stock, "disclosureClass": "ODA", "extra": 1} | more


def landed(spark, tmp_path, indexes):
    (tmp_path / "pages").mkdir(exist_ok=True)
    for i in indexes:
        (tmp_path / "pages" / f"{i}.html").write_text(PAGE.format(i), encoding="utf-8")
    (tmp_path / "watchlist").mkdir(exist_ok=True)
    (tmp_path / "watchlist" / "codes.txt").write_text("# Banks\nBBB - a bank\n")
    data = [(i, f"f{i}") for i in indexes]
    result = spark.createDataFrame(data, "disclosure_index long, file_id string").withColumn("result", files.result_struct("error", F.lit("ValueError('x')")))
    result.write.mode("overwrite").parquet(str(tmp_path / "results"))
    return spark.read.parquet(str(tmp_path / "results"))


def test_backfill_is_complete_and_idempotent(spark, tmp_path):
    land(tmp_path, [row(1), row(2), row(2), row(3, stock="CCC", relatedStocks="X,BBB"), row(4, stock="CCC"), row(5, day="09.10.2026"), row(6), row(7, publishDate=None)])
    results = landed(spark, tmp_path, [1, 2, 3, 4])  # the page of 6 has not landed
    args = (spark, str(tmp_path), str(tmp_path / "out"), datetime.date(2026, 10, 1), datetime.date(2026, 10, 8), URL, results.where("disclosure_index <> 2"))
    assert tuple(backfill.run(*args).first()) == (4, 2, False)
    args = (*args[:-1], results)
    assert tuple(backfill.run(*args).first()) == (4, 1, False)
    assert tuple(backfill.run(*args).first()) == (4, 1, False)
    lines = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(x["disclosure_index"] for x in lines) == [1, 2, 3]
    one = next(x for x in lines if x["disclosure_index"] == 1)
    assert list(one) == [f.name for f in schemas.RECORD] and len(one) == 27
    assert one["publish_date"] == "2026-10-08 09:15:00" and one["url"].endswith("/1") and one["title"] is None
    assert one["fields"] == [{"section": "S", "concept": None, "label": "L", "value": "v1"}]
    assert [(a["file_name"], a["file_type"], a["error"]) for a in one["attachments"]] == [("rapor en.pdf", "skipped", None), ("rapor.pdf", "error", "ValueError('x')")]
    back = records.read_records(spark, str(tmp_path / "out"))
    assert back.schema == schemas.RECORD and back.where("disclosure_index = 1").first().publish_date == datetime.datetime(2026, 10, 8, 9, 15)


def test_watch_appends_each_once(spark, tmp_path):
    results = landed(spark, tmp_path, [1, 2, 3])
    assert results.count() == 3
    run = lambda state: watch.run(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / state), datetime.datetime(2026, 10, 8, 9, 20), URL, str(tmp_path / "results")).awaitTermination()
    land(tmp_path, [row(1), row(2, day="07.10.2026")])
    run("state")
    land(tmp_path, [row(1), row(3)], "b.json")
    run("state")
    run("fresh state")
    assert sorted(r[0] for r in records.read_written_keys(spark, str(tmp_path / "out")).collect()) == [1, 3]


def test_listing_errors(spark, tmp_path):
    land(tmp_path, [row("12"), row(2), row(3, disclosureId=None)])
    good, bad = listings.quarantine(listings.read_listing(spark, str(tmp_path / "listing"), strict=False))
    assert [r.disclosureIndex for r in good.collect()] == [2] and bad.count() == 2


def test_long_watchlist_gives_the_same_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "A, B", None), (2, None, "C"), (3, "D", "E"), (4, None, None), (5, " ,", "B")], "k long, own string, related string")
    codes = spark.createDataFrame([("B",), ("C",), (None,), ("B",)], "code string")
    for most in (10, 1):
        monkeypatch.setattr(listing, "LITERAL_CODES", most)
        assert sorted(r.k for r in listing.on_watchlist(rows, codes, F.col("own"), F.col("related"), "k").collect()) == [1, 2, 5]
    assert listing.on_watchlist(rows, codes.limit(0), F.col("own"), F.col("related"), "k").collect() == []


def test_heads_of_lines_and_missing_folder(spark, tmp_path):
    lines = spark.createDataFrame([('{"disclosure_index": 7,"a":1}',), ('{"disclosure_index":8}',), ('{"a":9}',), ("",)], "value string")
    assert sorted(r[0] for r in records.written_keys(lines).collect()) == [7, 8]
    assert records.read_written_keys(spark, str(tmp_path / "none")).collect() == []


def test_rounds_stop_when_nothing_is_left(spark):
    done = []
    listed, written = lambda: spark.range(5).withColumnRenamed("id", "disclosure_index"), lambda: spark.createDataFrame([(x,) for x in done], "disclosure_index long")
    assert resume.in_rounds(listed, written, lambda todo, n: done.extend(r[0] for r in todo.limit(2).collect())) == 0
    done.clear()
    assert resume.in_rounds(listed, written, lambda todo, n: None, rounds=1) == 5


def test_plug_in_errors_are_rows(spark):
    data = spark.createDataFrame([("a", bytearray(b"%PDF")), ("b", bytearray(b""))], "file_id string, content binary")

    def read(content):
        return {"file_type": "pdf", "page_count": 1 // len(content) + 1, "tables": [{"page": 1, "method": "text", "rows": []}]}

    got = {r.file_id: r.result for r in files.extract_with(data, read).collect()}
    assert got["a"].file_type == "pdf" and got["a"].page_count == 1 and got["b"].file_type == "error" and "ZeroDivisionError" in got["b"].error
    links = spark.createDataFrame([(1, 0, "a", "z.pdf", "u"), (1, 1, "b", "a.pdf", "u"), (1, 2, "c", "a.pdf", "u")], "disclosure_index long, pos int, file_id string, file_name string, url string")
    nested = attachments.nest_attachments(links, files.extract_with(data, read).withColumn("disclosure_index", F.lit(1).cast("long"))).first().attachments
    assert [(a.file_id, a.file_type, a.tables) for a in nested] == [("b", "error", []), ("c", "skipped", []), ("a", "pdf", [])]


def test_crashes_and_wrong_shapes_cost_one_file(spark):
    data = [("crash", b"1"), ("half", b"2"), ("shape", b"3"), ("number", b"4"), ("slow", b"5"), ("fine", b"6"), ("none", None)]
    df = spark.createDataFrame([(a, None if b is None else bytearray(b)) for a, b in data], "file_id string, content binary").coalesce(1)

    def read(content):
        import os
        import time

        if content == b"1":
            os._exit(9)
        if content == b"5":
            time.sleep(30)
        made = {b"2": {"text": "p\ud83dq", "tables": [{"page": 1, "method": "m\udc00", "rows": [["a", None, 3]]}]}, b"3": ["no dict"], b"4": {"page_count": "many"}}
        return made.get(content, {"file_type": "text", "text": "ok", "unknown": 1})

    got = {r.file_id: r.result for r in files.extract_with(df, read, seconds=3).collect()}
    assert "exit code 9" in got["crash"].error and got["half"].text == "p?q" and got["half"].tables[0].rows == [["a", None, "3"]]
    assert {got[x].file_type for x in ("crash", "shape", "number", "slow")} == {"error"} and "more than 3" in got["slow"].error
    assert got["fine"].text == got["none"].text == "ok"


def test_watch_waits_for_late_pages(spark, tmp_path):
    landed(spark, tmp_path, [1])
    run = lambda: watch.run(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "state"), datetime.datetime(2026, 10, 8, 9, 20), URL, str(tmp_path / "results"), pause=0).awaitTermination()
    written = lambda: sorted(r[0] for r in records.read_written_keys(spark, str(tmp_path / "out")).collect())
    land(tmp_path, [row(1), row(2), row(3)])
    run()
    assert written() == [1]
    landed(spark, tmp_path, [1, 2])
    land(tmp_path, [row(1)], "b.json")
    run()
    assert written() == [1, 2]
    for name in "cd":
        land(tmp_path, [row(1)], f"{name}.json")
        run()
    landed(spark, tmp_path, [1, 2, 3])
    land(tmp_path, [row(2)], "e.json")
    run()
    assert written() == [1, 2]  # three tries are over: 3 is left to the backfill


def test_backfill_reports(spark, tmp_path):
    land(tmp_path, [row(1), row(2), row(3, day="30.09.2026")])
    results = landed(spark, tmp_path, [1])
    args = (spark, str(tmp_path), str(tmp_path / "out"), datetime.date(2026, 9, 1), datetime.date(2026, 10, 8), URL)
    backfill.run(*args, results, rounds=1)
    job = backfill.Backfill(*args)
    assert [tuple(r) for r in job.months().collect()] == [(datetime.date(2026, 10, 1), 2, 1), (datetime.date(2026, 9, 1), 1, 1)]
    assert [r[0] for r in job.missing().collect()] == [2, 3]


def test_rounds_list_again_and_wait(spark, tmp_path):
    """Between rounds another list lands, and a page that was late."""
    land(tmp_path, [row(1), row(2)])
    landed(spark, tmp_path, [1])
    job = backfill.Backfill(spark, str(tmp_path), str(tmp_path / "out"), datetime.date(2026, 10, 1), datetime.date(2026, 10, 8), URL)
    waits = []

    def pause(seconds):
        waits.append(seconds)
        if len(waits) == 1:
            land(tmp_path, [row(3)], "b.json")
            landed(spark, tmp_path, [1, 2, 3])

    process = lambda todo, n: job.process(todo, spark.read.parquet(str(tmp_path / "results")), n)
    assert resume.in_rounds(job.list_again, job.written, process, 3, wait=7, failed_lists=job.failed.count, pause=pause) == 0
    assert waits == [7, 7] and tuple(job.report().first()) == (3, 0, 0, True)
    assert sorted(r[0] for r in job.written().select("disclosure_index").collect()) == [1, 2, 3]


def test_failed_lists_are_counted_and_read_again(spark, tmp_path):
    land(tmp_path, [row(1), row(2)])
    (tmp_path / "listing" / "b.json").write_text(json.dumps([{"disclosureBasic": row(3)}])[:-20])
    results = landed(spark, tmp_path, [1, 2, 3])
    job = backfill.Backfill(spark, str(tmp_path), str(tmp_path / "out"), datetime.date(2026, 10, 1), datetime.date(2026, 10, 8), URL)
    assert job.rounds(lambda: results, 1) == 0 and tuple(job.report().first()) == (2, 0, 1, False)
    assert [r.file.rsplit("/", 1)[1] for r in job.failed.collect()] == ["b.json"]
    land(tmp_path, [row(3)], "b.json")
    again = backfill.Backfill(spark, str(tmp_path), str(tmp_path / "out"), datetime.date(2026, 10, 1), datetime.date(2026, 10, 8), URL)
    again.rounds(lambda: results, 0)
    assert tuple(again.report().first()) == (3, 0, 0, True)


def test_days_out_of_range_are_not_opened(spark, tmp_path):
    for day in ("07", "08", "09"):
        land(tmp_path, [row(int(day), f"{day}.10.2026")], "x.json")
        (tmp_path / "listing" / f"day=2026-10-{day}").mkdir()
        (tmp_path / "listing" / "x.json").rename(tmp_path / "listing" / f"day=2026-10-{day}" / "x.json")
    (tmp_path / "listing" / "day=2026-10-07" / "bad.json").write_text("[{")
    landed(spark, tmp_path, [7, 8, 9])
    job = backfill.Backfill(spark, str(tmp_path), str(tmp_path / "out"), datetime.date(2026, 10, 8), datetime.date(2026, 10, 8), URL, by_day=True)
    assert [r.disclosure_index for r in job.rows.collect()] == [8] and job.failed.count() == 0
    rows = listings.read_listing(spark, str(tmp_path / "listing/*"), strict=False)
    listings.write_by_day(rows, str(tmp_path / "days"))
    days = listings.read_by_day(spark, str(tmp_path / "days"), datetime.date(2026, 10, 8), datetime.date(2026, 10, 9))
    assert sorted(r.disclosureIndex for r in days.collect()) == [8, 9]
    assert "PartitionFilters: [isnotnull(day" in days._jdf.queryExecution().executedPlan().toString()


def test_facts_of_a_load_replace_those_before(spark, tmp_path):
    path, day = str(tmp_path / "facts"), datetime.date
    fact, of = "disclosure_index long, table_no int, row_no int, value double", "disclosure_index long, month date"
    assert statements.read_facts(spark, path) is None
    load = lambda facts, listed: statements.upsert_facts(spark, path, spark.createDataFrame(facts, fact), spark.createDataFrame(listed, of))
    load([(1, 0, 0, 1.0), (1, 0, 1, 2.0), (2, 0, 0, 3.0), (3, 0, 0, 4.0)], [(1, day(2026, 1, 1)), (2, day(2026, 1, 1)), (3, day(2026, 2, 1))])
    february = {*(tmp_path / "facts" / "month=2026-02-01").glob("part*")}
    load([(1, 0, 0, 9.0), (5, 0, 0, 5.0)], [(1, day(2026, 1, 1)), (5, day(2026, 3, 1))])
    got = lambda: sorted(tuple(r) for r in statements.read_facts(spark, path).select("disclosure_index", "row_no", "value").collect())
    assert got() == [(1, 0, 9.0), (2, 0, 3.0), (3, 0, 4.0), (5, 0, 5.0)]
    assert {*(tmp_path / "facts" / "month=2026-02-01").glob("part*")} == february  # another month's files are left alone
    load([], [(5, day(2026, 3, 1))])
    load([], [(5, day(2026, 3, 1))])
    assert got() == [(1, 0, 9.0), (2, 0, 3.0), (3, 0, 4.0)]


def _files(path):
    return sorted(f for f in pathlib.Path(path.removeprefix("file:")).rglob("*") if f.is_file())


def test_page_files_are_made_by_all_tasks_and_have_no_checksums_beside_them(spark, small):
    made = [f for f in _files(page_queries._landed_pages(spark, small)) if f.name != "_SUCCESS"]
    assert len(made) == len({f.parent for f in made}) == spark.read.parquet(f"{small}/pages.parquet").where("html is not null").count()
    assert not any(f.name.endswith(".crc") for f in made) and len({f.name.split("-")[1] for f in made}) == 4


def test_attachment_files_share_a_folder_for_each_task(spark, small):
    made = [f for f in _files(page_queries._landed_files(spark, small)) if f.name != "_SUCCESS"]
    assert len(made) == spark.read.parquet(f"{small}/pages.parquet").where("html is not null").count() and len({f.parent for f in made}) <= 4
