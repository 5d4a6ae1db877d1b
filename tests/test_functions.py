import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bourselake.functions import binary, names, ranges, text, values
from bourselake.sources.listing import watchlist

D = datetime.date


def each(spark, f, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_code_list(spark):
    got = each(spark, text.code_list, ["ISATR, ISBTR, ISCTR", None, "", " , ", "A, A ,B"])
    assert [sorted(x) for x in got] == [["ISATR", "ISBTR", "ISCTR"], [], [], [], ["A", "B"]]


ODD = st.text(alphabet=st.sampled_from(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      　abİé😀"), max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ODD, min_size=200, max_size=200))
def test_white_space_is_pythons(spark, strings):
    assert each(spark, text.collapse_ws, strings) == [" ".join(s.split()) for s in strings]
    assert each(spark, text.clean_lines, strings) == ["\n".join(x.strip() for x in s.splitlines() if x.strip()) for s in strings]
    assert each(spark, text.body_lines, strings) == ["\n".join(" ".join(x.split()) for x in s.splitlines() if x.strip()) for s in strings]


def test_periods(spark):
    got = each(spark, values.parse_period, ["Cari Dönem01.01.2026 - 30.06.2026", "Önceki Dönem 31.12.2025", "01.01.2026 30.06.2026", "Dipnot", "31.02.2026", None])
    assert [tuple(x) if x else None for x in got] == [("Cari Dönem", D(2026, 1, 1), D(2026, 6, 30)), ("Önceki Dönem", None, D(2025, 12, 31)), ("01.01.2026", None, D(2026, 6, 30)), None, ("", None, None), None]
    assert each(spark, values.has_impossible_date, ["31.02.2026", "x 01.01.2026 - 31.04.2026", "01.01.2026", "x", None]) == [True, True, False, False, False]


def test_numbers(spark):
    given_ = ["1.234.567,89", "01.09.2026", "(1.234)", "-7", "1234,5", "12.34", "+5", "", "(-5)", "(5", "5)", "(0)", None]
    got = each(spark, values.parse_number, given_)
    assert got == [1234567.89, None, -1234, -7, 1234.5, None, None, None, 5, -5, 5, 0, None]
    assert math.copysign(1, got[11]) == -1


def test_days_and_times(spark):
    assert each(spark, values.parse_day, ["08.10.2026", "8.1.2026", "31.02.2026", "x"]) == [D(2026, 10, 8), D(2026, 1, 8), None, None]
    assert each(spark, values.published, ["08.10.2026 09:15:00", "x"]) == [datetime.datetime(2026, 10, 8, 9, 15), None]
    delay = each(spark, lambda c: values.publish_delay_seconds(values.published(c), F.lit("2026-10-08 06:15:30").cast("timestamp")), ["08.10.2026 09:15:00"])
    assert delay == [30]


def test_file_names(spark):
    words = each(spark, names.name_words, ["GWIND_Yatırımcı_Sunumu.pdf", "a.b.pdf", "nodot", ".pdf", "İŞ ﬁnans.PDF", None])
    assert words == [["gwind", "yatirimci", "sunumu"], ["a", "b"], ["nodot"], [], ["is", "finans"], None]
    english = each(spark, lambda c: names.is_english(names.name_words(c)), ["BİGTK (ENG).pdf", "RAPORU_ABC EN.pdf", "en buyuk rapor.pdf", "Annual Report tr.pdf", "annual report rapor.pdf", "x.pdf", ".pdf"])
    assert english == [True, True, False, False, True, False, False]


def test_files_to_read(spark):
    files = [(1, "Vkfyo07102026.pdf"), (1, "Vkfyo07102026e.pdf"), (2, "report en.pdf"), (2, "results en.pdf"), (3, "a.pdf"), (3, "aen.pdf"), (3, "a.pdf")]
    got = names.mark_to_read(spark.createDataFrame(files, "disclosure_index long, file_name string")).collect()
    assert sorted((r.disclosure_index, r.file_name, r.to_read) for r in got) == sorted([(1, "Vkfyo07102026.pdf", True), (1, "Vkfyo07102026e.pdf", False), (2, "report en.pdf", True), (2, "results en.pdf", True), (3, "a.pdf", True), (3, "a.pdf", True), (3, "aen.pdf", False)])


def spans(spark, f, *args):
    return [(r.first, r.last) for r in f(spark.createDataFrame([args[:2]], "start date, end date"), *args[2:]).collect()]


def test_month_ranges_and_parts(spark):
    assert spans(spark, ranges.month_ranges, D(2024, 11, 15), D(2025, 2, 10)) == [(D(2025, 2, 1), D(2025, 2, 10)), (D(2025, 1, 1), D(2025, 1, 31)), (D(2024, 12, 1), D(2024, 12, 31)), (D(2024, 11, 15), D(2024, 11, 30))]
    assert spans(spark, ranges.month_ranges, D(2025, 1, 2), D(2025, 1, 1)) == []
    assert spans(spark, ranges.equal_parts, D(2025, 1, 1), D(2025, 1, 10), 4) == [(D(2025, 1, a), D(2025, 1, b)) for a, b in [(1, 2), (3, 5), (6, 7), (8, 10)]]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dates(D(2000, 1, 1), D(2030, 1, 1)), st.integers(0, 900), st.integers(1, 20))
def test_ranges_tile(spark, start, days, parts):
    end = start + datetime.timedelta(days=days)
    for own in (spans(spark, ranges.month_ranges, start, end), spans(spark, ranges.equal_parts, start, end, parts)):
        covered = sorted(a + datetime.timedelta(days=k) for a, b in own for k in range((b - a).days + 1))
        assert covered == [start + datetime.timedelta(days=k) for k in range(days + 1)]


def test_watchlist(spark):
    lines = ["# heading", "", "  ", "CODE   - title", "BARE", " # x", "BARE"]
    assert sorted(r.code for r in watchlist(spark.createDataFrame([(x,) for x in lines], "value string")).collect()) == ["#", "BARE", "CODE"]


@pytest.mark.parametrize(("payload", "size"), [(b"%PDF-1", 6), (b"abc", 99), (b"abcdef", 2), (b"", 0)])
def test_envelope(spark, payload, size):
    wrapped = bytes.fromhex(binary.ENVELOPE) + bytes(13) + size.to_bytes(4, "big") + payload
    assert bytes(each(spark, binary.unwrap_bytes, [bytearray(wrapped)], "binary")[0]) == payload[:size]


def test_bare_bytes_and_types(spark):
    bare = [b"%PDF", b"\x89PNG\r\n\x1a\n.", b"\xff\xd8\xff", b"GIF89a", b"BM..", b"MM\x00*", b"RIFF....WEBP", b"text", bytes.fromhex(binary.ENVELOPE)]
    assert [bytes(x) for x in each(spark, binary.unwrap_bytes, [bytearray(b) for b in bare], "binary")] == bare
    assert each(spark, binary.sniff_type, [bytearray(b) for b in bare], "binary") == ["pdf", "png", "jpeg", "gif", "bmp", "tiff", "webp", "unsupported", "unsupported"]
