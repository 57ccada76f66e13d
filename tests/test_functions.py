from __future__ import annotations

import datetime as dt
import hashlib
import math
from decimal import Decimal

from pyspark.sql import functions as F

from mixlens.functions import cleaning, dates, ratios, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, values, expression, kind="string"):
    df = column(spark, values, kind)
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_whole_numbers_are_cut_and_bad_ones_are_zero(spark):
    values = ["12.9", "-12.9", " 7 ", "abc", "", None, "NaN", "12d", "1e3", "9007199254740993"]
    assert apply(spark, values, cleaning.to_long0("x")) == [12, -12, 7, 0, 0, 0, 0, 0, 1000, 9007199254740993]
    assert apply(spark, [12.9, None, math.nan], cleaning.to_long0("x"), "double") == [12, 0, 0]


def test_money(spark):
    values = ["1234.5", "abc", None, "1e2", "0.00005"]
    got = apply(spark, values, cleaning.to_money("x"))
    assert got == [Decimal("1234.5"), None, None, Decimal(100), Decimal("0.0001")]
    assert apply(spark, ["abc", None], cleaning.to_money0("x")) == [0, 0]


def test_percent_and_currency(spark):
    assert apply(spark, ["45.2%", "7%%", "n/a", None, "3d%", "5"], cleaning.parse_pct("x")) == [45.2, 7, None, None, None, 5]
    got = apply(spark, ["$1,234.50", "-$5", "", None, "x"], cleaning.parse_currency0("x"))
    assert got == [Decimal("1234.5"), Decimal(-5), 0, 0, 0]


def test_dates(spark):
    values = ["2025-02-01", "2025-02-01 10:11:12", "2025-13-45", "x", None, "02/01/2025", "Feb 01, 2025", "20250201"]
    day = dt.date(2025, 2, 1)
    assert apply(spark, values, cleaning.to_date_or_null("x")) == [day, day, None, None, None, None, None, None]
    df = column(spark, values)
    got = [r[0] for r in df.orderBy("i").select(cleaning.date_column(df, "x")).collect()]
    assert got == [day, day, None, None, None, day, day, day]


def test_ratios_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(ratios.safe_ratio("a", "b")).collect()] == [None, 0.25, None]
    assert [r[0] for r in df.select(ratios.eps_ratio("a", "b", 3)).collect()] == [1e9, 0.25, None]
    halves = apply(spark, [1.005, 0.285, 2.675, 27478.954999999998], ratios.round_to("x", 2), "double")
    assert halves == [1.01, 0.29, 2.68, 27478.96]


def test_labels_and_cut(spark):
    x = F.col("x")
    got = apply(spark, [9.0, 5.0, 1.0, None], ratios.label([(x > 8, "a"), (x > 4, "b")], "c"), "double")
    assert got == ["a", "b", "c", "c"]
    assert apply(spark, ["abcdef", None], ratios.cut("x", 3)) == ["abc", None]
    assert apply(spark, ["a", None], ratios.or_default("x", "unknown")) == ["a", "unknown"]


def test_calendar(spark):
    days = [dt.date(2025, 2, 1), dt.date(2024, 12, 30), dt.date(2025, 1, 26)]
    df = column(spark, days, "date").orderBy("i")
    iso = [tuple(r) for r in df.select(*dates.iso_date_parts("x")).collect()]
    assert iso == [(2025, 2, 5, 6, 1, 2025), (2024, 12, 1, 1, 0, 2025), (2025, 1, 4, 7, 1, 2025)]
    named = [tuple(r) for r in df.select(*dates.calendar_date_parts("x")).collect()]
    assert named[0] == (2025, 2, 1, 1, 7, "Saturday", "February")
    assert apply(spark, days, dates.week_start_sunday("x"), "date") == [
        dt.date(2025, 1, 26), dt.date(2024, 12, 29), dt.date(2025, 1, 26),
    ]
    assert apply(spark, days, dates.week_start_monday("x"), "date")[0] == dt.date(2025, 1, 27)


TERMS = [("acme", "Brand_A"), ("acme gadget", "Brand_A_1"), ("a.b", "X$1"), ("qed", "Y")]


def test_scrub_order_case_and_quoting(spark):
    values = ["ACME Gadget and acme", "a.b aXb", "tacmeq", None, "QeD ünacme"]
    given_order = apply(spark, values, text.scrub_terms("x", TERMS, order="given"))
    longest = apply(spark, values, text.scrub_terms("x", TERMS))
    assert given_order == ["Brand_A Gadget and Brand_A", "X$1 aXb", "tBrand_Aq", None, "Y ünBrand_A"]
    assert longest == ["Brand_A_1 and Brand_A", "X$1 aXb", "tBrand_Aq", None, "Y ünBrand_A"]
    words = apply(spark, values, text.scrub_terms("x", TERMS, whole_word=True))
    assert words[2] == "tacmeq" and words[4] == "Y ünacme"


def test_no_term_survives(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    scrubbed = docs.select(text.scrub_terms("text", [("the", "_1_"), ("que", "_2_")]).alias("t"))
    assert scrubbed.where(F.lower("t").contains("the") | F.lower("t").contains("que")).count() == 0


# An id and the first eight digits of its SHA-1 in capitals, worked out beforehand.
DIGESTS = {"B0ABCDEFGH": "B5B78BA5", "B000000001": "A980DA53", "B0ABCDEFG1": "6FD14CCC"}


def test_embedded_ids(spark):
    a, b, c = (f"ASIN_{DIGESTS[x]}" for x in DIGESTS)
    cases = {
        "x B0ABCDEFGH y B000000001, B0ABCDEFGH": f"x {a} y {b}, {a}",
        "B0ABCDEFGH": a,
        "XB0ABCDEFGH": "XB0ABCDEFGH",
        "B0ABCDEFGHI": "B0ABCDEFGHI",
        "b0abcdefgh": "b0abcdefgh",
        "éB0ABCDEFGH": "éB0ABCDEFGH",
        "B0ABCDEFGH-B0ABCDEFG1_B0ABCDEFG2": f"{a}-B0ABCDEFG1_B0ABCDEFG2",
        "(B0ABCDEFG1)B000000001": f"({c}){b}",
        "": "",
    }
    assert apply(spark, [*cases, None], text.hash_embedded_ids("x")) == [*cases.values(), None]


def test_many_ids_in_one_text(spark):
    ids = [f"B0{i:08d}" for i in range(30_000)]
    (got,) = apply(spark, [" ".join(ids)], text.hash_embedded_ids("x"))
    parts = got.split(" ")
    assert len(parts) == len(ids) and parts[1] == f"ASIN_{hashlib.sha1(ids[1].encode()).hexdigest()[:8].upper()}"
    assert len(set(parts)) > 29_990 and all(p.startswith("ASIN_") for p in parts)


def test_ids_and_urls(spark):
    def sha(v, n):
        return hashlib.sha1(v.encode()).hexdigest()[:n]

    assert apply(spark, ["a", None, "ü"], text.hash_id("x", "SKU")) == ["SKU_" + sha("a", 10), None, "SKU_" + sha("ü", 10)]
    assert apply(spark, [17, None], text.hash_id("x", "P"), "bigint") == ["P_" + sha("17", 10), None]
    url = "https://e.com/a b"
    assert apply(spark, [url, " \t", "", None], text.hash_url("x")) == [
        "https://hashed-url.example/" + sha(url, 12), " \t", "", None,
    ]


def test_dates_of_exports(spark):
    day = dt.date(2025, 3, 1)
    same = [
        "2025-03-01", "3/1/2025", "03/01/2025", "2025/03/01", "Mar 1, 2025", "Mar 01, 2025", "01-Mar-25", "1-Mar-2025",
        "3/1/2025 0:00", "3/1/2025 12:30:00 PM", "2025-03-01 10:00:00", "2025-03-01T10:00:00Z", "20250301", "3/1/25",
        "March 1, 2025", "1 Mar 2025", " 3/1/2025 ", "3-1-2025",
    ]
    bad = ["13/13/2025", "soon", "", None, "2025-02-30", "3/1"]
    df = column(spark, same + bad).withColumnRenamed("x", "start_date").orderBy("i")
    got = [r[0] for r in df.select(cleaning.date_column(df, "start_date")).collect()]
    assert got == [day] * len(same) + [None] * len(bad)
    # Empty cells are missing, not unreadable.
    assert [tuple(r) for r in cleaning.unreadable_dates(df, "start_date").collect()] == [("start_date", 4)]
