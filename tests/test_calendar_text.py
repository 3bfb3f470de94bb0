"""Calendar parts, number format, word count (RDD = DataFrame)."""

import datetime as dt
import os


from fixtures import TEXT_COUNTS, TEXT_LINES, write_lines
from meterwise.functions import calendar as cal
from meterwise.functions.text import explode_words
from meterwise.operators.wordcount import word_count, word_count_of_texts, word_count_rdd
from meterwise.sources.files import read_text


def test_x1_x5_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2013, 1, 5, 18, 30),)], "ts timestamp_ntz")
    r = cal.with_calendar(df, "ts").first()
    assert (r.month, r.day, r.hour, r.year, r.day_of_year, r.week_of_year) == (1, 5, 18, 2013, 5, 1)
    assert r.month_key == "2013-1" and r.month_start == dt.date(2013, 1, 1)


def test_d15_zone_independent(spark):
    df = spark.createDataFrame([(dt.datetime(2012, 9, 30, 23, 30),)], "ts timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        a = df.select(cal.month_key("ts").alias("m"), cal.month_start("ts").alias("s")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert a.m == "2012-9" and a.s == dt.date(2012, 9, 1)


def test_x6_format_number(spark):
    df = spark.createDataFrame([(122676.58302195533,)], "v double")
    assert df.select(cal.formatted_number("v", 2)).first()[0] == "122,676.58"


def test_x7_x10_word_count_keeps_empty_words(spark, out):
    lines = read_text(spark, write_lines(os.path.join(out, "t.txt"), TEXT_LINES))
    counts = word_count(lines)
    assert {r.word: r["count"] for r in counts.collect()} == TEXT_COUNTS
    assert counts.schema.simpleString() == "struct<word:string,count:bigint>"
    ordered = [r["count"] for r in counts.collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_s9_a10_rdd_parity(spark, out):
    path = write_lines(os.path.join(out, "t.txt"), TEXT_LINES)
    rdd = dict(word_count_rdd(spark.sparkContext.textFile(path)).collect())
    assert rdd == TEXT_COUNTS


def test_drop_empty_option(spark):
    lines = spark.createDataFrame([(l,) for l in TEXT_LINES], "value string")
    assert explode_words(lines, drop_empty=True).count() == 4


def test_multiline_cells_split_like_files(spark):
    docs = spark.createDataFrame([("a  b a\n\nb ",)], "text string")
    assert {r.word: r["count"] for r in word_count_of_texts(docs).collect()} == TEXT_COUNTS
    plan = word_count_of_texts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # map-side combine before the shuffle


def test_word_count_order_has_tie_breaker(spark):
    lines = spark.createDataFrame([("c b a b",)], "value string")
    assert [(r.word, r["count"]) for r in word_count(lines).collect()] == [("b", 2), ("a", 1), ("c", 1)]
