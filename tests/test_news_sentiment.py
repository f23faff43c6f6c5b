"""News cleaning, CSV round trips, tie-aware daily modes and the scoring job."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from finlake.operators.modes import group_mode
from finlake.plans import news
from finlake.plans.sentiment import lexicon_scorer, score_text
from finlake.sinks.writers import write_csv
from finlake.sources.text import read_news_csv

from .conftest import rows

D = dt.date


def test_clean_source_dates_symbols_and_bounds(spark):
    raw = spark.createDataFrame([
        ("2023-12-16 23:00:00 UTC", "t1", "AAA"),
        ("2020-06-05 23:30:00-04:00", "t2", "AAA"),   # offset ignored, no day shift
        ("not a date", "t3", "AAA"),                  # malformed -> NULL -> dropped
        ("2008-12-31 10:00:00 UTC", "t4", "AAA"),     # before the lower bound
        ("2021-01-01 10:00:00 UTC", "t5", "ZZZ"),     # symbol not in the list
    ], "Date string, Article_title string, Stock_symbol string")
    got = rows(news.clean_source_a(raw, ["AAA"], "2009-01-01"))
    assert got == [(D(2020, 6, 5), "AAA", "t2"), (D(2023, 12, 16), "AAA", "t1")]


def test_union_keeps_both_sources_sorted(spark):
    a = spark.createDataFrame([(D(2020, 1, 2), "B", "x"), (D(2020, 1, 1), "A", "y")],
                              "date date, symbol string, title string")
    b = spark.createDataFrame([(D(2020, 1, 3), "A", "z"), (D(2020, 1, 1), "A", "y")],
                              "date date, symbol string, title string")
    got = [tuple(r) for r in news.combine(a, b).collect()]
    assert got == [(D(2020, 1, 3), "A", "z"), (D(2020, 1, 1), "A", "y"),
                   (D(2020, 1, 1), "A", "y"), (D(2020, 1, 2), "B", "x")]


def test_csv_round_trip_quotes_and_newlines(spark, scratch):
    titles = ['A "quoted", title', "two\nlines", "plain"]
    df = spark.createDataFrame([(D(2020, 1, i + 1), "AAA", t) for i, t in enumerate(titles)],
                               "date date, symbol string, title string")
    path = os.path.join(scratch, "news_csv")
    write_csv(df, path)
    back = read_news_csv(spark, path, "date date, symbol string, title string")
    assert sorted(r.title for r in back.collect()) == sorted(titles)


def test_utf16_csv(spark, scratch):
    path = os.path.join(scratch, "stocks.csv")
    with open(path, "w", encoding="utf-16") as fh:
        fh.write("Date,Ticker,Close\n2020-01-02,AAA,1.5\n2020-01-03,AAA,2.5\n")
    back = read_news_csv(spark, path, "Date date, Ticker string, Close double", encoding="UTF-16")
    assert rows(back) == [(D(2020, 1, 2), "AAA", 1.5), (D(2020, 1, 3), "AAA", 2.5)]


def test_daily_dense_fills_zero(spark):
    counts = spark.createDataFrame([("A", D(2020, 1, 1), 2), ("A", D(2020, 1, 4), 1),
                                    ("B", D(2020, 1, 2), 5)], "symbol string, date date, count long")
    got = rows(news.dense_daily(counts))
    assert len(got) == 8
    assert ("A", D(2020, 1, 2), 0) in got and ("B", D(2020, 1, 2), 5) in got
    fixed = news.dense_daily(counts, "2019-12-31", "2020-01-01")
    assert rows(fixed) == [("A", D(2019, 12, 31), 0), ("A", D(2020, 1, 1), 2),
                           ("B", D(2019, 12, 31), 0), ("B", D(2020, 1, 1), 0)]


@pytest.mark.parametrize("labels,want", [
    (["negative", "neutral", "positive"], "neutral"),
    (["negative", "neutral"], "negative"),
    (["negative", "positive"], "neutral"),
    (["neutral", "positive"], "positive"),
    (["positive", "positive", "negative"], "positive"),
    ([None], "neutral"),
])
def test_tie_rule(spark, labels, want):
    df = spark.createDataFrame([("k", x) for x in labels], "k string, s string")
    assert group_mode(df, ["k"], "s").collect()[0]["mode"] == want


def test_scoring_job_uses_factory_once_per_task_and_batches(spark):

    def factory():
        base = lexicon_scorer()

        def score(texts):
            assert len(texts) <= 3
            return base(texts)
        return score

    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["strong profit growth", "weak loss", "flat", None] * 5)],
        "id long, title string").repartition(3)
    out = score_text(df, scorer_factory=factory, batch_size=3)
    got = {r.id % 4: r.sentiment for r in out.collect()}
    assert got == {0: "positive", 1: "negative", 2: "neutral", 3: "neutral"}
    assert out.count() == 20


def test_news_and_scoring_jobs_end_to_end(spark, scratch):
    a = os.path.join(scratch, "a.csv")
    b = os.path.join(scratch, "b.csv")
    with open(a, "w") as fh:
        fh.write("Unnamed: 0,Date,Article_title,Stock_symbol,Url,Publisher,Author,Article,"
                 "Lsa_summary,Luhn_summary,Textrank_summary,Lexrank_summary\n")
        fh.write('0,2023-12-16 23:00:00 UTC,"Strong profit, ""record"" growth",AAA,u,p,a,x,,,,\n')
        fh.write("1,2008-01-01 10:00:00 UTC,old,AAA,u,p,a,x,,,,\n")
        fh.write('2,2023-12-15 10:00:00 UTC,"weak\nloss",BBB,u,p,a,x,,,,\n')
    with open(b, "w") as fh:
        fh.write(",title,date,stock\n")
        fh.write("0,flat day,2020-06-05 23:30:00-04:00,AAA\n")
        fh.write("1,unknown,2020-06-05 10:00:00-04:00,ZZZ\n")
    clean = news.extract_news(spark, a, b, ["AAA", "BBB"], os.path.join(scratch, "clean"))
    got = [tuple(r) for r in clean.orderBy(F.col("symbol"), F.col("date").desc()).collect()]
    assert got == [(D(2023, 12, 16), "AAA", 'Strong profit, "record" growth'),
                   (D(2020, 6, 5), "AAA", "flat day"), (D(2023, 12, 15), "BBB", "weak\nloss")]
    from finlake.plans.sentiment import score_news_file

    scored = score_news_file(spark, os.path.join(scratch, "clean"), os.path.join(scratch, "scored"))
    assert {r.title: r.sentiment for r in scored.collect()} == {
        'Strong profit, "record" growth': "positive", "flat day": "neutral",
        "weak\nloss": "negative"}


def test_daily_dense_for_a_company_list(spark):
    counts = spark.createDataFrame([("A", D(2020, 1, 1), 2)], "symbol string, date date, count long")
    companies = spark.createDataFrame([("A",), ("Z",)], "Symbol string")
    got = rows(news.dense_daily(counts, "2020-01-01", "2020-01-02", symbols=companies))
    assert got == [("A", D(2020, 1, 1), 2), ("A", D(2020, 1, 2), 0),
                   ("Z", D(2020, 1, 1), 0), ("Z", D(2020, 1, 2), 0)]


def test_word_list_expression_equals_the_scorer(spark):
    texts = ["Strong PROFIT, loss", "up down", None, "", "Record-high growth", "weak weak up", "éloss gain's"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, title string")
    want = lexicon_scorer()(texts)
    got = [r.sentiment for r in score_text(df).orderBy("id").collect()]
    assert got == want


def test_mode_counts_labels_of_any_name(spark):
    df = spark.createDataFrame([(1, "Positive"), (1, "Positive"), (1, "negative"), (2, "b"), (2, "a"), (3, None)],
                               "g long, s string")
    got = {r.g: r["mode"] for r in group_mode(df, ["g"], "s").collect()}
    assert got == {1: "Positive", 2: "a", 3: "neutral"}
