from datetime import date

import pytest
from frames import rows
from pyspark.sql import functions as F

from tintero.functions import dates
from tintero.operators import cleaning, date_formats

SCHEMA = "article_id bigint, title string, body string, source string, publish_date string, ingest_seq bigint"
RAW = [
    (1, "a", "b", "s", "2023-01-01", 0),
    (1, "a2", "b2", "s", "2023-01-02", 1),
    (1, "a3", "b3", "s", "2023-02-30", 2),  # last copy has no valid date: the article goes
    (2, None, None, None, "2023-01-05", 3),
    (3, "x", "y", "t", "2023-01-05", 9),
    (3, "older", "y", "t", "2023-01-06", 4),  # smaller sequence, listed later
    (None, "n1", "b", "s", "2023-03-01", 5),
    (None, "n2", "b", "s", "2023-03-02", 6),
]
WANT = [
    (2, "sin titulo", "sin cuerpo", "fuente desconocida", date(2023, 1, 5)),
    (3, "x", "y", "t", date(2023, 1, 5)),
    (None, "n2", "b", "s", date(2023, 3, 2)),
]


@pytest.mark.parametrize("narrow", [True, False])
@pytest.mark.parametrize("parts", [1, 5])
def test_clean_articles(spark, narrow, parts):
    raw = spark.createDataFrame(RAW, SCHEMA).repartition(parts)
    assert rows(cleaning.clean_articles(raw, narrow=narrow).drop("ingest_seq")) == WANT


def test_keep_last_narrow_beyond_its_broadcast_limit(spark):
    raw = spark.createDataFrame(RAW, SCHEMA)
    small = cleaning.keep_last_narrow(raw, "article_id", "ingest_seq", max_broadcast_rows=0)
    assert rows(small) == rows(cleaning.keep_last_narrow(raw, "article_id", "ingest_seq"))


@pytest.mark.parametrize("limit", [0, 1000])
def test_both_forms_agree_on_ties_and_null_orders(spark, limit):
    found = [(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (2, None, "e"), (3, None, "f"), (3, 1, "g"),
             (4, 2, "h"), (4, 2, "h"), (None, 1, "i"), (None, None, "j"), (5, 1, "k")]
    df = spark.createDataFrame(found, "k bigint, seq bigint, text string")
    narrow = rows(cleaning.keep_last_narrow(df, "k", "seq", limit))
    assert narrow == rows(cleaning.keep_last(df.repartition(3, "text"), ["k"], ["seq"]))
    assert [r[0] for r in narrow] == [1, 2, 3, 4, 5, None]
    assert (3, 1, "g") in narrow and (None, 1, "i") in narrow


def test_a_zone_does_not_shift_the_day(spark):
    df = spark.createDataFrame([("2023-01-05T23:30:00-03:00",), ("2023-01-05 00:10:00+14:00",)], "d string")
    got = df.select(dates.lenient_date(F.col("d")).cast("string")).collect()
    assert [r[0] for r in got] == ["2023-01-05"] * 2


def test_date_formats_reach_the_articles(spark):
    raw = spark.createDataFrame([(1, "t", "b", "s", "05/01/2023", 1), (2, "t", "b", "s", "20230106", 2)], SCHEMA)
    got = cleaning.clean_articles(raw, date_formats=("dd/MM/yyyy", "yyyyMMdd"))
    assert sorted(str(r["publish_date"]) for r in got.collect()) == ["2023-01-05", "2023-01-06"]


def test_one_key_holding_most_rows(spark):
    raw = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq")
    )
    want = sorted([(k, k) for k in range(0, 3000, 3)] + [(7, 2999)])
    assert rows(cleaning.keep_last_narrow(raw, "k", "seq").orderBy("k")) == rows(
        spark.createDataFrame(want, "k bigint, seq bigint")
    )
    assert rows(cleaning.keep_last(raw, ["k"], ["seq"])) == rows(
        spark.createDataFrame(want, "k bigint, seq bigint")
    )


@pytest.mark.parametrize(
    "value, want",
    [
        ("2023-01-05", date(2023, 1, 5)),
        ("2023-1-5", date(2023, 1, 5)),
        ("2023-01-05 23:59:00", date(2023, 1, 5)),
        ("2023-01-05T10:00:00", date(2023, 1, 5)),
        ("2023-02-30", None),
        ("2023", None),
        ("nope", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_dates(spark, value, want):
    df = spark.createDataFrame([(value,)], "d string")
    assert df.select(dates.lenient_date(F.col("d"))).first()[0] == want


def test_extra_date_formats(spark):
    df = spark.createDataFrame([("05/01/2023",), ("2023-01-06",), ("?",)], "d string")
    got = [r[0] for r in df.select(dates.lenient_date(F.col("d"), ("dd/MM/yyyy",))).collect()]
    assert got == [date(2023, 1, 5), date(2023, 1, 6), None]


def test_month_and_day_of_keys(spark):
    df = spark.createDataFrame(
        [(20240229, None, None), (20230101, 2022, "12"), (None, None, None), (20230231, 2023, None)],
        "k int, y int, m string",
    )
    got = df.select(
        dates.month_of(F.col("k"), F.col("y"), F.col("m")), dates.month_of(F.col("k")), dates.day_of(F.col("k"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("2024-02", "2024-02", date(2024, 2, 29)),
        ("2022-12", "2023-01", date(2023, 1, 1)),
        (None, None, None),
        ("2023-02", "2023-02", None),
    ]


def test_profile_size_and_head(spark):
    raw = spark.createDataFrame(RAW, SCHEMA)
    assert rows(cleaning.null_profile(raw)) == [(2, 1, 1, 1, 0, 0)]
    assert rows(cleaning.table_size(raw)) == [(8, 6)]
    assert [r["ingest_seq"] for r in cleaning.head(raw, ["ingest_seq"], 2).collect()] == [0, 1]


def test_empty_input_stays_typed(spark):
    empty = cleaning.clean_articles(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and dict(empty.dtypes)["publish_date"] == "date"


def elected(spark, values, **options):
    return date_formats.elect_format(spark.createDataFrame([(v,) for v in values], "d string"), "d", **options)


@pytest.mark.parametrize(
    "values, want",
    [
        (["2023-01-05", "2023-1-6", None], "yyyy-M-d"),
        (["05/01/2023", "25/01/2023", "nope", ""], "d/M/yyyy"),
        (["01/05/2023", "01/25/2023 10:00:00", "x"], "M/d/yyyy"),
        (["01/05/2023", "02/06/2023"], "M/d/yyyy"),  # either order reads both
        (["5.1.2023", "31.12.2022T08:00"], "d.M.yyyy"),
        (["20230105"], "yyyyMMdd"),
        (["Jan 5, 2023", "Dec 31, 2022"], "MMM d, yyyy"),
        (["13/13/2023", "x", None], None),
        ([], None),
    ],
)
def test_elected_format(spark, values, want):
    assert elected(spark, values) == want


def test_scores_count_rows_not_values(spark):
    df = spark.createDataFrame([("05/01/2023",)] * 3 + [("25/01/2023",), ("01/25/2023",), ("01/02/0023",)], "d string")
    scores = {r["format"]: tuple(r)[2:] for r in date_formats.format_scores(df, "d").collect()}
    assert scores["d/M/yyyy"] == (5, 4, 4) and scores["M/d/yyyy"] == (5, 4, 4) and scores["yyyyMMdd"] == (0, 0, 0)


def test_articles_with_day_first_dates(spark):
    found = [(i, "t", "b", "s", f"{i:02d}/02/2023", i) for i in range(1, 29)] + [(90, "t", "b", "s", "sin fecha", 90)]
    raw = spark.createDataFrame(found, SCHEMA)
    got = cleaning.clean_articles(raw, date_formats=None)
    assert sorted((r["article_id"], r["publish_date"]) for r in got.collect()) == [(i, date(2023, 2, i)) for i in range(1, 29)]
    assert cleaning.clean_articles(raw).count() == 0
