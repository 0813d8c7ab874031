import random
from datetime import date, timedelta

import pytest
from frames import rows

import model
from tintero.operators import series

START = date(2024, 2, 20)


def frame(spark, days, key=None):
    data = [(d, key) for d in days]
    return spark.createDataFrame(data, "day date, k string")


@pytest.mark.parametrize("window, factor, delta", [(7, 1.8, 2.0), (1, 1.0, 0.0), (0, 1.0, 0.0), (100, 1.2, 1.0)])
def test_peaks_against_the_model(spark, window, factor, delta):
    random.seed(window)
    days = [START + timedelta(days=int(random.expovariate(0.2))) for _ in range(120)]
    days += [START + timedelta(days=45)] * 9
    want = model.peaks(days, window, factor, delta)
    found = series.daily_peaks(frame(spark, days), "day", window, factor, delta)
    got = [tuple(r) for r in found.select("date", "article_count", "moving_average", "delta", "is_peak").collect()]
    assert got == want
    assert rows(series.peaks_only(found).select("date")) == sorted((w[0],) for w in want if w[4])


def test_count_equal_to_the_threshold_is_a_peak(spark):
    days = [START] * 10 + [START + timedelta(days=1)] * 18
    got = series.daily_peaks(frame(spark, days), "day", 7, 1.8, 8.0).collect()
    assert [r["is_peak"] for r in got] == [False, True]


def test_no_rows_and_null_days(spark):
    empty = spark.createDataFrame([(None, "a")], "day date, k string")
    assert series.daily_peaks(empty, "day").collect() == []


def test_every_series_has_its_own_calendar(spark):
    random.seed(2)
    a = [START + timedelta(days=random.randrange(9)) for _ in range(30)]
    b = [START + timedelta(days=40 + random.randrange(5)) for _ in range(30)]
    both = frame(spark, a, "a").union(frame(spark, b, "b"))
    got = series.daily_peaks(both, "day", 3, 1.1, 0.5, keys=["k"]).collect()
    for key, days in (("a", a), ("b", b)):
        mine = [tuple(r)[1:] for r in got if r["k"] == key]
        assert mine == model.peaks(days, 3, 1.1, 0.5)


def test_day_keys_are_counted_like_dates(spark):
    keys = spark.createDataFrame([(20240229,), (20240229,), (20240301,), (20230230,), (None,)], "date_id int")
    assert rows(series.counts_of_day_keys(keys)) == [(date(2024, 2, 29), 2), (date(2024, 3, 1), 1)]
