import random
from datetime import date

import pytest
from frames import rows

from tintero import lexicon
from tintero.operators import dimensions, fact, joins


def test_date_dimension(spark):
    df = spark.createDataFrame([(date(2024, 2, 28),), (date(2024, 3, 1),)], "publish_date date")
    got = [tuple(r) for r in dimensions.date_dimension(df).orderBy("full_date").collect()]
    assert got == [
        (date(2024, 2, 28), 20240228, 2024, "02", 28, "Wednesday"),
        (date(2024, 2, 29), 20240229, 2024, "02", 29, "Thursday"),
        (date(2024, 3, 1), 20240301, 2024, "03", 1, "Friday"),
    ]


@pytest.mark.parametrize("limit, salted", [(100, False), (1, True)])
def test_date_attributes_by_counted_calendar(spark, limit, salted):
    days = [date(2024, 2, 28), date(2024, 3, 1), date(2024, 3, 1), date(2023, 1, 1), None]
    df = spark.createDataFrame(list(enumerate(days)), "article_id int, publish_date date")
    calendar = dimensions.date_dimension(df.where("year(publish_date) = 2024")).select("full_date", "date_id")
    found = fact.add_date_attributes(df, calendar, max_broadcast_rows=limit)
    assert found.columns == ["article_id", "publish_date", "date_id"]
    assert ("_salt" in found._jdf.queryExecution().optimizedPlan().toString()) == salted
    keys = [20240228, 20240301, 20240301, None, None]
    assert rows(found) == rows(spark.createDataFrame([(i, d, k) for (i, d), k in zip(enumerate(days), keys)],
                                                     "article_id int, publish_date date, date_id int"))


def test_empty_date_dimension(spark):
    empty = spark.createDataFrame([], "publish_date date")
    assert dimensions.date_dimension(empty).collect() == []


@pytest.mark.parametrize("single", [0, 100_000])
def test_numbering_follows_first_appearance(spark, single):
    random.seed(3)
    pairs = [(random.randrange(500), seq) for seq in range(2000)]
    want = {}
    for key, _ in pairs:
        want.setdefault(key, len(want) + 1)
    random.shuffle(pairs)
    df = spark.createDataFrame(pairs, "k bigint, seq bigint").repartition(7)
    got = dimensions.numbered_by_first_seen(df, "k", "seq", "key", "id", single_task_keys=single)
    assert {r["key"]: r["id"] for r in got.collect()} == want


@pytest.mark.parametrize("single", [0, 100_000])
def test_numbering_of_equal_first_values_and_of_nothing(spark, single):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "k string, seq bigint")
    number = dimensions.numbered_by_first_seen
    assert rows(number(df, "k", "seq", "key", "id", single)) == [("a", 2), ("b", 3), ("c", 1)]
    assert number(df.where("false"), "k", "seq", "key", "id", max(single, 1)).collect() == []


def test_class_dimension(spark):
    got = dimensions.class_dimension(spark, lexicon.REGION_NAMES).collect()
    assert len(got) == 17 and tuple(got[16]) == (17, "Desconocida")


@pytest.mark.parametrize("limit", [0, 100])
def test_lookup_keeps_every_row_and_names_unknown_keys(spark, limit):
    df = spark.createDataFrame([(i, i % 3) for i in range(60)] + [(60, None)], "row int, k int")
    names = spark.createDataFrame([(0, "zero"), (1, None)], "k int, name string")
    named = joins.add_names(df, names, "k", "k", "name", "label", "row", max_broadcast_rows=limit)
    assert named.columns == ["row", "k", "label"]
    got = {r["row"]: r["label"] for r in named.collect()}
    assert len(got) == 61
    assert (got[0], got[1], got[2], got[60]) == ("zero", "id_1", "id_2", None)
