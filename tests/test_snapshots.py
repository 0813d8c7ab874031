"""Batches, snapshots and month-wise counts against a single build."""

import random
from datetime import date, timedelta

import pytest
from frames import rows

from pyspark.sql import functions as F

from tintero import lexicon
from tintero.config import AnalyticsConfig, WarehouseConfig
from tintero.plans import incremental
from tintero.plans.analytics import analytics_frames
from tintero.plans.warehouse import InvalidWarehouse, build_warehouse
from tintero.session import materialize, scratch_path
from tintero.sources import snapshots, warehouse
from tintero.sources.snapshots import Snapshot

SCHEMA = "article_id bigint, title string, body string, source string, publish_date string, ingest_seq bigint"
CONFIG = AnalyticsConfig(
    top_k=5, min_global_count=4, min_regional_count=1, min_source_terms=10, peak_window=3, peak_factor=1.2, peak_min_delta=1.0
)


def some_articles(seed, ids, seq, months):
    rng = random.Random(seed)
    places = [a for names in lexicon.REGION_ALIASES.values() for a in names]
    words = "gobierno presidente economía fútbol ciudad educación salud trabajo región".split()
    out = []
    for i, article in enumerate(ids):
        day = date(2023, rng.choice(months), 1) + timedelta(days=rng.randrange(28))
        out.append((
            article, rng.choice([None, " ".join(rng.choices(words + places, k=4))]), " ".join(rng.choices(words + places, k=20)),
            rng.choice([None, "emol", "emol", f"raro{rng.randrange(seed * 3)}"]), rng.choice([day.isoformat()] * 9 + ["sin fecha"]), seq + i,
        ))
    return out


@pytest.fixture(scope="module")
def batches():
    return [
        some_articles(3, [*range(120), None], 0, [1, 2, 3]),
        some_articles(5, [*range(100, 160), None, 5, 5], 1000, [3, 4]),
        some_articles(7, [7, 8], 2000, [1]),
    ]


def stored(spark, batch):
    return materialize(spark.createDataFrame(batch, SCHEMA), "batch")


def named(fact, sources):
    return rows(fact.join(sources, "source_id", "left").drop("source_id"))


@pytest.fixture(scope="module")
def appended(spark, batches):
    path = scratch_path(spark, "appended")
    versions = [incremental.append_articles(spark, stored(spark, b), path, WarehouseConfig(fail_on_invalid=True)) for b in batches]
    return path, versions


def read_fact(spark, snapshot):
    return snapshots.read_months(spark, snapshot, warehouse.FACT, warehouse.FACT_SCHEMA)


def test_batches_give_the_fact_of_one_build(spark, batches, appended):
    path, versions = appended
    whole = scratch_path(spark, "whole")
    build_warehouse(spark, stored(spark, [r for b in batches for r in b]), whole)
    want = named(warehouse.scan_fact(spark, whole), spark.read.parquet(f"{whole}/dim_source"))
    snapshot = snapshots.current(spark, path)
    assert snapshot == versions[-1] and snapshot.number == 3
    assert named(read_fact(spark, snapshot), snapshots.read_table(spark, snapshot, "dim_source")) == want
    days = [rows(d.select("full_date")) for d in (snapshots.read_table(spark, snapshot, "dim_date"), spark.read.parquet(f"{whole}/dim_date"))]
    assert set(days[1]) <= set(days[0])
    assert snapshots.read_table(spark, snapshot, "validation_report").where("not passed").isEmpty()


def test_ids_stay_and_untouched_months_are_not_written_again(spark, appended):
    path, versions = appended
    ids = [dict(rows(snapshots.read_table(spark, v, "dim_source").select("source_name", "source_id"))) for v in versions]
    assert all(ids[1][name] == i for name, i in ids[0].items()) and len(ids[1]) > len(ids[0])
    assert sorted(ids[2].values()) == list(range(1, len(ids[2]) + 1))
    months = [v.months[warehouse.FACT] for v in versions]
    assert (2023, "04") in months[1] and months[2][2023, "04"] == months[1][2023, "04"]
    assert months[2][2023, "01"] != months[1][2023, "01"]


def test_earlier_snapshots_stay_readable(spark, batches, appended):
    path, versions = appended
    first = snapshots.at(spark, path, 1)
    assert first == versions[0]
    alone = scratch_path(spark, "alone")
    incremental.append_articles(spark, stored(spark, batches[0]), alone)
    assert rows(read_fact(spark, first)) == rows(read_fact(spark, snapshots.current(spark, alone)))


@pytest.mark.parametrize("broken", ["write_table", "write_months", "publish"])
@pytest.mark.parametrize("late", [False, True])
def test_a_build_that_breaks_off_changes_nothing(spark, batches, monkeypatch, broken, late):
    path = scratch_path(spark, "broken")
    before = incremental.append_articles(spark, stored(spark, batches[0]), path)
    want = rows(read_fact(spark, before))
    original = getattr(snapshots, broken)

    def breaking(*args):
        if late and broken != "publish":
            original(*args)
        raise OSError("lost")

    monkeypatch.setattr(snapshots, broken, breaking)
    with pytest.raises(OSError, match="lost"):
        incremental.append_articles(spark, stored(spark, batches[1]), path)
    monkeypatch.undo()
    assert snapshots.current(spark, path) == before
    assert rows(read_fact(spark, snapshots.current(spark, path))) == want
    again = incremental.append_articles(spark, stored(spark, batches[1]), path)
    assert again.number == 2 and read_fact(spark, again).groupBy("article_id").count().where("count > 1").isEmpty()


def test_two_writers_do_not_overwrite_each_other(spark):
    root = scratch_path(spark, "race")
    mine, theirs = Snapshot(root).with_table("a", "x"), Snapshot(root).with_table("a", "y")
    snapshots.publish(spark, mine)
    with pytest.raises(snapshots.PublishConflict):
        snapshots.publish(spark, theirs)
    assert snapshots.current(spark, root).tables == {"a": "x"}


def test_an_invalid_batch_is_not_published(spark, batches):
    path = scratch_path(spark, "invalid")
    config = WarehouseConfig(class_names=["solo"], fail_on_invalid=True)  # class 17 has no row
    with pytest.raises(InvalidWarehouse, match="referential_integrity"):
        incremental.append_articles(spark, stored(spark, batches[0]), path, config)
    assert snapshots.current(spark, path).number == 0


def test_an_article_whose_new_copy_has_no_date_goes(spark):
    path = scratch_path(spark, "undated")
    first = [(1, "a", "b", "s", "2023-01-01", 0), (2, "a", "b", "s", "2023-02-01", 1)]
    incremental.append_articles(spark, stored(spark, first), path)
    snapshot = incremental.append_articles(spark, stored(spark, [(2, "a", "b", "s", "nope", 2)]), path)
    assert [r["article_id"] for r in read_fact(spark, snapshot).collect()] == [1]
    assert list(snapshot.months[warehouse.FACT]) == [(2023, "01")]
    snapshot = incremental.append_articles(spark, spark.createDataFrame([], SCHEMA), path)
    assert [r["article_id"] for r in read_fact(spark, snapshot).collect()] == [1]


def test_counts_of_unchanged_months_are_read_not_made(spark, batches, monkeypatch):
    path = scratch_path(spark, "counted")
    texts = []
    original = incremental.base_counts

    def watched(fact, config):
        texts.append({(r["year"], r["month"]) for r in fact.select("year", "month").distinct().collect()})
        return original(fact, config)

    monkeypatch.setattr(incremental, "base_counts", watched)
    for batch in batches:
        snapshot = incremental.append_articles(spark, stored(spark, batch), path)
        counts = incremental.month_counts(spark, path, snapshot, CONFIG)
        whole = original(read_fact(spark, snapshot), CONFIG)
        columns = ["year_month", "region_id", "source_id", "term", "count"]
        assert rows(counts.select(columns)) == rows(whole.select(columns))
    every = {(2023, f"{m:02d}") for m in range(1, 5)}
    assert texts[0] == {(2023, "01"), (2023, "02"), (2023, "03")}
    assert texts[1] >= {(2023, "04")} and (2023, "04") not in texts[2] and texts[2] < every
    incremental.month_counts(spark, path, snapshot, CONFIG)
    assert len(texts) == 3
    incremental.month_counts(spark, path, snapshot, AnalyticsConfig(drop_placeholders=True))
    assert texts[3] == every


def test_results_from_month_counts(spark, batches, appended):
    path, _ = appended
    whole = scratch_path(spark, "whole")
    build_warehouse(spark, stored(spark, [r for b in batches for r in b]), whole)
    want, got = analytics_frames(spark, whole, CONFIG), incremental.analytics_of_snapshot(spark, path, CONFIG)
    for name in ("top_terms_monthly", "daily_peaks", "regional_word_distribution"):
        assert rows(got[name]) == rows(want[name])
    columns = ["source_name", "total_terms", "vocabulary_size", F.round("kl_divergence", 9)]
    assert rows(got["source_vocabulary_divergence"].select(columns)) == rows(want["source_vocabulary_divergence"].select(columns))
