"""Job: add a batch of articles to a warehouse of snapshots, with keys that never change.

Stored source ids stay; names that are new are numbered after the largest of
them.  A batch replaces the stored copies of its articles, as keeping the last
copy over all files at once would, and an article whose new copy has no valid
date goes.  Only months that gain or lose an article are written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero.config import AnalyticsConfig, WarehouseConfig
from tintero.operators import cleaning, dimensions, quality
from tintero.operators.date_formats import elect_format
from tintero.operators.fact import assemble_fact
from tintero.operators.joins import BROADCAST_ROWS, fits_broadcast
from tintero.plans.analytics import base_counts, dealt_for_counts, frames_of
from tintero.plans.warehouse import InvalidWarehouse
from tintero.session import materialize, scratch_path, spread_small
from tintero.sources import snapshots
from tintero.sources.articles import land_articles, read_article_csv
from tintero.sources.snapshots import Month, Snapshot
from tintero.sources.warehouse import FACT, FACT_SCHEMA

_SOURCE_SCHEMA = "source_name string, source_id bigint"
_COUNTS, _COUNTED = "term_counts", "counted_from"
_COUNTS_SCHEMA = "year_month string, region_id int, source_id bigint, term string, count bigint, year int, month string"


def extended_sources(stored: DataFrame, clean: DataFrame) -> DataFrame:
    """``stored`` with the names of ``clean`` that it lacks, numbered after its largest id by first appearance."""
    known = stored.select("source_name")
    new = clean.select("source", "ingest_seq").join(
        F.broadcast(known) if fits_broadcast(known) else known, F.col("source").eqNullSafe(F.col("source_name")), "left_anti"
    )
    numbered = dimensions.source_dimension(new)
    last = stored.agg(F.coalesce(F.max("source_id"), F.lit(0)).alias("_last"))  # one row
    shifted = numbered.join(F.broadcast(last)).select("source_name", (F.col("source_id") + F.col("_last")).alias("source_id"))
    return stored.select("source_name", "source_id").union(shifted)


def extended_calendar(stored: DataFrame | None, clean: DataFrame) -> DataFrame:
    """Every day from the first to the last of the stored calendar and the new articles."""
    days = clean.select("publish_date")
    if stored is not None:
        days = days.union(stored.agg(F.min("full_date")).union(stored.agg(F.max("full_date"))))
    return dimensions.date_dimension(days)


def _without(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` but those whose article is among ``ids(_id)``; a missing id is like any other."""
    side = F.broadcast(ids) if fits_broadcast(ids, 10 * BROADCAST_ROWS) else ids
    return rows.join(side, F.col("article_id").eqNullSafe(F.col("_id")), "left_anti")


def _months(df: DataFrame) -> list[Month]:
    return sorted((r["year"], r["month"]) for r in df.select("year", "month").distinct().collect())  # months, not articles


def append_articles(
    spark: SparkSession,
    articles: str | list[str] | DataFrame,
    warehouse: str,
    config: WarehouseConfig = WarehouseConfig(),
) -> Snapshot:
    """Add a batch and publish the snapshot that has it; the first batch makes the warehouse.

    ``articles`` are CSV paths, or a stored table with the raw columns and
    ``ingest_seq``.  Nothing that a reader can see changes before the last
    step.  With ``fail_on_invalid`` a failed check raises instead of it.  A
    date format is elected for the batch unless the configuration names some.
    """
    before = snapshots.current(spark, warehouse)
    if not isinstance(articles, DataFrame):
        articles = land_articles(read_article_csv(spark, articles, id_type=config.id_type), scratch_path(spark, "landed"))
    formats = config.date_formats
    if formats is None:
        elected = elect_format(articles, "publish_date")
        formats = () if elected is None else (elected,)
    last = cleaning.keep_last_narrow(spread_small(articles, "ingest_seq"), "article_id", "ingest_seq")
    ids = materialize(last.select(F.col("article_id").alias("_id")), "batch-ids")
    clean = cleaning.dated_only(cleaning.fill_missing(last, config.placeholders), formats=formats)

    build, after = snapshots.new_build(), before
    stored = snapshots.read_table(spark, before, "dim_source")
    stored = spark.createDataFrame([], _SOURCE_SCHEMA) if stored is None else stored
    after = snapshots.write_table(extended_sources(stored, clean), after, "dim_source", build)
    calendar = extended_calendar(snapshots.read_table(spark, before, "dim_date"), clean)
    after = snapshots.write_table(calendar, after, "dim_date", build)
    after = snapshots.write_table(dimensions.class_dimension(spark, config.class_names), after, "dim_region", build)
    dims = {name: snapshots.read_table(spark, after, name) for name in ("dim_date", "dim_source", "dim_region")}

    new = assemble_fact(clean, dims["dim_source"], config.aliases, config.unknown_class, config.title_weight)
    old = snapshots.read_months(spark, before, FACT, FACT_SCHEMA)
    replaced = old.select("article_id", "year", "month").join(
        F.broadcast(ids) if fits_broadcast(ids, 10 * BROADCAST_ROWS) else ids, F.col("article_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    added = clean.select(F.year("publish_date").alias("year"), F.date_format("publish_date", "MM").alias("month"))
    touched = sorted({*_months(replaced), *_months(added)})
    kept = _without(snapshots.read_months(spark, before, FACT, FACT_SCHEMA, touched), ids)
    written = snapshots.write_months(kept.select(*new.columns).union(new), after, FACT, build)
    after = after.with_months(FACT, build, written, touched)

    expected = _without(old.select("article_id"), ids).union(clean.select("article_id"))
    report = quality.validation_report(expected, snapshots.read_months(spark, after, FACT, FACT_SCHEMA), dims)
    after = snapshots.write_table(report, after, "validation_report", build)
    if config.fail_on_invalid:
        failed = [r["check"] for r in snapshots.read_table(spark, after, "validation_report").where("not passed").collect()]
        if failed:
            raise InvalidWarehouse(f"{', '.join(sorted(failed))} in build {build} of {warehouse}")
    return snapshots.publish(spark, after)


def counts_folder(warehouse: str, config: AnalyticsConfig) -> str:
    """Counts under other rules are other counts, so each set of rules has its own folder."""
    rules = config.token_rules
    told = (rules.min_length, rules.max_length, rules.reject_two_letter_words, sorted(rules.stop_words), config.drop_placeholders)
    return f"{warehouse}/_counts-{snapshots.digest(repr(told))}"


def month_counts(
    spark: SparkSession, warehouse: str, snapshot: Snapshot, config: AnalyticsConfig = AnalyticsConfig()
) -> DataFrame:
    """Counts by month, region, source and term, of which only those of changed months are made anew.

    Each month is stored with the build of the fact that it was counted from.
    Counts of different months add up, so every result can be derived from them.
    """
    root = counts_folder(warehouse, config)
    stored = snapshots.current(spark, root)
    facts, counted = snapshot.months.get(FACT, {}), stored.months.get(_COUNTED, {})
    stale = [m for m, build in facts.items() if counted.get(m) != build]
    gone = [m for m in counted if m not in facts]
    if stale or gone:
        build = snapshots.new_build()
        fact = snapshots.read_months(spark, snapshot, FACT, FACT_SCHEMA, stale)
        counts = base_counts(dealt_for_counts(fact), config)
        year_month = F.col("year_month")
        counts = counts.withColumns({"year": F.substring(year_month, 1, 4).cast("int"), "month": F.substring(year_month, 6, 2)})
        written = snapshots.write_months(counts, stored, _COUNTS, build)
        stored = stored.with_months(_COUNTS, build, written, [*stale, *gone]).with_builds(_COUNTED, dict(facts))
        stored = snapshots.publish(spark, stored)
    return snapshots.read_months(spark, stored, _COUNTS, _COUNTS_SCHEMA).drop("year", "month")


def analytics_of_snapshot(
    spark: SparkSession, warehouse: str, config: AnalyticsConfig = AnalyticsConfig()
) -> dict[str, DataFrame]:
    """The four results over the newest snapshot, which is looked up once."""
    snapshot = snapshots.current(spark, warehouse)
    fact = snapshots.read_months(spark, snapshot, FACT, FACT_SCHEMA)
    base = month_counts(spark, warehouse, snapshot, config)
    regions = snapshots.read_table(spark, snapshot, "dim_region")
    sources = snapshots.read_table(spark, snapshot, "dim_source")
    return frames_of(fact, base, regions, sources, config)
