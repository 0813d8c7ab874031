"""Dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tintero.functions import dates
from tintero.session import materialize

#: up to this many keys one sorted task numbers them (a few MB)
SINGLE_TASK_KEYS = 100_000
_BUCKETS = 200


def date_range(df: DataFrame, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """First and last day, per series if ``keys`` are given; no row for an empty input."""
    ends = df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return ends.where("first_day is not null")


def calendar_days(df: DataFrame, day: str, keys: Sequence[str] = (), out: str = "full_date") -> DataFrame:
    """Every day from first to last, per series if ``keys`` are given."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return date_range(df, day, keys).select(*keys, F.explode(days).alias(out))


def date_dimension(df: DataFrame, day: str = "publish_date") -> DataFrame:
    columns = [c.alias(name) for name, c in dates.calendar(F.col("full_date")).items()]
    return calendar_days(df, day).select("full_date", *columns)


def numbered_by_first_seen(
    df: DataFrame,
    key: str,
    order: str,
    key_out: str,
    id_out: str,
    single_task_keys: int = SINGLE_TASK_KEYS,
) -> DataFrame:
    """Distinct keys, numbered from 1 in order of first appearance.

    Rows are reduced to one per key, and stored, before anything is ordered.  A
    small key set (counted) is numbered by one window.  A larger one is cut into ranges of its
    first-seen values; each range is numbered on its own and shifted by the
    number of keys in the ranges before it.  ``order`` should be nearly unique, as
    keys first seen at the same value stay in one range.
    """
    keys = materialize(
        df.groupBy(F.col(key).alias(key_out)).agg(F.min(order).alias("_first")), "first-seen"
    )
    marks = [i / _BUCKETS for i in range(1, _BUCKETS)]
    stats = keys.agg(
        F.count("*").alias("n"), F.percentile_approx("_first", marks, 10_000).alias("bounds")
    ).first()
    if stats["n"] <= single_task_keys:
        window = Window.orderBy("_first", key_out)
        return keys.select(key_out, F.row_number().over(window).cast("long").alias(id_out))

    # The bounds are literals from here on, so every use cuts the keys alike.
    bounds = F.lit(sorted(set(stats["bounds"])))
    bucketed = keys.withColumn("_bucket", F.size(F.filter(bounds, lambda b: b <= F.col("_first"))))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(  # at most _BUCKETS rows
        F.col("_bucket").alias("_b"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("_bucket").orderBy("_first", key_out)
    position = F.row_number().over(within) + F.col("_offset")
    return bucketed.join(F.broadcast(offsets), F.col("_bucket") == F.col("_b")).select(
        key_out, position.cast("long").alias(id_out)
    )


def source_dimension(
    df: DataFrame, source: str = "source", order: str = "ingest_seq", **options: int
) -> DataFrame:
    return numbered_by_first_seen(df, source, order, "source_name", "source_id", **options)


def class_dimension(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """A constant dimension, keys counted from 1."""
    rows = list(enumerate(names, start=1))
    return spark.createDataFrame(rows, "region_key int, region_name string")
