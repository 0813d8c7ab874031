"""Daily volume: dense series, moving averages, peaks.

Windows run over one row per calendar day and series, never over articles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintero.functions.dates import day_of
from tintero.operators.dimensions import calendar_days


def daily_counts(df: DataFrame, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per day; rows without a day are ignored."""
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(*keys, F.col(day).alias("date"))
        .agg(F.count("*").alias("article_count"))
    )


def dense_daily_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every day from first to last, zero where nothing was counted."""
    spine = calendar_days(counts, "date", keys, out="date")
    return spine.join(counts, [*keys, "date"], "left").select(
        *keys, "date", F.coalesce("article_count", F.lit(0)).alias("article_count")
    )


def moving_average(dense: DataFrame, window: int, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the up to ``window`` days before each day, 0 where there are none."""
    if window < 1:
        return dense.withColumn("moving_average", F.lit(0.0))
    before = Window.partitionBy(*keys).orderBy("date").rowsBetween(-window, -1)
    return dense.withColumn(
        "moving_average", F.coalesce(F.avg("article_count").over(before), F.lit(0.0))
    )


def flag_peaks(averaged: DataFrame, factor: float, min_delta: float) -> DataFrame:
    count, mean = F.col("article_count"), F.col("moving_average")
    peak = (mean > 0) & (count >= mean * factor) & (count - mean >= min_delta)
    return averaged.withColumns({"delta": count - mean, "is_peak": peak})


def peaks_of_counts(
    counts: DataFrame, window: int, factor: float, min_delta: float, keys: Sequence[str] = ()
) -> DataFrame:
    """:func:`daily_peaks` from ``(keys..., date, article_count)``."""
    dense = dense_daily_counts(counts, keys)
    return flag_peaks(moving_average(dense, window, keys), factor, min_delta).orderBy(*keys, "date")


def daily_peaks(
    df: DataFrame,
    day: str,
    window: int = 7,
    factor: float = 1.8,
    min_delta: float = 50.0,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``(keys..., date, article_count, moving_average, delta, is_peak)`` for every calendar day."""
    return peaks_of_counts(daily_counts(df, day, keys), window, factor, min_delta, keys)


def counts_of_day_keys(df: DataFrame, date_id: str = "date_id") -> DataFrame:
    """:func:`daily_counts` of integer day keys, which become dates only after counting."""
    per_key = df.groupBy(date_id).agg(F.count("*").alias("article_count"))
    days = per_key.select(day_of(F.col(date_id)).alias("date"), "article_count")
    return days.where("date is not null")


def peaks_only(series: DataFrame) -> DataFrame:
    return series.where("is_peak")
