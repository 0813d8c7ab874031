"""Job: the four term and volume results over a warehouse."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero import lexicon
from tintero.config import AnalyticsConfig
from tintero.functions import dates
from tintero.operators import series, terms
from tintero.operators.joins import add_names
from tintero.session import materialize, spread_in_order
from tintero.sources import results
from tintero.sources import warehouse as store

#: sort order of each result file
ORDERS: dict[str, list[str | Column]] = {
    "top_terms_monthly": ["year_month", "-count", "term"],
    "regional_word_distribution": ["region_id", "-relative_ratio", "-regional_count", "term"],
    "source_vocabulary_divergence": ["-kl_divergence", "source_id"],
    "daily_peaks": ["date"],
}


def sort_keys(name: str) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDERS[name]]


def base_counts(fact: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Counts by month, region, source and term: the one pass over the text."""
    texts: list[Column] = [F.col("title"), F.col("body")]
    if config.drop_placeholders:
        texts = [
            F.when(F.col(c) != lexicon.PLACEHOLDERS[c], F.col(c)) for c in ("title", "body")
        ]
    when = dates.month_of(F.col("date_id")).alias("year_month")
    return terms.term_counts(fact, [when, "region_id", "source_id"], texts, config.token_rules)


def dealt_for_counts(stored: DataFrame) -> DataFrame:
    """A stored fact in tasks of bounded text that hold few months and sources each, for :func:`base_counts`."""
    order = [dates.month_key(F.col("date_id")), "source_id", "region_id", "article_id"]
    return spread_in_order(stored, order)


def analytics_frames(
    spark: SparkSession, warehouse: str, config: AnalyticsConfig = AnalyticsConfig()
) -> dict[str, DataFrame]:
    """The four results as DataFrames, all derived from one stored count table."""
    fact = store.scan_fact(spark, warehouse)
    base = materialize(base_counts(dealt_for_counts(fact), config), "term-counts")
    regions = store.read_dimension(spark, warehouse, "dim_region", "region_key", "region_name")
    sources = store.read_dimension(spark, warehouse, "dim_source", "source_id", "source_name")
    return frames_of(fact, base, regions, sources, config)


def frames_of(
    fact: DataFrame, base: DataFrame, region_names: DataFrame, source_names: DataFrame, config: AnalyticsConfig
) -> dict[str, DataFrame]:
    """The four results from the stored counts ``base`` and the day keys of ``fact``."""
    monthly = terms.top_terms(terms.recount(base, ["year_month", "term"]), config.top_k)
    vocabulary = materialize(
        terms.frequent_vocabulary(base, config.min_global_count), "vocabulary"
    )
    regional = terms.relative_lift(
        base,
        "region_id",
        config.min_global_count,
        config.min_regional_count,
        None if config.include_unknown_region else config.unknown_region,
        config.region_limit,
        terms.within_vocabulary(base, vocabulary, "region_id"),
    )
    divergence = terms.vocabulary_divergence(
        base,
        "source_id",
        config.min_global_count,
        config.min_source_terms,
        terms.within_vocabulary(base, vocabulary, "source_id"),
    )
    return {
        "top_terms_monthly": monthly,
        "regional_word_distribution": add_names(
            regional, region_names, "region_id", "region_key", "region_name", "region_name", "term"
        ),
        "source_vocabulary_divergence": add_names(
            divergence, source_names, "source_id", "source_id", "source_name", "source_name",
            "source_id",
        ),
        "daily_peaks": series.peaks_of_counts(
            series.counts_of_day_keys(fact),
            config.peak_window,
            config.peak_factor,
            config.peak_min_delta,
        ),
    }


def run_analytics(
    spark: SparkSession, warehouse: str, output: str, config: AnalyticsConfig = AnalyticsConfig()
) -> dict[str, DataFrame]:
    """Write the four results as CSV under ``output`` and return them as read back.

    The results do not depend on each other, so they are submitted together and
    the tail of one leaves no executor idle.
    """
    frames = analytics_frames(spark, warehouse, config)

    def write(name: str) -> tuple[str, DataFrame]:
        path = f"{output}/{name}"
        results.write_result(frames[name], path, sort_keys(name))
        return name, results.read_result(spark, path, results.SCHEMAS[name])

    with ThreadPoolExecutor(len(frames)) as pool:
        return dict(pool.map(write, frames))
