"""Tables behind the charts of a report, from the four analytics results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintero.functions.text import slug
from tintero.operators.terms import top_per_group


def global_terms(monthly: DataFrame, n: int) -> DataFrame:
    """Counts of each term summed over the months in which it ranked."""
    totals = monthly.groupBy("term").agg(F.sum("count").cast("long").alias("total"))
    return totals.orderBy(F.desc("total"), "term").limit(n)


def leading_terms(monthly: DataFrame) -> DataFrame:
    """The most frequent term of each month, in order of time."""
    first = top_per_group(monthly, ["year_month"], [F.desc("count"), F.asc("term")], 1)
    return first.orderBy("year_month")


def divergent_sources(divergence: DataFrame, n: int) -> DataFrame:
    order = [F.desc("kl_divergence"), F.asc("source_id")]
    return divergence.orderBy(*order).limit(n).select("source_name", "kl_divergence")


def distinctive_terms(regional: DataFrame, regions: Sequence[str], n: int) -> DataFrame:
    """Terms of the chosen regions, by regional count rather than by ratio."""
    chosen = regional.where(F.col("region_name").isin(list(regions)))
    order = [F.desc("regional_count"), F.desc("relative_ratio"), F.asc("term")]
    top = top_per_group(chosen, ["region_name"], order, n)
    return (
        top.withColumn("region_slug", slug(F.col("region_name")))
        .select("region_name", "region_slug", "term", "relative_ratio", "regional_count")
        .orderBy("region_name", *order)
    )
