"""Assembly of the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintero.functions import dates, text
from tintero.operators.classify import vote
from tintero.operators.joins import BROADCAST_ROWS, lookup

FACT_COLUMNS = (
    "article_id", "title", "body", "word_count_title", "word_count_body",
    "date_id", "source_id", "region_id", "year", "month",
)


def assemble_fact(
    clean: DataFrame,
    dim_source: DataFrame,
    aliases: Mapping[int, Sequence[str]],
    unknown: int,
    title_weight: int = 3,
) -> DataFrame:
    """Cleaned articles with word counts, class, and dimension keys.

    The day key and month are computed from the date instead of joined; the
    validations compare them with the date dimension.
    """
    folded = text.with_folded(clean, {"title_clean": F.col("title"), "body_clean": F.col("body")})
    counted = vote(folded, aliases, unknown, title_weight=title_weight).withColumns(
        {
            "word_count_title": text.word_count(F.col("title_clean")),
            "word_count_body": text.word_count(F.col("body_clean")),
            "date_id": dates.day_key(F.col("publish_date")),
            "year": F.year("publish_date"),
            "month": dates.month_text(F.col("publish_date")),
        }
    )
    keyed = lookup(counted, dim_source, "source", "source_name", spread_by="article_id")
    return keyed.select(*FACT_COLUMNS)


def add_date_attributes(
    df: DataFrame,
    dim_date: DataFrame,
    day: str = "publish_date",
    spread_by: str = "article_id",
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join with the date dimension, for callers whose calendar holds more than the date does.

    The calendar is broadcast after its days have been counted; one beyond the
    limit is joined by (day, salt), so a busy day is spread over tasks.
    """
    return lookup(df, dim_date, day, "full_date", spread_by, max_broadcast_rows)
