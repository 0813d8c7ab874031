"""Cleaning of raw articles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintero import lexicon
from tintero.functions import dates
from tintero.operators.date_formats import elect_format
from tintero.operators.joins import fits_broadcast
from tintero.session import materialize


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order``; null keys form one group.

    A null order comes first.  Of rows that tie, a hash of the whole row decides,
    so the result doesn't depend on the layout.  ``row_number() = 1`` is pruned
    before the shuffle as well (WindowGroupLimit), so however many rows share a
    key, a map task passes on only one of them.
    """
    last_first = [*[F.col(c).desc_nulls_last() for c in order], F.xxhash64(*df.columns).desc()]
    window = Window.partitionBy(*keys).orderBy(*last_first)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def keep_last_narrow(
    df: DataFrame, key: str, order: str, max_broadcast_rows: int = 1_000_000
) -> DataFrame:
    """:func:`keep_last` for wide rows with few repeated keys, without shuffling the rows.

    A narrow aggregate finds the repeated keys, their last place and how many
    rows tie for it, and stores them.  If they are few (counted) and nothing
    ties, they are broadcast and older copies are dropped where they are read;
    otherwise the window form is used.  Both give the same rows.  ``df`` should
    be a stored table.
    """
    places = df.groupBy(F.col(key).alias("_key"), F.col(order).alias("_order")).agg(F.count("*").alias("_ties"))
    repeated = materialize(
        places.groupBy("_key")
        .agg(F.max_by(F.struct("_order", "_ties"), F.struct(F.col("_order"))).alias("_at"), F.sum("_ties").alias("_n"))
        .where("_n > 1")
        .select("_key", F.col("_at._order").alias("_last"), F.col("_at._ties").alias("_ties")),
        "repeated-keys",
    )
    if not fits_broadcast(repeated, max_broadcast_rows) or not repeated.where("_ties > 1").isEmpty():
        return keep_last(df, [key], [order])
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    is_last = F.col(order).eqNullSafe(F.col("_last"))
    return df.join(F.broadcast(repeated.drop("_ties")), same_key & ~is_last, "left_anti")


def fill_missing(df: DataFrame, placeholders: Mapping[str, str] = lexicon.PLACEHOLDERS) -> DataFrame:
    return df.fillna({c: v for c, v in placeholders.items() if c in df.columns})


def dated_only(df: DataFrame, column: str = "publish_date", formats: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``column`` to a date and drop the rows where that fails."""
    return df.withColumn(column, dates.lenient_date(F.col(column), formats)).where(
        F.col(column).isNotNull()
    )


def clean_articles(
    raw: DataFrame,
    key: str = "article_id",
    order: str = "ingest_seq",
    placeholders: Mapping[str, str] = lexicon.PLACEHOLDERS,
    narrow: bool = True,
    date_formats: tuple[str, ...] | None = (),
) -> DataFrame:
    """Keep the last copy of each article, fill gaps, keep dated articles.

    The order is part of the contract: an article whose last copy has no valid
    date disappears even if an earlier copy had one.  With ``date_formats``
    None the format is elected from all dates of ``raw``, copies included.
    """
    if date_formats is None:
        elected = elect_format(raw, "publish_date")
        date_formats = () if elected is None else (elected,)
    last = keep_last_narrow(raw, key, order) if narrow else keep_last(raw, [key], [order])
    return dated_only(fill_missing(last, placeholders), formats=date_formats)


def null_profile(df: DataFrame) -> DataFrame:
    """Number of nulls per column, as one row, in one pass."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def table_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def head(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
