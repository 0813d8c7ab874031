"""Lookups against dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a (key, name) dimension of this many rows is a few tens of MB
BROADCAST_ROWS = 500_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than needed to tell."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    key: str,
    dimension_key: str,
    spread_by: str,
    max_broadcast_rows: int = BROADCAST_ROWS,
    salts: int = 32,
) -> DataFrame:
    """Left join with a dimension whose key is unique; unmatched rows get nulls.

    The dimension is broadcast after its row count has been checked.  A larger
    one is joined by shuffle on (key, salt): every row picks a salt from its
    ``spread_by`` value and the dimension is repeated per salt, so a key that
    holds a large share of ``df`` is spread over many tasks.
    """
    right = dimension.withColumnRenamed(dimension_key, "_key")
    if fits_broadcast(dimension, max_broadcast_rows):
        return df.join(F.broadcast(right), df[key] == right["_key"], "left").drop("_key")
    left = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = right.withColumn("_right_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = (left[key] == right["_key"]) & (left["_salt"] == right["_right_salt"])
    return left.join(right, same, "left").drop("_key", "_salt", "_right_salt")


def add_names(
    df: DataFrame,
    names: DataFrame,
    key: str,
    names_key: str,
    names_value: str,
    out: str,
    spread_by: str,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Insert the name of ``key`` right after it; a key without a name becomes ``id_<key>``."""
    slim = names.select(F.col(names_key).alias("_k"), F.col(names_value).alias("_name"))
    named = lookup(df, slim, key, "_k", spread_by, max_broadcast_rows)
    at = df.columns.index(key) + 1
    name = F.coalesce(F.col("_name"), F.concat(F.lit("id_"), F.col(key).cast("string"))).alias(out)
    return named.select(*df.columns[:at], name, *df.columns[at:])


def keys_without_match(counts: DataFrame, dimension: DataFrame, on: Column) -> DataFrame:
    """Rows of ``counts`` that no dimension row matches; a null key matches nothing."""
    return counts.join(dimension, on, "left_anti")
