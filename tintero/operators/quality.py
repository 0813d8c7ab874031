"""Data-quality checks over a fact table and its dimensions.

Keys are counted before they are compared, so the joins see one row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintero.functions import dates
from tintero.operators.joins import keys_without_match

#: fact foreign key -> (dimension, its key)
FOREIGN_KEYS = {
    "source_id": ("dim_source", "source_id"),
    "date_id": ("dim_date", "date_id"),
    "region_id": ("dim_region", "region_key"),
}


def _dimension_keys(dims: dict[str, DataFrame]) -> DataFrame:
    parts = [
        dims[dim].select(F.lit(fk).alias("dim_fk"), F.col(key).cast("long").alias("dim_key"))
        for fk, (dim, key) in FOREIGN_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def orphan_keys(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``(foreign_key, key, n_rows)`` of fact keys that are missing in their dimension."""
    pairs = F.array(
        *[
            F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).cast("long").alias("key"))
            for fk in FOREIGN_KEYS
        ]
    )
    used = fact.select(F.explode(pairs).alias("p")).groupBy("p.foreign_key", "p.key")
    counts = used.agg(F.count("*").alias("n_rows"))
    known = _dimension_keys(dims)
    same = (counts["foreign_key"] == known["dim_fk"]) & (counts["key"] == known["dim_key"])
    return keys_without_match(counts, known, same)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicate_dimension_keys(dims: dict[str, DataFrame]) -> DataFrame:
    return duplicate_keys(_dimension_keys(dims), ["dim_fk", "dim_key"])


def _misplaced() -> Column:
    return (dates.key_year(F.col("date_id")) != F.col("year")) | (
        dates.key_month(F.col("date_id")) != F.col("month").cast("int")
    )


def _counted() -> Column:
    return (F.col("word_count_title") > 0) & (F.col("word_count_body") > 0)


def partition_mismatch(fact: DataFrame) -> DataFrame:
    """Rows whose year or month disagrees with their day key."""
    return fact.where(F.coalesce(_misplaced(), F.lit(True)))


def bad_word_counts(fact: DataFrame) -> DataFrame:
    return fact.where(~F.coalesce(_counted(), F.lit(False)))


def all_true(df: DataFrame, condition, out: str = "all_true") -> DataFrame:
    """One row: whether ``condition`` holds on every row; true on an empty table."""
    return df.agg((F.count_if(~F.coalesce(condition, F.lit(False))) == 0).alias(out))


def _violations(check: str, df: DataFrame, count=None) -> DataFrame:
    n = F.coalesce(count if count is not None else F.count("*"), F.lit(0)).cast("long")
    return df.agg(n.alias("violations")).select(
        F.lit(check).alias("check"), (F.col("violations") == 0).alias("passed"), "violations"
    )


def row_count_check(clean: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact rows against cleaned rows; finds a join that multiplied or lost rows."""
    sides = clean.select(F.lit(-1).alias("side")).unionAll(fact.select(F.lit(1).alias("side")))
    return _violations("row_count", sides, F.abs(F.sum("side")))


def fact_integrity_check(fact: DataFrame) -> DataFrame:
    """Positive word counts and unique article ids, from one pass over narrow columns."""
    per_id = fact.groupBy("article_id").agg(
        F.count("*").alias("n"), F.count_if(~F.coalesce(_counted(), F.lit(False))).alias("bad")
    )
    return _violations("fact_integrity", per_id, F.sum(F.col("bad") + F.col("n") - 1))


def _used_keys(fact: DataFrame) -> DataFrame:
    """One row per key that a fact row uses; its article id carries what is wrong with the row."""
    article = F.col("article_id")
    misplaced = F.coalesce(_misplaced(), F.lit(True)).cast("int")
    bad = (~F.coalesce(_counted(), F.lit(False))).cast("int")

    def used(of: str, key: Column | None, *columns: Column) -> Column:
        key = F.lit(None) if key is None else key
        names = ("id", "misplaced", "bad")
        return F.struct(
            F.lit(of).alias("of"), key.cast("long").alias("key"), *[c.alias(n) for c, n in zip(columns, names)]
        )

    no_id = F.lit(None).cast(fact.schema["article_id"].dataType)
    uses = [used(fk, F.col(fk), no_id, F.lit(0), F.lit(0)) for fk in FOREIGN_KEYS]
    uses.append(used("article_id", None, article, misplaced, bad))
    return fact.select(F.inline(F.array(*uses))).withColumns({"in_fact": F.lit(1), "in_side": F.lit(0)})


def validation_report(clean: DataFrame, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``(check, passed, violations)``, one row per check, from one pass over the fact.

    The keys that fact rows use, the keys of the dimensions and the cleaned
    rows are counted together by key, so one shuffle of combined counts serves
    all checks and no dimension is joined.
    """
    side = {"misplaced": F.lit(0), "bad": F.lit(0), "in_fact": F.lit(0), "in_side": F.lit(1)}
    no_id = F.lit(None).cast(fact.schema["article_id"].dataType)
    known = _dimension_keys(dims).select(F.col("dim_fk").alias("of"), F.col("dim_key").alias("key"), no_id.alias("id"))
    cleaned = clean.select(F.lit("cleaned").alias("of"), F.lit(None).cast("long").alias("key"), no_id.alias("id"))
    every = reduce(DataFrame.unionByName, [_used_keys(fact), known.withColumns(side), cleaned.withColumns(side)])
    sums = {c: F.sum(c).alias(c) for c in ("misplaced", "bad", "in_fact", "in_side")}
    by_key = every.groupBy("of", "key", "id").agg(*sums.values())

    def total(count: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, count)), F.lit(0))

    of, in_fact, in_side = F.col("of"), F.col("in_fact"), F.col("in_side")
    a_key, an_article = of.isin(*FOREIGN_KEYS), of == "article_id"
    found = {
        "referential_integrity": total(in_fact, a_key & ((in_side == 0) | F.col("key").isNull())),
        "row_count": F.abs(total(in_fact, an_article) - total(in_side, of == "cleaned")),
        "dimension_keys_unique": total(in_side - 1, a_key & (in_side > 1)),
        "partitions_match_dates": total(F.col("misplaced"), an_article),
        "fact_integrity": total(F.col("bad") + in_fact - 1, an_article),
    }
    checks = [F.struct(F.lit(name).alias("check"), n.alias("violations")) for name, n in found.items()]
    rows = by_key.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
    return rows.select("check", (F.col("violations") == 0).alias("passed"), "violations")
