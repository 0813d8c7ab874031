"""Result files: CSV with a header, read back with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

SCHEMAS = {
    "top_terms_monthly": "year_month string, term string, count bigint",
    "regional_word_distribution": (
        "region_id int, region_name string, term string, "
        "regional_count bigint, global_count bigint, relative_ratio double"
    ),
    "source_vocabulary_divergence": (
        "source_id bigint, source_name string, total_terms bigint, "
        "vocabulary_size bigint, kl_divergence double"
    ),
    "daily_peaks": (
        "date date, article_count bigint, moving_average double, delta double, is_peak boolean"
    ),
}


def write_result(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """Sorted CSV.  The order runs across the part files; AQE merges a small result into one."""
    (
        df.orderBy(*order)
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_result(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )
