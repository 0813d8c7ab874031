"""Job: article files to a validated star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tintero.config import WarehouseConfig
from tintero.operators import dimensions, quality
from tintero.operators.cleaning import clean_articles
from tintero.operators.fact import assemble_fact
from tintero.session import scratch_path, spread_small
from tintero.sources import warehouse as store
from tintero.sources.articles import land_articles, read_article_csv


class InvalidWarehouse(RuntimeError):
    """A validation failed and the configuration asks to stop; the warehouse is as before."""


def build_warehouse(
    spark: SparkSession,
    articles: str | list[str] | DataFrame,
    warehouse: str,
    config: WarehouseConfig = WarehouseConfig(),
    split_files: bool = False,
) -> DataFrame:
    """Build dimensions and fact under ``warehouse``; returns the validation report.

    ``articles`` are CSV paths, or a stored table with the raw columns and
    ``ingest_seq``.  The text is read once, to write the fact; everything else
    reads narrow columns of stored tables.  One task reads one file; large files
    want ``split_files``, as told in :func:`read_article_csv`.

    All tables are written to a folder inside ``warehouse`` and validated
    there; then they replace those of the last build.  With
    ``fail_on_invalid`` a failed check stops before that: the last build stays
    as it was, and the error names the folder with the rejected one.
    """
    if isinstance(articles, DataFrame):
        raw = articles
    else:
        files = read_article_csv(spark, articles, id_type=config.id_type, split_files=split_files)
        raw = land_articles(files, scratch_path(spark, "landed"))
    clean = clean_articles(
        spread_small(raw, "ingest_seq"), placeholders=config.placeholders, date_formats=config.date_formats
    )

    dims = {
        "dim_date": dimensions.date_dimension(clean),
        "dim_source": dimensions.source_dimension(clean),
        "dim_region": dimensions.class_dimension(spark, config.class_names),
    }
    staged = store.staging(warehouse)
    dims = {name: store.write_dimension(df, staged, name) for name, df in dims.items()}

    fact = assemble_fact(
        clean,
        dims["dim_source"],
        config.aliases,
        config.unknown_class,
        config.title_weight,
    )
    store.write_fact(fact, staged)

    report = quality.validation_report(clean, store.scan_fact(spark, staged), dims)
    report.write.parquet(f"{staged}/validation_report")
    if config.fail_on_invalid:
        report = spark.read.parquet(f"{staged}/validation_report")
        failed = [r["check"] for r in report.where("not passed").collect()]  # at most five rows
        if failed:
            raise InvalidWarehouse(f"{', '.join(sorted(failed))} in {staged}")
    store.publish(spark, staged, warehouse)
    return spark.read.parquet(f"{warehouse}/validation_report")
