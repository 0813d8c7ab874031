"""Job: report tables from the analytics results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tintero.config import ReportConfig
from tintero.operators import report
from tintero.operators.series import peaks_only
from tintero.sources import results


def report_frames(
    frames: dict[str, DataFrame], config: ReportConfig = ReportConfig()
) -> dict[str, DataFrame]:
    return {
        "global_top_terms": report.global_terms(frames["top_terms_monthly"], config.top_n),
        "monthly_leading_terms": report.leading_terms(frames["top_terms_monthly"]),
        "divergent_sources": report.divergent_sources(
            frames["source_vocabulary_divergence"], config.top_n
        ),
        "daily_series": frames["daily_peaks"].orderBy("date"),
        "peak_days": peaks_only(frames["daily_peaks"]).orderBy("date"),
        "regional_terms": report.distinctive_terms(
            frames["regional_word_distribution"], config.regions, config.terms_per_region
        ),
    }


def build_reports(
    spark: SparkSession, output: str, config: ReportConfig = ReportConfig()
) -> dict[str, DataFrame]:
    """Report tables from the result files that the analytics job wrote under ``output``."""
    frames = {
        name: results.read_result(spark, f"{output}/{name}", schema)
        for name, schema in results.SCHEMAS.items()
    }
    return report_frames(frames, config)
