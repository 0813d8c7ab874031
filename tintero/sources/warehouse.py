"""The star schema on disk: dimension folders and a fact partitioned by month."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT = "fact_news"
FACT_SCHEMA = (
    "article_id bigint, title string, body string, word_count_title bigint, "
    "word_count_body bigint, date_id int, source_id bigint, region_id int, year int, month string"
)
PARTITIONS = ("year", "month")


def staging(warehouse: str) -> str:
    """A new folder inside ``warehouse`` that scans of the warehouse don't see."""
    return f"{warehouse}/_build-{uuid4().hex}"


def publish(spark: SparkSession, staged: str, warehouse: str) -> None:
    """Put every table of ``staged`` in the place of the one of its name in ``warehouse``.

    Two renames per table and no copy; tables that replace nothing take one.
    Replaced tables are deleted at the end, so a publication that breaks off
    leaves both versions on disk.  The swap is per table, not of all at once.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())

    def move(source: str, target: str) -> None:
        if not files.rename(path(source), path(target)):
            raise OSError(f"could not rename {source} to {target}")

    names = [status.getPath().getName() for status in files.listStatus(path(staged))]
    for name in names:
        if files.exists(path(f"{warehouse}/{name}")):
            move(f"{warehouse}/{name}", f"{staged}/_replaced-{name}")
        move(f"{staged}/{name}", f"{warehouse}/{name}")
    files.delete(path(staged), True)


def write_dimension(df: DataFrame, warehouse: str, name: str) -> DataFrame:
    """One folder per dimension; AQE merges a small dimension into one file."""
    path = f"{warehouse}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_dimension(
    spark: SparkSession, warehouse: str, name: str, key: str, value: str, types: str = "bigint, string"
) -> DataFrame:
    """``(key, value)`` of a dimension, the last row winning; empty when there is none."""
    try:
        table = spark.read.parquet(f"{warehouse}/{name}")
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        key_type, value_type = types.split(", ")
        return spark.createDataFrame([], f"{key} {key_type}, {value} {value_type}")
    position = F.struct("_metadata.file_path", "_metadata.row_index")
    return table.groupBy(key).agg(F.max_by(value, position).alias(value))


def write_fact(
    df: DataFrame,
    warehouse: str,
    name: str = FACT,
    by: Sequence[str] = PARTITIONS,
    only_own_partitions: bool = False,
) -> None:
    """Replace the fact, or with ``only_own_partitions`` just the months ``df`` contains.

    ``rebalance`` brings each month together for few, large files, and lets AQE
    split the months that are too large for one task.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_own_partitions else "static")
        .partitionBy(*by)
        .parquet(f"{warehouse}/{name}")
    )


def scan_fact(
    spark: SparkSession,
    warehouse: str,
    columns: Sequence[str] | None = None,
    name: str = FACT,
    schema: str | None = None,
    files_differ: bool = False,
) -> DataFrame:
    """The fact, with ``month`` back in its two-digit form.

    ``columns`` that the fact does not have are ignored.  Filters on year and
    month prune partitions.  A missing folder is an error; one without files, as
    written for no articles at all, is an empty fact.

    Without ``schema`` the columns are those of one file.  With ``files_differ``
    they are those of all files, found by a Spark job over the footers; two
    files that give a column types that have no common one are an error.  A declared
    ``schema`` (``FACT_SCHEMA`` for example) needs no footers.  Either way a
    column is null in the rows of files without it.
    """
    reader = spark.read.option("mergeSchema", files_differ) if schema is None else spark.read.schema(schema)
    try:
        fact = reader.parquet(f"{warehouse}/{name}")
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        fact = spark.createDataFrame([], FACT_SCHEMA)
    if "month" in fact.columns:
        fact = fact.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    if columns is None:
        return fact
    return fact.select(*[c for c in columns if c in fact.columns])
