"""Raw article files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero import lexicon
from tintero.sources.split_csv import csv_records

ARTICLE_COLUMNS = ("article_id", "title", "body", "source", "publish_date")
_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}
#: more files than this are numbered by a shuffled join instead of a broadcast one
BROADCAST_FILES = 100_000


def na_to_null(c: Column, tokens: Sequence[str] = lexicon.NA_TOKENS) -> Column:
    return F.when(c.isin(list(tokens)), None).otherwise(c)


def strict_cast(c: Column, type_name: str) -> Column:
    """Cast that fails on malformed values whatever the ANSI setting, instead of nulling them."""
    cast = c.try_cast(type_name)
    bad = F.raise_error(F.concat(F.lit(f"not a {type_name}: "), c)).cast(type_name)
    return F.when(c.isNotNull() & cast.isNull(), bad).otherwise(cast)


def _file_ranks(spark: SparkSession, files: list[str]) -> DataFrame:
    """Position of each file by name: one row per file, as listed by the driver already."""
    rows = [(_plain(f), i) for i, f in enumerate(sorted(files))]
    ranks = spark.createDataFrame(rows, "ranked string, file_rank long")
    return F.broadcast(ranks) if len(files) <= BROADCAST_FILES else ranks


def _plain(uri: str) -> str:
    """``file:///a`` and ``file:/a`` are the same file."""
    scheme, _, rest = uri.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if scheme == "file" else uri


def read_article_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = ARTICLE_COLUMNS,
    id_type: str = "bigint",
    na_tokens: Sequence[str] = lexicon.NA_TOKENS,
    split_files: bool = False,
    line_end: str | None = None,
) -> DataFrame:
    """Article files with a header, quoted multi-line fields and doubled quotes.

    Adds ``ingest_seq``, which follows (file name, place in the file).  One task
    reads one file; with ``split_files`` several tasks read a large one, which
    holds for files that quote as RFC 4180 says (see
    :mod:`tintero.sources.split_csv`).  The choice is the caller's and doesn't
    depend on sizes.  A file whose header differs from the first one's is an
    error.  Line breaks inside fields are kept as written with ``split_files``,
    and without it if ``line_end`` names the line end of all files; otherwise
    Spark finds the line end of each file, and CRLF inside fields of files with
    CRLF line ends arrives as LF.
    """
    ends = {} if line_end is None else {"lineSep": line_end}
    whole_files = spark.read.options(**_CSV, **ends).csv(path)  # reads the header only
    files = whole_files.inputFiles()
    ranks = _file_ranks(spark, files)
    position_bits = 63 - max(1, (len(files) - 1).bit_length())  # half a million files leave room for 16 TB each
    if split_files:
        names = ", ".join(f"`{c}` string" for c in whole_files.columns)
        record = F.from_csv("text", names, _CSV | {"header": "false", "lineSep": "\n"})  # keeps CRLF inside fields
        placed = csv_records(spark, path, whole_files.columns).select(record.alias("r"), "file", "position")
        placed = placed.select("r.*", "file", "position")
    else:
        in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        placed = whole_files.select(
            "*", F.col("_metadata.file_path").alias("file"), in_partition.alias("position")
        )
    plain = F.regexp_replace("file", "^file:/+", "file:/")
    sequence = F.shiftleft("file_rank", position_bits) + F.col("position")
    typed = [
        strict_cast(na_to_null(F.col(c), na_tokens), id_type).alias(c)
        if c == "article_id"
        else na_to_null(F.col(c), na_tokens).alias(c)
        for c in columns
    ]
    return placed.join(ranks, plain == F.col("ranked"), "left").select(
        *typed, sequence.alias("ingest_seq")
    )


def land_articles(df: DataFrame, path: str) -> DataFrame:
    """Write raw articles as Parquet once; later passes read only the columns they need."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
