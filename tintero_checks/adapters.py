"""The driver's tables in the roles the library expects.

``documents`` become articles (title = first line, body = the rest), dates are
spread over 2023 by id, and each language's marker words serve as class aliases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero.config import AnalyticsConfig, TokenRules, WarehouseConfig
from tintero.operators.dimensions import source_dimension
from tintero.operators.fact import assemble_fact
from tintero.session import spread_by_bytes, spread_small

#: aliases that several classes share, so each class must search on its own
SHARED_MARKERS = {
    1: ["the", "of", "and"],
    2: ["de", "la", "que"],
    3: ["der", "die", "und"],
    4: ["le", "la", "et"],
}
#: aliases of different classes that cannot overlap, so one search serves all
MARKERS = {
    1: ["the", "of", "and"],
    2: ["de la", "que", "en", "del"],
    3: ["der", "die", "und", "ein"],
    4: ["le", "et", "les", "que le"],
}
MARKERS_APART = {k: [a for a in v if a != "que le"] for k, v in MARKERS.items()}
CLASS_NAMES = ("Ingles", "Espanol", "Aleman/Suizo", "Frances", "Desconocido")
UNKNOWN = 5

NO_STOP_WORDS = TokenRules(stop_words=frozenset())

WAREHOUSE = WarehouseConfig(class_names=CLASS_NAMES, aliases=MARKERS_APART, unknown_class=UNKNOWN)
ANALYTICS = AnalyticsConfig(
    top_k=20,
    min_global_count=50,
    min_regional_count=20,
    min_source_terms=1000,
    region_limit=30,
    unknown_region=UNKNOWN,
    peak_window=7,
    peak_factor=1.2,
    peak_min_delta=0.5,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_articles(table(spark, sf_dir, "documents"))


def text_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`articles` for work on the text itself."""
    return _as_articles(spread_small(table(spark, sf_dir, "documents"), "doc_id"))


def dealt_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`articles` for work that holds what it finds per article: tasks of bounded text, an article in one of them."""
    return _as_articles(spread_by_bytes(table(spark, sf_dir, "documents"), "doc_id"))


def _as_articles(documents: DataFrame) -> DataFrame:
    first_break = F.instr("text", "\n")
    return documents.select(
        F.col("doc_id").alias("article_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(first_break > 0, F.expr("substring(text, instr(text, '\n') + 1)"))
        .otherwise("")
        .alias("body"),
        "source",
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias(
            "publish_date"
        ),
        "lang",
        F.col("doc_id").alias("ingest_seq"),
    )


def year_month():
    return F.date_format("publish_date", "yyyy-MM").alias("year_month")


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as they arrive: repeated ids, gaps, bad dates, rows without an id.

    Labelled documents come twice, toxic ones the second time with a date that
    does not exist; all chat turns come without an id.
    """
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    base = articles(spark, sf_dir).join(
        labels.withColumnRenamed("doc_id", "article_id"), "article_id", "left"
    )
    iso = F.date_format("publish_date", "yyyy-MM-dd")
    first = base.select(
        "article_id",
        F.when(F.col("lang") != "fr", F.col("title")).alias("title"),
        F.nullif("body", F.lit("")).alias("body"),
        F.nullif("source", F.lit("src3")).alias("source"),
        F.when(F.col("source") == "src5", F.lit("sin fecha")).otherwise(iso).alias("publish_date"),
        "ingest_seq",
    )
    again = base.where("toxic is not null").select(
        "article_id",
        F.concat("title", F.lit(' "rev"')).alias("title"),
        F.nullif("body", F.lit("")).alias("body"),
        "source",
        F.when(F.col("toxic") == 1, F.lit("2024-02-30")).otherwise(iso).alias("publish_date"),
        (F.col("ingest_seq") + 1_000_000_000_000).alias("ingest_seq"),
    )
    chat = table(spark, sf_dir, "conversations").select(
        F.lit(None).cast("bigint").alias("article_id"),
        F.col("role").alias("title"),
        F.nullif("text", F.lit("")).alias("body"),
        F.lit("chat").alias("source"),
        F.lit("2023-06-15").alias("publish_date"),
        (F.lit(2_000_000_000_000) + F.col("conv_id") * 100_000 + F.col("turn")).alias("ingest_seq"),
    )
    return first.unionByName(again).unionByName(chat)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = source_dimension(articles(spark, sf_dir))
    return assemble_fact(text_articles(spark, sf_dir), sources, MARKERS_APART, UNKNOWN)
