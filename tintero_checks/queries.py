"""Every operator as a query over the driver's tables, next to its oracle SQL.

``register(name, sql)`` records both; a few queries have no SQL form and say why.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero import lexicon
from tintero.config import TokenRules
from tintero.functions import dates, text
from tintero.operators import (
    alias_table,
    classify,
    cleaning,
    date_formats,
    dimensions,
    joins,
    quality,
    report,
    series,
    terms,
)
from tintero.operators import fact as facts
from tintero.plans import analytics as analytics_job
from tintero.plans import incremental
from tintero.plans.report import build_reports
from tintero.plans.warehouse import build_warehouse
from tintero.session import materialize, scratch_path, text_bytes
from tintero.sources import articles as article_files
from tintero.sources import results, snapshots, warehouse
from tintero_checks import sql
from tintero_checks.adapters import (
    ANALYTICS,
    CLASS_NAMES,
    MARKERS_APART,
    NO_STOP_WORDS,
    SHARED_MARKERS,
    UNKNOWN,
    WAREHOUSE,
    articles,
    dealt_articles,
    fact,
    raw_articles,
    table,
    text_articles,
    year_month,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def counted(spark: SparkSession, sf_dir: str, *keys: str, rules: TokenRules = NO_STOP_WORDS) -> DataFrame:
    keyed = [year_month() if k == "year_month" else k for k in keys]
    return terms.term_counts(text_articles(spark, sf_dir), keyed, rules=rules)


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"title_clean": F.col("title"), "body_clean": F.col("body")}
    return text.with_folded(text_articles(spark, sf_dir), columns)


def _joined_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = {"whole": text.joined(F.col("title"), F.col("body"))}
    return text.with_folded(text_articles(spark, sf_dir), whole)


A, KEPT = sql.ARTICLES, sql.kept_terms()

# ---------------------------------------------------------------- text and terms


@register(
    "top_terms_monthly",
    f"""WITH {A}, {sql.kept_terms(stop_words=True)},
    n AS (SELECT year_month, term, count(*) AS count FROM kept GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY count DESC, term) AS rn FROM n)
    SELECT year_month, term, count FROM r WHERE rn <= 20""",
)
def top_terms_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted(spark, sf_dir, "year_month", rules=TokenRules())
    return terms.top_terms(counts, 20)


@register(
    "text_fold",
    f"""WITH {A} SELECT article_id, {sql.fold("title")} AS title_clean,
    md5({sql.fold("body")}) AS body_md5 FROM articles""",
)
def text_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).select(
        "article_id", "title_clean", F.md5("body_clean").alias("body_md5")
    )


@register(
    "text_fold_arrow",
    f"""WITH {A} SELECT article_id, {sql.fold("title")} AS title_clean,
    md5({sql.fold("body")}) AS body_md5 FROM articles""",
)
def text_fold_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fold as plain expressions in one projection; it took an Arrow UDF before."""
    fold = text.fold
    return articles(spark, sf_dir).select(
        "article_id", fold(F.col("title")).alias("title_clean"), F.md5(fold(F.col("body"))).alias("body_md5")
    )


@register(
    "text_joined",
    f"""WITH {A} SELECT article_id,
    md5(coalesce(nullif(title, ''), '') || ' ' || coalesce(nullif(body, ''), '')) AS text_md5
    FROM articles""",
)
def text_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = articles(spark, sf_dir).select(
        "article_id", *[F.nullif(c, F.lit("")).alias(c) for c in ("title", "body")]
    )
    return gaps.select("article_id", F.md5(text.joined(F.col("title"), F.col("body"))).alias("text_md5"))


@register(
    "letter_runs",
    f"""WITH {A} SELECT article_id, len(t) AS n_runs, len(list_distinct(t)) AS n_distinct FROM (
      SELECT article_id, regexp_extract_all({sql.fold("title || ' ' || body")}, '[a-z]+') AS t
      FROM articles)""",
)
def letter_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _joined_fold(spark, sf_dir).select("article_id", text.letter_runs(F.col("whole")).alias("t"))
    return tokens.select(
        "article_id",
        F.size("t").cast("long").alias("n_runs"),
        F.size(F.array_distinct("t")).cast("long").alias("n_distinct"),
    )


@register(
    "term_rules",
    f"""WITH {A}, {sql.kept_terms(stop_words=True)}
    SELECT article_id, count(*) AS n_terms, count(DISTINCT term) AS n_distinct, min(term) AS first_term
    FROM kept GROUP BY article_id""",
)
def term_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = terms.term_counts(dealt_articles(spark, sf_dir), ["article_id"])
    return kept.groupBy("article_id").agg(
        F.sum("count").alias("n_terms"),
        F.count("*").alias("n_distinct"),
        F.min("term").alias("first_term"),
    )


@register(
    "term_rules_as_predicate",
    f"""WITH {A}, {sql.kept_terms(stop_words=True)}
    SELECT lang, term, count(*) AS count FROM kept GROUP BY lang, term""",
)
def term_rules_as_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = text.letter_runs(F.col("whole"))
    words = _joined_fold(spark, sf_dir).select("lang", F.explode(runs).alias("term"))
    counts = words.groupBy("lang", "term").agg(F.count("*").alias("count"))
    return counts.where(text.is_term(F.col("term"), TokenRules()))


@register(
    "stop_word_removal",
    f"""WITH {A}, {sql.kept_terms(stop_words=True)}
    SELECT term, count(*) AS count FROM kept GROUP BY term""",
)
def stop_word_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir, rules=TokenRules())


@register(
    "stop_word_table",
    f"""WITH {A}, {KEPT},
    words AS (SELECT DISTINCT unnest(regexp_extract_all({sql.fold("text")}, '[a-z]+')) AS word
              FROM benchmark)
    SELECT term, count(*) AS count FROM kept
    WHERE term NOT IN (SELECT word FROM words) GROUP BY term""",
)
def stop_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = text.letter_runs(text.fold(F.col("text")))
    words = table(spark, sf_dir, "benchmark").select(F.explode(runs).alias("word")).distinct()
    return terms.without_words(counted(spark, sf_dir), words)


@register(
    "word_counts",
    f"""WITH {A} SELECT article_id, {sql.spaces(sql.fold("title"))} AS word_count_title,
    {sql.spaces(sql.fold("body"))} AS word_count_body FROM articles""",
)
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).select(
        "article_id",
        *[text.word_count(F.col(f"{c}_clean")).alias(f"word_count_{c}") for c in ("title", "body")],
    )


# ---------------------------------------------------------------- cleaning


@register(
    "keep_last_turn",
    """SELECT conv_id, turn, role, md5(text) AS text_md5 FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations)
    WHERE rn = 1""",
)
def keep_last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = cleaning.keep_last_narrow(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    return last.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@register(
    "keep_last_event",
    """SELECT user_id, event_id, event_type, round(value, 6) AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""",
)
def keep_last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = cleaning.keep_last(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
    return rounded(last.select("user_id", "event_id", "event_type", "value"), "value")


_CLEAN = f"""{sql.RAW},
last AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY ingest_seq DESC) AS rn
  FROM raw_articles) WHERE rn = 1),
clean AS (
  SELECT article_id, coalesce(title, 'sin titulo') AS title, coalesce(body, 'sin cuerpo') AS body,
         coalesce(source, 'fuente desconocida') AS source,
         try_cast(publish_date AS DATE) AS publish_date, ingest_seq
  FROM last WHERE try_cast(publish_date AS DATE) IS NOT NULL)"""
_CLEAN_SELECT = """SELECT article_id, title, md5(body) AS body_md5, source, publish_date"""


def _clean_columns(clean: DataFrame) -> DataFrame:
    return clean.select(
        "article_id", "title", F.md5("body").alias("body_md5"), "source", "publish_date"
    )


@register("clean_articles", f"WITH {_CLEAN} {_CLEAN_SELECT} FROM clean")
def clean_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_columns(cleaning.clean_articles(raw_articles(spark, sf_dir)))


@register("clean_articles_by_window", f"WITH {_CLEAN} {_CLEAN_SELECT} FROM clean")
def clean_articles_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_columns(cleaning.clean_articles(raw_articles(spark, sf_dir), narrow=False))


@register(
    "fill_missing",
    f"""WITH {sql.RAW} SELECT ingest_seq, coalesce(title, 'sin titulo') AS title,
    coalesce(source, 'fuente desconocida') AS source, md5(coalesce(body, 'sin cuerpo')) AS body_md5
    FROM raw_articles""",
)
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = cleaning.fill_missing(raw_articles(spark, sf_dir))
    return filled.select("ingest_seq", "title", "source", F.md5("body").alias("body_md5"))


@register(
    "lenient_dates",
    f"""WITH {sql.RAW} SELECT ingest_seq, try_cast(publish_date AS DATE) AS publish_date
    FROM raw_articles WHERE try_cast(publish_date AS DATE) IS NOT NULL""",
)
def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dated_only(raw_articles(spark, sf_dir).select("ingest_seq", "publish_date"))


_DATE_FORMATS = {"yyyy-M-d": "%Y-%m-%d", "M/d/yyyy": "%m/%d/%Y", "d/M/yyyy": "%d/%m/%Y", "d.M.yyyy": "%d.%m.%Y"}
_READ = ", ".join(f"sum((try_strptime(d, '{f}') IS NOT NULL)::INT) AS f{i}" for i, f in enumerate(_DATE_FORMATS.values()))
_BEST = "CASE greatest(f0, f1, f2, f3) " + " ".join(f"WHEN f{i} THEN '{f}'" for i, f in enumerate(_DATE_FORMATS.values())) + " END"

_AS_ELECTED = " ".join(f"WHEN '{f}' THEN try_strptime(d, '{f}')" for f in _DATE_FORMATS.values())


def _elected_sql(name: str, pattern: str) -> str:
    return f"""{name}_d AS (SELECT doc_id, CASE WHEN source = 'src5' THEN 'sin fecha' ELSE
      strftime(DATE '2023-01-01' + CAST(doc_id % 365 AS INTEGER), '{pattern}') || CASE WHEN doc_id % 3 = 0 THEN ' 08:30:00' ELSE '' END
      END AS whole, split_part(whole, ' 08', 1) AS d FROM documents),
    {name}_f AS (SELECT {_BEST} AS best FROM (SELECT {_READ} FROM {name}_d)),
    {name} AS (SELECT doc_id, CAST(CASE best {_AS_ELECTED} END AS DATE) AS day FROM {name}_d, {name}_f)"""


@register(
    "elected_date_formats",
    f"""WITH {_elected_sql("a", "%d/%m/%Y")}, {_elected_sql("b", "%m/%d/%Y")}, {_elected_sql("c", "%d.%m.%Y")}
    SELECT doc_id, a.day AS day_first, b.day AS month_first, c.day AS dotted
    FROM a JOIN b USING (doc_id) JOIN c USING (doc_id)""",
)
def elected_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    late = F.when(F.col("doc_id") % 3 == 0, F.lit(" 08:30:00")).otherwise("")
    written = {"day_first": "dd/MM/yyyy", "month_first": "MM/dd/yyyy", "dotted": "dd.MM.yyyy"}
    docs = table(spark, sf_dir, "documents").select("doc_id", *[
        F.when(F.col("source") == "src5", F.lit("sin fecha")).otherwise(F.concat(F.date_format(day, f), late)).alias(c)
        for c, f in written.items()
    ])
    for column in written:
        elected = date_formats.elect_format(docs, column)
        docs = docs.withColumn(column, dates.lenient_date(F.col(column), (elected,)))
    return docs


_FORMATS_SQL = " UNION ALL ".join(
    f"""SELECT '{java}' AS format, {i} AS place, sum((try_strptime(d, '{f}') IS NOT NULL)::INT)::BIGINT AS parsed,
    sum((try_strptime(d, '{f}') IS NOT NULL)::INT)::BIGINT AS plausible,
    sum(({"try_strptime(d, '%m/%d/%Y') IS NOT NULL AND try_strptime(d, '%d/%m/%Y') IS NOT NULL" if "/" in java else "false"})::INT)::BIGINT
    AS ambiguous FROM a_d"""
    for i, (java, f) in enumerate(_DATE_FORMATS.items())
)


@register("date_format_scores", f"WITH {_elected_sql('a', '%d/%m/%Y')} {_FORMATS_SQL}")
def date_format_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    text_ = F.when(F.col("source") == "src5", F.lit("sin fecha")).otherwise(F.date_format(day, "dd/MM/yyyy"))
    docs = table(spark, sf_dir, "documents").select(text_.alias("d"))
    return date_formats.format_scores(docs, "d", list(_DATE_FORMATS))


_RAW_COLUMNS = ("article_id", "title", "body", "source", "publish_date", "ingest_seq")


@register(
    "null_profile",
    f"WITH {sql.RAW} SELECT "
    + ", ".join(f"count(*) - count({c}) AS {c}" for c in _RAW_COLUMNS)
    + " FROM raw_articles",
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.null_profile(raw_articles(spark, sf_dir))


@register(
    "table_size",
    "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem",
)
def table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.table_size(table(spark, sf_dir, "lineitem"))


@register(
    "head_articles",
    f"WITH {A} SELECT article_id, title, publish_date FROM articles ORDER BY publish_date, article_id LIMIT 5",
)
def head_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = articles(spark, sf_dir).select("article_id", "title", "publish_date")
    return cleaning.head(chosen, ["publish_date", "article_id"])


# ---------------------------------------------------------------- article files


#: about as much text goes into one of the CSV files, of which there are four at least
_CSV_FILE_BYTES = 48 << 20


def _write_article_csv(spark: SparkSession, sf_dir: str, file_bytes: int = _CSV_FILE_BYTES) -> str:
    """Raw articles as several CSV files, quoted, in ingest order, gaps written as NA."""
    path = scratch_path(spark, "article-csv")
    raw = raw_articles(spark, sf_dir)
    (
        raw.repartitionByRange(max(4, -(-text_bytes(raw) // file_bytes)), "ingest_seq")
        .sortWithinPartitions("ingest_seq")
        .select("article_id", "title", "body", "source", "publish_date")
        .write.option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .option("nullValue", "NA")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


_CSV_ROWS = f"""WITH {sql.RAW}
    SELECT article_id, title, md5(body) AS body_md5, source, publish_date,
    row_number() OVER (ORDER BY ingest_seq) AS position FROM raw_articles"""


@register("csv_scan", _CSV_ROWS)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_position(article_files.read_article_csv(spark, _write_article_csv(spark, sf_dir)))


@register("csv_scan_by_splits", _CSV_ROWS)
def csv_scan_by_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_article_csv(spark, sf_dir)
    return _with_position(article_files.read_article_csv(spark, path, split_files=True))


def _with_position(rows: DataFrame) -> DataFrame:
    numbered = dimensions.numbered_by_first_seen(
        rows, "ingest_seq", "ingest_seq", "seq", "position", single_task_keys=100
    )
    return rows.join(numbered, rows["ingest_seq"] == numbered["seq"]).select(
        "article_id", "title", F.md5("body").alias("body_md5"), "source", "publish_date", "position"
    )


@register("csv_to_clean_articles", f"WITH {_CLEAN} {_CLEAN_SELECT} FROM clean")
def csv_to_clean_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = article_files.read_article_csv(spark, _write_article_csv(spark, sf_dir))
    landed = article_files.land_articles(files, scratch_path(spark, "landed"))
    return _clean_columns(cleaning.clean_articles(landed))


@register(
    "result_csv_roundtrip",
    f"""WITH {A}, {KEPT}, n AS (SELECT source, term, count(*) AS n FROM kept GROUP BY source, term),
    {sql.divergence("n", "source", 50, 1000)}, {sql.sources()}
    SELECT source_id, source_name, total_terms, vocabulary_size, kl_divergence
    FROM divergence JOIN dim_source ON source = source_name""",
)
def result_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "source_vocabulary_divergence"
    counts = counted(spark, sf_dir, "source")
    frame = terms.vocabulary_divergence(counts, "source", 50, 1000)
    ids = dimensions.source_dimension(articles(spark, sf_dir))
    named = joins.lookup(frame, ids, "source", "source_name", "source").withColumnRenamed(
        "source", "source_name"
    )
    path = scratch_path(spark, name)
    ordered = named.select("source_id", "source_name", "total_terms", "vocabulary_size", "kl_divergence")
    results.write_result(ordered, path, analytics_job.sort_keys(name))
    return rounded(results.read_result(spark, path, results.SCHEMAS[name]), "kl_divergence")


# ---------------------------------------------------------------- dates and dimensions


@register(
    "date_attributes",
    """SELECT CAST(o_orderdate AS DATE) AS full_date,
      CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
      CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%m') AS month,
      CAST(day(o_orderdate) AS INTEGER) AS day, dayname(o_orderdate) AS day_of_week,
      count(*) AS n_orders
    FROM orders GROUP BY ALL""",
)
def date_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("full_date"))
        .agg(F.count("*").alias("n_orders"))
    )
    parts = [c.alias(n) for n, c in dates.calendar(F.col("full_date")).items()]
    return per_day.select("full_date", *parts, "n_orders")


@register(
    "months_and_days_from_keys",
    """SELECT strftime(l_shipdate, '%Y-%m') AS from_key, strftime(l_shipdate, '%Y-%m') AS from_parts,
      CAST(l_shipdate AS DATE) AS day, count(*) AS n_lines FROM lineitem GROUP BY ALL""",
)
def months_and_days_from_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("d"))
    keyed = shipped.agg(F.count("*").alias("n_lines")).withColumn("k", dates.day_key(F.col("d")))
    parts = (F.year("d"), dates.month_text(F.col("d")))
    return keyed.select(
        dates.month_of(F.col("k")).alias("from_key"),
        dates.month_of(F.lit(None), *parts).alias("from_parts"),
        dates.day_of(F.col("k")).alias("day"),
        "n_lines",
    )


@register(
    "date_range",
    """SELECT event_type, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day
    FROM events GROUP BY event_type""",
)
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("d"))
    return dimensions.date_range(days, "d", ["event_type"])


@register(
    "dim_date",
    """WITH days AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
      INTERVAL 1 DAY)) AS DATE) AS full_date FROM orders)
    SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id,
      CAST(year(full_date) AS INTEGER) AS year, strftime(full_date, '%m') AS month,
      CAST(day(full_date) AS INTEGER) AS day, dayname(full_date) AS day_of_week FROM days""",
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return dimensions.date_dimension(days, "day")


@register("dim_source", f"WITH {A}, {sql.sources()} SELECT source_name, source_id FROM dim_source")
def dim_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.source_dimension(articles(spark, sf_dir))


@register(
    "dim_source_large",
    """SELECT o_custkey AS customer, row_number() OVER (ORDER BY min(o_orderkey), o_custkey) AS customer_no
    FROM orders GROUP BY o_custkey""",
)
def dim_source_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.numbered_by_first_seen(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "customer", "customer_no",
        single_task_keys=100,
    )


_NAMES = ", ".join(f"({i}, '{n}')" for i, n in enumerate(CLASS_NAMES, start=1))


@register(
    "articles_by_class_name",
    f"""WITH {A}, {sql.voted(MARKERS_APART, UNKNOWN)}, names(region_key, region_name) AS (VALUES {_NAMES})
    SELECT region_id, region_name, count(*) AS n_articles
    FROM voted JOIN names ON region_id = region_key GROUP BY ALL""",
)
def articles_by_class_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fact(spark, sf_dir).groupBy("region_id").agg(F.count("*").alias("n_articles"))
    names = dimensions.class_dimension(spark, CLASS_NAMES)
    return joins.add_names(
        counts, names, "region_id", "region_key", "region_name", "region_name", "region_id"
    )


# ---------------------------------------------------------------- classifier


def _voted(spark: SparkSession, sf_dir: str, aliases, unknown: int = UNKNOWN, **options) -> DataFrame:
    voted = classify.vote(_folded(spark, sf_dir), aliases, unknown, **options)
    return voted.select("article_id", "region_id")


_VOTED = "SELECT article_id, region_id FROM voted"


@register("region_vote", f"WITH {A}, {sql.voted(MARKERS_APART, UNKNOWN)} {_VOTED}")
def region_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _voted(spark, sf_dir, MARKERS_APART)


@register("region_vote_shared_aliases", f"WITH {A}, {sql.voted(SHARED_MARKERS, UNKNOWN)} {_VOTED}")
def region_vote_shared_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _voted(spark, sf_dir, SHARED_MARKERS)


@register(
    "region_vote_title_breaks_ties",
    f"WITH {A}, {sql.voted(SHARED_MARKERS, UNKNOWN, title_first=True)} {_VOTED}",
)
def region_vote_title_breaks_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _voted(spark, sf_dir, SHARED_MARKERS, title_breaks_ties=True)


@register(
    "region_vote_default_aliases",
    f"WITH {A}, {sql.voted(lexicon.REGION_ALIASES, lexicon.UNKNOWN_REGION)} {_VOTED}",
)
def region_vote_default_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _voted(spark, sf_dir, lexicon.REGION_ALIASES, lexicon.UNKNOWN_REGION)


def _by_table(spark: SparkSession, sf_dir: str, aliases, unknown: int) -> DataFrame:
    rows = [(key, alias, place) for key, names in aliases.items() for place, alias in enumerate(names)]
    table_ = spark.createDataFrame(rows, "class_id int, alias string, place int")
    return alias_table.vote_by_table(_folded(spark, sf_dir), table_, unknown)


@register("region_vote_by_alias_table", f"WITH {A}, {sql.voted(SHARED_MARKERS, UNKNOWN)} {_VOTED}")
def region_vote_by_alias_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_table(spark, sf_dir, SHARED_MARKERS, UNKNOWN)


_TERM_ALIASES = """marked AS (
  SELECT article_id, lower(strip_accents(title)) AS t, lower(strip_accents(body)) AS b FROM articles),
grams AS (SELECT article_id, 3 AS weight, unnest(regexp_extract_all(t, '[a-z]+')) AS term FROM marked
  UNION ALL SELECT article_id, 1, unnest(regexp_extract_all(b, '[a-z]+')) FROM marked),
known AS (SELECT term FROM grams WHERE length(term) BETWEEN 4 AND 24 GROUP BY term
  HAVING count(DISTINCT article_id) BETWEEN 3 AND 200),
aliases AS (SELECT term, CAST(1 + ascii(term) * 7 % 13 * 100 + length(term) AS INTEGER) AS class_id FROM known),
scores AS (SELECT article_id, class_id, sum(weight) AS score FROM grams JOIN aliases USING (term) GROUP BY ALL)"""


@register(
    "region_vote_by_corpus_aliases",
    f"""WITH articles AS (SELECT doc_id AS article_id, regexp_replace(split_part(text, chr(10), 1), '[^ -~]', ' ', 'g') AS title,
      regexp_replace(CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END,
        '[^ -~]', ' ', 'g') AS body FROM documents),
    words AS (SELECT article_id, regexp_replace(title, '[^A-Za-z]', ' ', 'g') AS title,
      regexp_replace(body, '[^A-Za-z]', ' ', 'g') AS body FROM articles),
    {_TERM_ALIASES.replace("FROM articles", "FROM words")}
    SELECT article_id, coalesce((SELECT min(class_id) FROM scores s WHERE s.article_id = w.article_id AND s.score =
      (SELECT max(score) FROM scores x WHERE x.article_id = w.article_id)), 9999) AS region_id FROM words w""",
)
def region_vote_by_corpus_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of aliases, taken from the corpus itself, in hundreds of classes."""
    plain = dealt_articles(spark, sf_dir).select(
        "article_id", *[F.lower(F.regexp_replace(c, "[^A-Za-z]", " ")).alias(c) for c in ("title", "body")]
    )
    words = text.letter_runs(F.concat_ws(" ", "title", "body"))
    terms_ = plain.select("article_id", F.explode(F.array_distinct(words)).alias("alias"))
    known = terms_.where(F.char_length("alias").between(4, 24)).distinct().groupBy("alias").agg(F.count("*").alias("n"))
    class_id = (1 + F.ascii("alias") * 7 % 13 * 100 + F.char_length("alias")).cast("int")
    aliases = known.where(F.col("n").between(3, 200)).select("alias", class_id.alias("class_id"))
    return alias_table.vote_by_table(plain, aliases, 9999, title="title", body="body")


# ---------------------------------------------------------------- fact

_FACT = sql.fact(MARKERS_APART, UNKNOWN)
_FACT_SELECT = """SELECT article_id, title, md5(body) AS body_md5, word_count_title, word_count_body,
  date_id, source_id, region_id, year, month FROM fact"""


def _fact_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("body", F.md5("body")).withColumnRenamed("body", "body_md5")


@register("fact_assembly", f"WITH {_FACT} {_FACT_SELECT}")
def fact_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_columns(fact(spark, sf_dir))


@register("fact_assembly_salted_lookup", f"WITH {_FACT} SELECT article_id, source_id FROM fact")
def fact_assembly_salted_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = articles(spark, sf_dir).select("article_id", "source", "ingest_seq")
    dims = dimensions.source_dimension(narrow)
    keyed = joins.lookup(
        narrow, dims, "source", "source_name", "article_id", max_broadcast_rows=0, salts=8
    )
    return keyed.select("article_id", "source_id")


@register("fact_roundtrip", f"WITH {_FACT} {_FACT_SELECT}")
def fact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip")
    warehouse.write_fact(fact(spark, sf_dir), path)
    return _fact_columns(warehouse.scan_fact(spark, path, facts.FACT_COLUMNS))


@register(
    "fact_pruned_scan",
    f"""WITH {_FACT} SELECT article_id, date_id, month FROM fact
    WHERE year = 2023 AND month IN ('02', '11')""",
)
def fact_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pruned")
    warehouse.write_fact(fact(spark, sf_dir), path)
    scan = warehouse.scan_fact(spark, path, ["article_id", "date_id", "year", "month", "no_such"])
    months = scan.where((F.col("year") == 2023) & F.col("month").isin("02", "11"))
    return months.select("article_id", "date_id", "month")


@register(
    "fact_with_differing_files",
    f"""WITH {_FACT} SELECT article_id, CASE WHEN month <> '02' THEN title END AS title,
    CASE WHEN month = '02' THEN md5(body) END AS body_md5, month FROM fact""",
)
def fact_with_differing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "differing")
    whole = fact(spark, sf_dir)
    warehouse.write_fact(whole.where("month <> '02'").drop("body"), path)
    warehouse.write_fact(whole.where("month = '02'").drop("title"), path, only_own_partitions=True)
    found = warehouse.scan_fact(spark, path, files_differ=True)
    return found.select("article_id", "title", F.md5("body").alias("body_md5"), "month")


@register(
    "date_lookup",
    f"""WITH {A} SELECT article_id, CAST(strftime(publish_date, '%Y%m%d') AS INTEGER) AS date_id,
    dayname(publish_date) AS day_of_week FROM articles""",
)
def date_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).select("article_id", "publish_date")
    calendar = dimensions.date_dimension(rows).select("full_date", "date_id", "day_of_week")
    return facts.add_date_attributes(rows, calendar).select("article_id", "date_id", "day_of_week")


@register(
    "name_enrich",
    """SELECT n_nationkey, n_name, n_regionkey,
      CASE WHEN r_name = 'ASIA' OR r_name IS NULL THEN 'id_' || n_regionkey ELSE r_name END AS region_name
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def name_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    return joins.add_names(
        table(spark, sf_dir, "nation"), known, "n_regionkey", "r_regionkey", "r_name",
        "region_name", "n_nationkey",
    )


@register(
    "stored_dimension_lookup",
    """SELECT c_custkey, c_nationkey, n_name AS nation_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def stored_dimension_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dims")
    warehouse.write_dimension(table(spark, sf_dir, "nation"), path, "dim_nation")
    names = warehouse.read_dimension(spark, path, "dim_nation", "n_nationkey", "n_name")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.add_names(
        customers, names, "c_nationkey", "n_nationkey", "n_name", "nation_name", "c_custkey"
    )


@register(
    "missing_dimension_lookup",
    "SELECT s_suppkey, s_nationkey, 'id_' || s_nationkey AS nation_name FROM supplier",
)
def missing_dimension_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "no-dims")
    names = warehouse.read_dimension(spark, path, "dim_none", "k", "v", "int, string")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return joins.add_names(suppliers, names, "s_nationkey", "k", "v", "nation_name", "s_suppkey")


# ---------------------------------------------------------------- counts and shares


@register(
    "emitted_sum",
    """SELECT o_orderpriority, status, count(*) AS count FROM (
      SELECT o_orderpriority, unnest([o_orderstatus, o_orderstatus || '*']) AS status FROM orders)
    GROUP BY ALL""",
)
def emitted_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(F.col("o_orderstatus"), F.concat("o_orderstatus", F.lit("*")))
    return terms.sum_emitted(table(spark, sf_dir, "orders"), ["o_orderpriority"], pairs, "status")


@register(
    "term_counts_monthly",
    f"WITH {A}, {KEPT} SELECT year_month, term, count(*) AS count FROM kept GROUP BY ALL",
)
def term_counts_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir, "year_month")


@register(
    "term_counts_global",
    f"WITH {A}, {KEPT} SELECT term, count(*) AS count FROM kept GROUP BY ALL",
)
def term_counts_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.recount(counted(spark, sf_dir, "source"), ["term"])


@register(
    "term_counts_region",
    f"""WITH {A}, {KEPT}, {sql.voted(MARKERS_APART, UNKNOWN)}
    SELECT region_id, term, count(*) AS count FROM kept JOIN voted USING (article_id)
    WHERE region_id <> {UNKNOWN} GROUP BY ALL""",
)
def term_counts_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.term_counts(fact(spark, sf_dir), ["region_id"], rules=NO_STOP_WORDS)
    return terms.exclude_class(counts, "region_id", UNKNOWN)


@register(
    "region_totals",
    f"""WITH {A}, {KEPT}, {sql.voted(MARKERS_APART, UNKNOWN)}
    SELECT region_id, count(*) AS total FROM kept JOIN voted USING (article_id) GROUP BY ALL""",
)
def region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.term_counts(fact(spark, sf_dir), ["region_id"], rules=NO_STOP_WORDS)
    return terms.class_totals(counts, "region_id")


@register("grand_total", f"WITH {A}, {KEPT} SELECT count(*) AS total FROM kept")
def grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.grand_total(counted(spark, sf_dir))


@register(
    "term_counts_source",
    f"WITH {A}, {KEPT} SELECT source, term, count(*) AS count FROM kept GROUP BY ALL",
)
def term_counts_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir, "source")


@register(
    "base_counts",
    f"""WITH {_FACT}, {sql.kept_terms(stop_words=True, source="fact")}
    SELECT k.year_month, f.region_id, f.source_id, term, count(*) AS count
    FROM kept k JOIN fact f USING (article_id) GROUP BY ALL""",
)
def base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics_job.base_counts(fact(spark, sf_dir))


@register(
    "source_vocabulary",
    f"""WITH {A}, {KEPT} SELECT source, count(*) AS total_terms,
    count(DISTINCT term) AS vocabulary_size FROM kept GROUP BY source""",
)
def source_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.vocabulary(counted(spark, sf_dir, "source"), "source")


@register(
    "term_shares",
    f"""WITH {A}, {KEPT}, n AS (SELECT source, term, count(*) AS n FROM kept GROUP BY source, term),
    t AS (SELECT source, sum(n) AS t FROM n GROUP BY source)
    SELECT source, term, n AS count, round(n / t, 6) AS class_share,
           round(n / (SELECT sum(n) FROM n), 6) AS corpus_share FROM n JOIN t USING (source)""",
)
def term_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = terms.shares(counted(spark, sf_dir, "source"), "source")
    return rounded(shares, "class_share", "corpus_share")


@register(
    "min_support_terms",
    f"WITH {A}, {KEPT} SELECT term, count(*) AS count FROM kept GROUP BY term HAVING count(*) >= 50",
)
def min_support_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.at_least(counted(spark, sf_dir), "count", 50)


@register(
    "allowed_vocabulary",
    f"""WITH {A}, {KEPT}, n AS (SELECT source, term, count(*) AS count FROM kept GROUP BY ALL),
    g AS (SELECT term, count(*) AS global_count FROM kept GROUP BY term HAVING count(*) >= 50)
    SELECT source, term, count, global_count FROM n JOIN g USING (term)""",
)
def allowed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.allowed_terms(counted(spark, sf_dir, "source"), "source", 50)


_LANG_COUNTS = f"{A}, {KEPT}, n AS (SELECT lang, term, count(*) AS n FROM kept GROUP BY lang, term)"
_LIFT = "SELECT lang, term, regional_count, global_count, relative_ratio FROM lift"


@register("regional_lift", f"WITH {_LANG_COUNTS}, {sql.lift('n', 'lang', 50, 20, chr(39) + 'en' + chr(39), 30)} {_LIFT}")
def regional_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted(spark, sf_dir, "lang")
    return rounded(terms.relative_lift(counts, "lang", 50, 20, "en", 30), "relative_ratio")


@register("regional_lift_all", f"WITH {_LANG_COUNTS}, {sql.lift('n', 'lang', 10, 2, None, 0)} {_LIFT}")
def regional_lift_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted(spark, sf_dir, "lang")
    return rounded(terms.relative_lift(counts, "lang", 10, 2), "relative_ratio")


_DIVERGENCE = f"""{A}, {KEPT}, n AS (SELECT source, term, count(*) AS n FROM kept GROUP BY source, term),
{sql.divergence("n", "source", 50, 1000)}"""


@register(
    "source_divergence",
    f"WITH {_DIVERGENCE} SELECT source, total_terms, vocabulary_size, kl_divergence FROM divergence",
)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted(spark, sf_dir, "source")
    return rounded(terms.vocabulary_divergence(counts, "source", 50, 1000), "kl_divergence")


# ---------------------------------------------------------------- daily volume

_ORDER_DAYS = "SELECT CAST(o_orderdate AS DATE) AS date FROM orders"
_SHIP_DAYS = "SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem"
_EVENT_DAYS = "SELECT event_type, CAST(ts AS DATE) AS date FROM events"
_PEAKS = "SELECT date, article_count, moving_average, delta, is_peak FROM peaks"


def _days(spark: SparkSession, sf_dir: str, name: str, column: str, *keys: str) -> DataFrame:
    return table(spark, sf_dir, name).select(*keys, F.to_date(column).alias("day"))


@register("daily_counts", f"SELECT date, count(*) AS article_count FROM ({_ORDER_DAYS}) GROUP BY date")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.daily_counts(_days(spark, sf_dir, "orders", "o_orderdate"), "day")


@register(
    "daily_spine",
    f"WITH {sql.peaks(_ORDER_DAYS, 7, 1.8, 5)} SELECT date, article_count FROM peaks",
)
def daily_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = series.daily_counts(_days(spark, sf_dir, "orders", "o_orderdate"), "day")
    return series.dense_daily_counts(counts)


@register(
    "moving_average",
    f"WITH {sql.peaks(_SHIP_DAYS, 14, 1.8, 5)} SELECT date, article_count, moving_average FROM peaks",
)
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = series.daily_counts(_days(spark, sf_dir, "lineitem", "l_shipdate"), "day")
    dense = series.dense_daily_counts(counts)
    return rounded(series.moving_average(dense, 14), "moving_average")


@register("daily_peaks", f"WITH {sql.peaks(_ORDER_DAYS, 7, 1.8, 5)} {_PEAKS}")
def daily_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.daily_peaks(_days(spark, sf_dir, "orders", "o_orderdate"), "day", 7, 1.8, 5)
    return rounded(found, "moving_average", "delta")


@register("daily_peaks_shipping", f"WITH {sql.peaks(_SHIP_DAYS, 7, 1.3, 3)} {_PEAKS}")
def daily_peaks_shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.daily_peaks(_days(spark, sf_dir, "lineitem", "l_shipdate"), "day", 7, 1.3, 3)
    return rounded(found, "moving_average", "delta")


@register(
    "daily_peaks_by_series",
    f"""WITH {sql.peaks(_EVENT_DAYS, 5, 1.1, 1, keys="event_type")}
    SELECT event_type, date, article_count, moving_average, delta, is_peak FROM peaks""",
)
def daily_peaks_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _days(spark, sf_dir, "events", "ts", "event_type")
    found = series.daily_peaks(days, "day", 5, 1.1, 1, keys=["event_type"])
    return rounded(found, "moving_average", "delta")


# ---------------------------------------------------------------- quality

_BROKEN = f"""{_FACT}, broken AS (
  SELECT article_id, word_count_title, CASE WHEN lang = 'fr' THEN 0 ELSE word_count_body END AS word_count_body,
         CASE WHEN source = 'src1' THEN NULL WHEN source = 'src2' THEN 9999 ELSE source_id END AS source_id,
         date_id, region_id, year, CASE WHEN lang = 'de' THEN '13' ELSE month END AS month
  FROM fact UNION ALL
  SELECT article_id, word_count_title, word_count_body, source_id, date_id, 77, year, month
  FROM fact WHERE lang = 'es')"""


def _dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    clean = articles(spark, sf_dir)
    return {
        "dim_source": dimensions.source_dimension(clean),
        "dim_date": dimensions.date_dimension(clean),
        "dim_region": dimensions.class_dimension(spark, CLASS_NAMES),
    }


_NARROW = [
    "article_id", "word_count_title", "word_count_body",
    "source_id", "date_id", "region_id", "year", "month",
]


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with one defect of every kind, derived from whole languages and sources."""
    base = fact(spark, sf_dir).join(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), "lang", "source"),
        "article_id",
    )
    damaged = base.withColumns(
        {
            "word_count_body": F.when(F.col("lang") == "fr", 0).otherwise(F.col("word_count_body")),
            "source_id": F.when(F.col("source") == "src2", 9999).when(
                F.col("source") != "src1", F.col("source_id")
            ),
            "month": F.when(F.col("lang") == "de", "13").otherwise(F.col("month")),
        }
    )
    twice = base.where("lang = 'es'").withColumn("region_id", F.lit(77))
    return damaged.select(*_NARROW).unionByName(twice.select(*_NARROW))


@register(
    "orphan_keys",
    f"""WITH {_BROKEN}
    SELECT 'source_id' AS foreign_key, CAST(source_id AS BIGINT) AS key, count(*) AS n_rows FROM broken
    WHERE source_id IS NULL OR source_id NOT IN (SELECT source_id FROM dim_source) GROUP BY source_id
    UNION ALL
    SELECT 'region_id', CAST(region_id AS BIGINT), count(*) FROM broken
    WHERE region_id NOT BETWEEN 1 AND {UNKNOWN} GROUP BY region_id""",
)
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphan_keys(_broken(spark, sf_dir), _dims(spark, sf_dir))


@register(
    "orphan_customers",
    """SELECT o_custkey, count(*) AS n_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
    GROUP BY o_custkey""",
)
def orphan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey")
    used = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_rows"))
    return joins.keys_without_match(used, known, used["o_custkey"] == known["c_custkey"])


@register(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "partition_mismatch",
    f"WITH {_BROKEN} SELECT article_id, date_id, month FROM broken WHERE month = '13'",
)
def partition_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = quality.partition_mismatch(_broken(spark, sf_dir))
    return wrong.select("article_id", "date_id", "month")


@register(
    "bad_word_counts",
    f"WITH {_BROKEN} SELECT article_id, word_count_body FROM broken WHERE word_count_body < 1",
)
def bad_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = quality.bad_word_counts(_broken(spark, sf_dir))
    return wrong.select("article_id", "word_count_body")


@register(
    "all_true",
    "SELECT bool_and(l_shipdate IS NOT NULL AND l_quantity > 0) AS all_true FROM lineitem",
)
def all_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = F.col("l_shipdate").isNotNull() & (F.col("l_quantity") > 0)
    return quality.all_true(table(spark, sf_dir, "lineitem"), fine)


_REPORT_NAMES = ("referential_integrity", "row_count", "dimension_keys_unique",
                 "partitions_match_dates", "fact_integrity")


@register(
    "validation_report",
    f"""WITH {_BROKEN}, found(c, v) AS (
      SELECT 'referential_integrity',
        (SELECT count(*) FROM broken WHERE source_id IS NULL
           OR source_id NOT IN (SELECT source_id FROM dim_source))
        + (SELECT count(*) FROM broken WHERE region_id NOT BETWEEN 1 AND {UNKNOWN})
      UNION ALL SELECT 'row_count', (SELECT count(*) FROM broken) - (SELECT count(*) FROM documents)
      UNION ALL SELECT 'dimension_keys_unique', 0
      UNION ALL SELECT 'partitions_match_dates', (SELECT count(*) FROM broken WHERE month = '13')
      UNION ALL SELECT 'fact_integrity', (SELECT count(*) FROM broken WHERE word_count_body < 1)
        + (SELECT count(*) - count(DISTINCT article_id) FROM broken))
    SELECT c AS "check", v = 0 AS passed, CAST(v AS BIGINT) AS violations FROM found""",
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = articles(spark, sf_dir)
    stored = materialize(_broken(spark, sf_dir), "broken-fact")  # as the job does: checks read a table
    return quality.validation_report(clean, stored, _dims(spark, sf_dir))


# ---------------------------------------------------------------- report tables

_MONTHLY = f"""{A}, {sql.kept_terms(stop_words=True)},
n AS (SELECT year_month, term, count(*) AS count FROM kept GROUP BY ALL),
monthly AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY count DESC, term) AS rn FROM n)
  WHERE rn <= 20)"""


@register(
    "report_global_terms",
    f"""WITH {_MONTHLY} SELECT term, CAST(sum(count) AS BIGINT) AS total FROM monthly
    GROUP BY term ORDER BY total DESC, term LIMIT 15""",
)
def report_global_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.global_terms(top_terms_monthly(spark, sf_dir), 15)


@register("report_leading_term", f"WITH {_MONTHLY} SELECT year_month, term, count FROM monthly WHERE rn = 1")
def report_leading_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.leading_terms(top_terms_monthly(spark, sf_dir))


@register(
    "report_top_divergent",
    f"""WITH {_DIVERGENCE}, {sql.sources()}
    SELECT source AS source_name, kl_divergence
    FROM divergence JOIN dim_source ON source = source_name
    ORDER BY kl_divergence DESC, source_id LIMIT 7""",
)
def report_top_divergent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = source_divergence(spark, sf_dir)
    ids = dimensions.source_dimension(articles(spark, sf_dir))
    named = joins.lookup(found, ids, "source", "source_name", "source")
    return report.divergent_sources(named.withColumnRenamed("source", "source_name"), 7)


@register("report_peaks", f"WITH {sql.peaks(_ORDER_DAYS, 7, 1.8, 5)} {_PEAKS} WHERE is_peak")
def report_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.peaks_only(daily_peaks(spark, sf_dir))


_REGION_COUNTS = f"""{A}, {KEPT}, {sql.voted(MARKERS_APART, UNKNOWN)},
n AS (SELECT region_id, term, count(*) AS n FROM kept JOIN voted USING (article_id) GROUP BY ALL),
{sql.lift("n", "region_id", 50, 20, str(UNKNOWN), 30)}, names(region_key, region_name) AS (VALUES {_NAMES})"""


@register(
    "report_regional_terms",
    f"""WITH {_REGION_COUNTS}, r AS (
      SELECT *, row_number() OVER (PARTITION BY region_name
               ORDER BY regional_count DESC, ratio DESC, term) AS rn2
      FROM (SELECT * FROM ranked_lift WHERE rn <= 30) JOIN names ON region_id = region_key
      WHERE region_name IN ('Aleman/Suizo', 'Frances'))
    SELECT region_name, replace(replace(lower(region_name), ' ', '_'), '/', '_') AS region_slug, term,
           round(ratio, 6) AS relative_ratio, regional_count FROM r WHERE rn2 <= 10""",
)
def report_regional_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.term_counts(fact(spark, sf_dir), ["region_id"], rules=NO_STOP_WORDS)
    regional = terms.relative_lift(counts, "region_id", 50, 20, UNKNOWN, 30)
    names = dimensions.class_dimension(spark, CLASS_NAMES)
    named = joins.add_names(
        regional, names, "region_id", "region_key", "region_name", "region_name", "term"
    )
    chosen = report.distinctive_terms(named, ["Aleman/Suizo", "Frances"], 10)
    return rounded(chosen, "relative_ratio")


# ---------------------------------------------------------------- jobs


def _built(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "warehouse")
    build_warehouse(spark, articles(spark, sf_dir).drop("lang"), path, WAREHOUSE)
    return path


@register("warehouse_job", f"WITH {_FACT} {_FACT_SELECT}")
def warehouse_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_columns(warehouse.scan_fact(spark, _built(spark, sf_dir), facts.FACT_COLUMNS))


@register(
    "warehouse_job_from_csv",
    f"WITH {_CLEAN}, {sql.fact_of('clean', MARKERS_APART, UNKNOWN)} {_FACT_SELECT}",
)
def warehouse_job_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warehouse")
    build_warehouse(spark, _write_article_csv(spark, sf_dir), path, WAREHOUSE)
    return _fact_columns(warehouse.scan_fact(spark, path, facts.FACT_COLUMNS))


@register(
    "warehouse_job_report",
    "SELECT c AS \"check\", true AS passed, CAST(0 AS BIGINT) AS violations FROM (VALUES "
    + ", ".join(f"('{n}')" for n in _REPORT_NAMES)
    + ") AS t(c)",
)
def warehouse_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_built(spark, sf_dir)}/validation_report")


@register(
    "warehouse_job_violations",
    f"""WITH {_FACT}, orphans AS (SELECT count(*) AS n FROM fact WHERE region_id IN (4, 5))
    SELECT c AS "check", c <> 'referential_integrity' OR n = 0 AS passed,
           CAST(CASE c WHEN 'referential_integrity' THEN n ELSE 0 END AS BIGINT) AS violations
    FROM orphans, (VALUES {", ".join(f"('{n}')" for n in _REPORT_NAMES)}) AS t(c)""",
)
def warehouse_job_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a build whose class dimension lacks two classes that the articles have."""
    config = replace(WAREHOUSE, class_names=CLASS_NAMES[:3])
    return build_warehouse(spark, articles(spark, sf_dir).drop("lang"), scratch_path(spark, "warehouse"), config)


_JOB = f"""{_FACT}, {sql.kept_terms(stop_words=True, source="fact")},
base AS (SELECT k.year_month, f.region_id, f.source_id, k.term, count(*) AS n
         FROM kept k JOIN fact f USING (article_id) GROUP BY ALL),
monthly AS (SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY n DESC, term) AS rn FROM (
  SELECT year_month, term, sum(n) AS n FROM base GROUP BY ALL)),
by_region AS (SELECT region_id, term, sum(n) AS n FROM base GROUP BY ALL),
{sql.lift("by_region", "region_id", 50, 20, str(UNKNOWN), 30)},
by_source AS (SELECT source_id, term, sum(n) AS n FROM base GROUP BY ALL),
{sql.divergence("by_source", "source_id", 50, 1000)},
{sql.peaks("SELECT publish_date AS date FROM fact", 7, 1.2, 0.5)},
names(region_key, region_name) AS (VALUES {_NAMES})"""


def _tagged(result: str, df: DataFrame, group: str, item: str, n: str, x=None, y=None) -> DataFrame:
    x, y = (F.lit(None).cast("double") if c is None else F.round(F.col(c).cast("double"), 6) for c in (x, y))
    return df.select(
        F.lit(result).alias("result"),
        F.col(group).cast("string").alias("group_key"),
        F.col(item).cast("string").alias("item"),
        F.col(n).cast("long").alias("n"),
        x.alias("x"),
        y.alias("y"),
    )


@register(
    "analytics_job",
    f"""WITH {_JOB}
    SELECT 'monthly' AS result, year_month AS group_key, term AS item, CAST(n AS BIGINT) AS n,
           CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y FROM monthly WHERE rn <= 20
    UNION ALL SELECT 'regional', region_name, term, regional_count, relative_ratio, global_count
    FROM lift JOIN names ON region_id = region_key
    UNION ALL SELECT 'divergence', source_name, CAST(vocabulary_size AS VARCHAR), total_terms, kl_divergence, NULL
    FROM divergence JOIN dim_source USING (source_id)
    UNION ALL SELECT 'peaks', CAST(date AS VARCHAR), CAST(is_peak AS VARCHAR), article_count, moving_average, delta
    FROM peaks""",
)
def analytics_job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "results")
    found = analytics_job.run_analytics(spark, _built(spark, sf_dir), out, ANALYTICS)
    monthly, regional, divergence, peaks = (found[n] for n in results.SCHEMAS)
    parts = [
        _tagged("monthly", monthly, "year_month", "term", "count"),
        _tagged("regional", regional, "region_name", "term", "regional_count", "relative_ratio", "global_count"),
        _tagged("divergence", divergence, "source_name", "vocabulary_size", "total_terms", "kl_divergence"),
        _tagged("peaks", peaks, "date", "is_peak", "article_count", "moving_average", "delta"),
    ]
    return reduce(DataFrame.unionAll, parts)


@register(
    "report_job",
    f"""WITH {_JOB}, top AS (SELECT * FROM monthly WHERE rn <= 20),
    t AS (SELECT term, sum(n) AS total FROM top GROUP BY term ORDER BY total DESC, term LIMIT 15)
    SELECT 'global' AS result, term AS group_key, term AS item, CAST(total AS BIGINT) AS n,
           CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y FROM t
    UNION ALL SELECT 'leading', year_month, term, CAST(n AS BIGINT), NULL, NULL FROM top WHERE rn = 1
    UNION ALL SELECT * FROM (
      SELECT 'divergent', source_name, source_name, CAST(NULL AS BIGINT), kl_divergence, NULL
      FROM divergence JOIN dim_source USING (source_id) ORDER BY kl_divergence DESC, source_id LIMIT 15)
    UNION ALL SELECT 'series', CAST(date AS VARCHAR), CAST(is_peak AS VARCHAR), article_count, moving_average, delta
    FROM peaks
    UNION ALL SELECT 'peaks', CAST(date AS VARCHAR), 'true', article_count, moving_average, delta
    FROM peaks WHERE is_peak
    UNION ALL SELECT 'regional', region_name, term, regional_count, round(ratio, 6), NULL FROM (
      SELECT *, row_number() OVER (PARTITION BY region_name ORDER BY regional_count DESC, ratio DESC, term) AS rn2
      FROM (SELECT * FROM ranked_lift WHERE rn <= 30) JOIN names ON region_id = region_key
      WHERE region_name IN ('Espanol', 'Frances')) WHERE rn2 <= 10""",
)
def report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tintero.config import ReportConfig

    out = scratch_path(spark, "results")
    analytics_job.run_analytics(spark, _built(spark, sf_dir), out, ANALYTICS)
    frames = build_reports(spark, out, ReportConfig(regions=("Espanol", "Frances")))
    divergent = frames["divergent_sources"].withColumn("no_count", F.lit(None))
    parts = [
        _tagged("global", frames["global_top_terms"], "term", "term", "total"),
        _tagged("leading", frames["monthly_leading_terms"], "year_month", "term", "count"),
        _tagged("divergent", divergent, "source_name", "source_name", "no_count", "kl_divergence"),
        _tagged("series", frames["daily_series"], "date", "is_peak", "article_count", "moving_average", "delta"),
        _tagged("peaks", frames["peak_days"], "date", "is_peak", "article_count", "moving_average", "delta"),
        _tagged("regional", frames["regional_terms"], "region_name", "term", "regional_count", "relative_ratio"),
    ]
    return reduce(DataFrame.unionAll, parts)


# ---------------------------------------------------------------- snapshots

#: the copies and the chat turns arrive after the first versions
_SECOND_BATCH = 1_000_000_000_000


def _in_batches(spark: SparkSession, sf_dir: str) -> str:
    raw = raw_articles(spark, sf_dir)
    path = scratch_path(spark, "snapshots")
    for batch in (raw.where(F.col("ingest_seq") < _SECOND_BATCH), raw.where(F.col("ingest_seq") >= _SECOND_BATCH)):
        incremental.append_articles(spark, materialize(batch, "batch"), path, WAREHOUSE)
    return path


@register(
    "fact_in_two_batches",
    f"""WITH {_CLEAN} SELECT article_id, md5(title) AS title_md5, md5(body) AS body_md5, source AS source_name,
    CAST(strftime(publish_date, '%Y%m%d') AS INTEGER) AS date_id, CAST(year(publish_date) AS INTEGER) AS year,
    strftime(publish_date, '%m') AS month FROM clean""",
)
def fact_in_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = snapshots.current(spark, _in_batches(spark, sf_dir))
    found = snapshots.read_months(spark, snapshot, warehouse.FACT, warehouse.FACT_SCHEMA)
    named = found.join(snapshots.read_table(spark, snapshot, "dim_source"), "source_id")
    return named.select(
        "article_id", F.md5("title").alias("title_md5"), F.md5("body").alias("body_md5"), "source_name", "date_id", "year", "month"
    )


@register(
    "stable_source_ids",
    f"""WITH {_CLEAN}, firsts AS (SELECT coalesce(source, 'fuente desconocida') AS source_name, ingest_seq, article_id FROM raw_articles
      WHERE try_cast(publish_date AS DATE) IS NOT NULL AND ingest_seq < {_SECOND_BATCH}),
    a AS (SELECT source_name, row_number() OVER (ORDER BY min(ingest_seq), source_name) AS source_id FROM firsts GROUP BY source_name),
    b AS (SELECT source AS source_name, min(ingest_seq) AS s FROM clean WHERE ingest_seq >= {_SECOND_BATCH}
      AND source NOT IN (SELECT source_name FROM a) GROUP BY source)
    SELECT source_name, source_id FROM a UNION ALL
    SELECT source_name, (SELECT max(source_id) FROM a) + row_number() OVER (ORDER BY s, source_name) FROM b""",
)
def stable_source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = snapshots.current(spark, _in_batches(spark, sf_dir))
    return snapshots.read_table(spark, snapshot, "dim_source").select("source_name", "source_id")
