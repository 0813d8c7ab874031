"""Properties of the physical plans that the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from tintero.functions import dates
from tintero.operators import cleaning, series, terms
from tintero.operators.fact import assemble_fact
from tintero.plans import analytics
from tintero.session import scratch_path, spread_small
from tintero.sources import warehouse


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "plan-fact")
    fact = spark.range(200).select(
        F.col("id").alias("article_id"),
        F.concat(F.lit("título "), F.col("id")).alias("title"),
        F.lit("gobierno ciudad").alias("body"),
        (20230101 + F.col("id") % 28).cast("int").alias("date_id"),
        (F.col("id") % 3).alias("source_id"),
        (F.col("id") % 2 + 16).cast("int").alias("region_id"),
        F.lit(2023).alias("year"),
        F.lit("01").alias("month"),
    )
    warehouse.write_fact(fact, path)
    return warehouse.scan_fact(spark, path)


def executed(df):
    """The plan as run, without the initial plans that adaptive execution also prints."""
    df.collect()
    kept, skip_right_of = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        node = re.match(r"([ :]*)[+:]- ", line)  # other lines go on with a line break in a literal
        start = node.end(1) if node else 10**6
        if skip_right_of is not None and start > skip_right_of:
            continue
        skip_right_of = start if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


def text_scans(plan):
    return sum("ReadSchema: struct<" in p and "body:string" in p.split("ReadSchema")[1][:200] for p in plan.split("FileScan")[1:])


def test_daily_counts_read_no_text(stored):
    plan = executed(series.peaks_of_counts(series.counts_of_day_keys(stored), 7, 1.8, 50.0))
    assert "ReadSchema: struct<date_id:int>" in plan and "body" not in plan


def test_top_terms_cut_before_the_shuffle(stored):
    counts = terms.term_counts(stored, [F.col("month").alias("year_month")])
    plan = executed(terms.top_terms(counts, 3))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits) and any("Final" in line for line in limits)
    assert text_scans(plan) == 1


@pytest.mark.parametrize("excluded", [None, 17])
def test_lift_reads_stored_counts_and_no_text_again(stored, excluded):
    counts = terms.term_counts(stored, ["region_id"])
    plan = executed(terms.relative_lift(counts, "region_id", 1, 1, excluded, 5))
    assert text_scans(plan) == 0 and "SortMergeJoin" not in plan and "Cross" not in plan
    assert "FileScan" in plan and "hashpartitioning(term" not in plan


def test_divergence_reads_stored_counts_and_no_text_again(stored):
    counts = terms.term_counts(stored, ["source_id"])
    plan = executed(terms.vocabulary_divergence(counts, "source_id", 1, 1))
    assert text_scans(plan) == 0 and "FileScan" in plan and "hashpartitioning(term" not in plan


def test_no_exchange_hashes_counts_by_class_alone(spark, stored):
    counts = terms.term_counts(stored, ["source_id"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        broadcast = executed(terms.shares(counts, "source_id"))
        salted = executed(terms.shares(counts, "source_id", 0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in broadcast
    assert "_salt" in salted and not re.search(r"hashpartitioning\(\w+#\d+L?, \d+\)", salted)


def test_large_vocabulary_is_joined_after_the_recount_by_salted_term(spark, stored):
    finer = terms.term_counts(stored, ["region_id", "source_id"])
    words = terms.frequent_vocabulary(finer, 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(terms.within_vocabulary(finer, words, "source_id", 0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan.index("SortMergeJoin")
    assert "HashAggregate" not in plan[:join] and re.search(r"hashpartitioning\(term#\d+, _salt#\d+", plan)


def test_counting_is_compiled_and_has_no_python(stored):
    plan = executed(terms.term_counts(stored, ["region_id"]))
    generate = next(line for line in plan.splitlines() if "Generate explode" in line)
    assert "*(" in generate and "Python" not in plan and "Arrow" not in plan


def test_keys_are_computed_per_article_not_per_term(stored):
    when = dates.month_of(F.col("date_id")).alias("year_month")
    plan = executed(terms.term_counts(stored, [when]))
    below = plan[plan.index("Generate explode") :]
    assert "format_string" in below and "format_string" not in plan[: plan.index("Generate explode")]


def test_fold_is_computed_once_per_text(spark, stored):
    clean = stored.select(
        "article_id", "title", "body", F.lit("emol").alias("source"),
        F.lit("2023-01-01").cast("date").alias("publish_date"),
    )
    sources = spark.createDataFrame([("emol", 1)], "source_name string, source_id bigint")
    plan = executed(assemble_fact(clean, sources, {1: ["ciudad"], 2: ["puerto montt"]}, 9))
    assert plan.count("translate(") == 2 and "Exchange hashpartitioning" not in plan


def test_keep_last_narrow_does_not_shuffle_text(spark, stored):
    pairs = F.col("article_id") - F.col("article_id") % 2
    raw = stored.select(pairs.alias("id"), "title", "body", F.col("article_id").alias("ingest_seq"))
    plan = executed(cleaning.keep_last_narrow(raw, "id", "ingest_seq"))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles == [] and text_scans(plan) == 1
    assert "LeftAnti, BuildRight" in plan


def test_partition_filters(stored):
    plan = executed(stored.where("year = 2023 AND month = '01'").select("article_id"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "month" in filters


def test_only_small_scans_are_spread(spark, stored):
    assert "RoundRobin" not in executed(spread_small(stored, "article_id"))
    assert spread_small(stored, "article_id").rdd.getNumPartitions() == 8
    many = spark.range(0, 1000, 1, 50)
    assert spread_small(many, "id") is many


def test_pattern_is_applied_inside_generate_once(stored):
    plan = executed(terms.explode_terms(stored, ["region_id"]))
    assert plan.count("regexp_extract_all") == 2  # the terms, and the pieces of rare characters


def test_a_task_of_the_counts_meets_few_months_and_sources(spark):
    fact = spark.range(4000).select(
        F.col("id").alias("article_id"),
        F.repeat(F.lit("gobierno "), 20).alias("title"),
        F.when(F.col("id") % 5 > 0, 20230101 + 100 * (F.col("id") % 4)).cast("int").alias("date_id"),
        (F.col("id") * 7 % 8).alias("source_id"),
        F.lit(1).alias("region_id"),
    )
    dealt = analytics.dealt_for_counts(fact)
    groups = dealt.select(F.spark_partition_id().alias("p"), dates.month_key(F.col("date_id")).alias("m"), "source_id")
    rows = [r["n"] for r in groups.groupBy("p").agg(F.count("*").alias("n")).collect()]
    assert groups.count() == 4000 and max(rows) < 4000 / 2 and groups.distinct().count() < 3 * groups.select("m", "source_id").distinct().count()


def test_divergence_is_aggregated_once(stored):
    counts = terms.term_counts(stored, ["source_id"])
    assert "HashAggregate(keys=[source_id" not in executed(terms.vocabulary_divergence(counts, "source_id", 1, 1))
