"""Work that must not grow with the input: per task, per row, per mention of a column."""

from frames import rows
from pyspark.sql import functions as F

from tintero import session
from tintero.operators import alias_table, terms
from tintero.operators.classify import vote
from tintero.plans.warehouse import build_warehouse
from tintero.sources import articles as files
from tintero.sources import warehouse
from tintero_checks import queries
from tintero_checks.adapters import MARKERS_APART, UNKNOWN, WAREHOUSE


def tables(spark, path, n=60):
    text = F.concat(F.lit("titulo uno\n"), F.repeat(F.lit('the "quoted", of\n'), 40), F.col("id").cast("string"))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    turns = [(1, 0, "user", "hi\nyou"), (1, 1, "assistant", None)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return str(path)


def test_csv_files_grow_in_number_and_not_in_size(spark, tmp_path):
    path = tables(spark, tmp_path)
    few, many = (queries._write_article_csv(spark, path, file_bytes=b) for b in (1 << 30, 2000))
    assert len(spark.read.text(few).inputFiles()) == 4
    assert len(spark.read.text(many).inputFiles()) > 15
    read = [rows(queries._with_position(files.read_article_csv(spark, p))) for p in (few, many)]
    assert read[0] == read[1] and len(read[0]) == 64


def test_the_csv_job_reads_files_in_splits(spark, tmp_path):
    path = queries._write_article_csv(spark, tables(spark, tmp_path), file_bytes=1 << 30)
    facts = []
    for split in (False, True):
        build_warehouse(spark, path, f"{tmp_path}/wh{split}", WAREHOUSE, split_files=split)
        facts.append(rows(warehouse.scan_fact(spark, f"{tmp_path}/wh{split}")))
    assert facts[0] == facts[1] and len(facts[0]) == 60


def test_tasks_follow_the_bytes_of_text(spark):
    texts = spark.range(200).select("id", F.repeat(F.lit("ñ"), 50).alias("a"), F.when(F.col("id") > 5, "x").alias("b"))
    assert session.text_bytes(texts) == 200 * 100 + 194
    assert session.text_bytes(texts.limit(0)) == 0
    dealt = session.spread_by_bytes(texts, "id", 1000)
    assert dealt.rdd.getNumPartitions() == 21
    assert rows(dealt) == rows(texts)
    assert session.spread_by_bytes(texts, "id").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_counts_by_article_are_made_in_tasks_of_bounded_text(spark, tmp_path, monkeypatch):
    path = tables(spark, tmp_path)
    found = rows(queries.term_rules(spark, path))
    bound = session.spread_by_bytes.__kwdefaults__ or session.spread_by_bytes.__defaults__
    assert bound == (session.TASK_BYTES,)
    monkeypatch.setattr(session.spread_by_bytes, "__defaults__", (2000,))
    small = queries.term_rules(spark, path)
    assert "REPARTITION_BY_NUM" in small._jdf.queryExecution().executedPlan().toString()
    assert small.rdd.getNumPartitions() > 15 and rows(small) == found


def test_a_filter_by_class_does_not_repeat_the_search(spark):
    texts = spark.createDataFrame([(1, "the end", "of it"), (2, "nada", "que en"), (3, "x", "y")], "id long, title string, body string")
    voted = vote(texts, MARKERS_APART, UNKNOWN, "title", "body")

    def searches(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")

    counts = terms.term_counts(voted, ["region_id"])
    assert searches(terms.exclude_class(counts, "region_id", UNKNOWN)) == searches(counts)
    assert rows(terms.exclude_class(voted, "region_id", UNKNOWN).select("id", "region_id")) == [(1, 1), (2, 2)]
    assert rows(voted.select("id", "region_id"))[-1] == (3, UNKNOWN)


def test_word_grams_carry_no_list_of_the_text(spark):
    aliases = spark.createDataFrame([(1, "de la", 0), (2, "la", 0), (2, "año_1", 1)], "class_id int, alias string, place int")
    texts = [(1, "De la", "la  de la, de la"), (2, "", None), (3, "¡año_1!", "\U0001d7d8la x"), (4, None, "...")]
    df = spark.createDataFrame(texts, "article_id long, t string, b string")
    hits = alias_table.alias_hits(df, "article_id", {"t": 1, "b": 0}, alias_table.prepared_aliases(aliases, 9))
    assert "posexplode" not in hits._jdf.queryExecution().optimizedPlan().toString()
    found = rows(hits.select("_key", "field", "class_id", "at", "pieces"))
    assert found == [
        (1, 0, 1, 2, 3), (1, 0, 1, 6, 3), (1, 0, 2, 0, 1), (1, 0, 2, 4, 1), (1, 0, 2, 8, 1), (1, 1, 2, 2, 1), (3, 1, 2, 1, 1),
    ]
