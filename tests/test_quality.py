import pytest
from frames import rows
from pyspark.sql import functions as F

from tintero.operators import quality

FACT = (
    "article_id bigint, word_count_title bigint, word_count_body bigint, "
    "date_id int, source_id bigint, region_id int, year int, month string"
)
GOOD = [(1, 2, 3, 20230105, 1, 7, 2023, "01"), (2, 1, 1, 20231231, 2, 17, 2023, "12")]


@pytest.fixture
def dims(spark):
    return {
        "dim_source": spark.createDataFrame([(1,), (2,)], "source_id bigint"),
        "dim_date": spark.createDataFrame([(20230105,), (20231231,)], "date_id int"),
        "dim_region": spark.createDataFrame([(7,), (17,)], "region_key int"),
    }


def failures(spark, fact_rows, dims, n_clean=None):
    fact = spark.createDataFrame(fact_rows, FACT)
    clean = spark.range(len(fact_rows) if n_clean is None else n_clean)
    report = quality.validation_report(clean, fact, dims).collect()
    assert len(report) == 5 and all(r["passed"] == (r["violations"] == 0) for r in report)
    return {r["check"]: r["violations"] for r in report if not r["passed"]}


def test_clean_fact_passes(spark, dims):
    assert failures(spark, GOOD, dims) == {}


def test_empty_fact_passes(spark, dims):
    assert failures(spark, [], dims) == {}


@pytest.mark.parametrize(
    "bad, want",
    [
        ((3, 1, 1, 20230105, 9, 7, 2023, "01"), {"referential_integrity": 1}),
        ((3, 1, 1, 20230105, None, 7, 2023, "01"), {"referential_integrity": 1}),
        ((3, 1, 1, 20230105, 1, 5, 2023, "01"), {"referential_integrity": 1}),
        ((3, 1, 1, 20230105, 1, 7, 2023, "02"), {"partitions_match_dates": 1}),
        ((3, 1, 1, 20230105, 1, 7, 2022, "01"), {"partitions_match_dates": 1}),
        ((3, 0, 1, 20230105, 1, 7, 2023, "01"), {"fact_integrity": 1}),
        ((1, 1, 1, 20230105, 1, 7, 2023, "01"), {"fact_integrity": 1}),
        ((3, 1, 1, None, 1, 7, 2023, "01"), {"referential_integrity": 1, "partitions_match_dates": 1}),
    ],
)
def test_each_defect_is_found(spark, dims, bad, want):
    assert failures(spark, [*GOOD, bad], dims) == want


def test_row_count_and_duplicate_dimension_key(spark, dims):
    assert failures(spark, GOOD, dims, n_clean=5) == {"row_count": 3}
    dims["dim_source"] = spark.createDataFrame([(1,), (2,), (2,)], "source_id bigint")
    assert failures(spark, GOOD, dims) == {"dimension_keys_unique": 1}


def test_null_keys_and_no_dimension_rows(spark, dims):
    dims["dim_source"] = spark.createDataFrame([(1,), (2,), (None,)], "source_id bigint")
    row = (3, 1, 1, 20230105, None, 7, 2023, "01")
    assert failures(spark, [*GOOD, row, row], dims) == {"referential_integrity": 2, "fact_integrity": 1}
    dims["dim_region"] = dims["dim_region"].where("false")
    assert failures(spark, GOOD, dims) == {"referential_integrity": 2}


def test_report_equals_the_single_checks_and_scans_the_fact_once(spark, dims, tmp_path):
    table = [*GOOD, GOOD[0], (4, 0, None, 20230105, 9, None, 2023, "02"), (None, 1, 1, None, 1, 7, 2023, "01")]
    path = str(tmp_path / "fact")
    spark.createDataFrame(table, FACT).write.parquet(path)
    fact, clean = spark.read.parquet(path), spark.range(9)
    report = quality.validation_report(clean, fact, dims)
    found = {r["check"]: r["violations"] for r in report.collect()}
    assert found["referential_integrity"] == sum(r["n_rows"] for r in quality.orphan_keys(fact, dims).collect())
    assert found["row_count"] == quality.row_count_check(clean, fact).first()["violations"]
    assert found["partitions_match_dates"] == quality.partition_mismatch(fact).count()
    assert found["fact_integrity"] == quality.fact_integrity_check(fact).first()["violations"]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan


def test_all_true(spark):
    numbers = spark.createDataFrame([(1,), (2,)], "n int")
    assert rows(quality.all_true(numbers, F.col("n") > 0)) == [(True,)]
    assert rows(quality.all_true(numbers, F.col("n") > 1)) == [(False,)]
    assert rows(quality.all_true(numbers.where("false"), F.col("n") > 1)) == [(True,)]
    with_null = numbers.union(spark.createDataFrame([(None,)], "n int"))
    assert rows(quality.all_true(with_null, F.col("n") > 0)) == [(False,)]
