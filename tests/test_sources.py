import csv
import io
import random

import pandas as pd
import pytest
from frames import rows
from pyspark.sql import functions as F

from tintero import lexicon
from tintero.session import materialize, shared_folder
from tintero.sources import articles as files
from tintero.sources import results, split_csv, warehouse

HEADER = ["article_id", "title", "extra", "body", "source", "publish_date"]
LINES = [
    ["1", 'dice "hola", y', "e", "uno\ndos\n\ntres", "emol", "2023-01-05"],
    ["2", "NA", "e", "null", "", "2023-01-06"],
    ["3", " NA ", "e", "n/a ", "None", "nope"],
    ["", "sin id", "e", "a,b", "x", "2023-01-07"],
    ["5", "ñandú\r\nx", "e", '"', "y", ""],
]


def write(path, lines, header=HEADER, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        out.writerows(lines)


def as_pandas_reads(path):
    frame = pd.read_csv(path, dtype=str)
    frame = frame[list(files.ARTICLE_COLUMNS)].astype(object).where(frame.notna(), None)
    return [tuple(r) for r in frame.itertuples(index=False)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_is_read_as_pandas_reads_it(spark, tmp_path, end):
    write(tmp_path / "a.csv", LINES, end=end)
    got = files.read_article_csv(spark, str(tmp_path / "a.csv"), id_type="string").orderBy("ingest_seq")
    want = as_pandas_reads(tmp_path / "a.csv")
    if end == "\r\n":
        want = [tuple(v and v.replace("\r\n", "\n") for v in r) for r in want]
    assert [tuple(r)[:-1] for r in got.collect()] == want


@pytest.mark.parametrize("token", lexicon.NA_TOKENS)
def test_every_missing_marker(spark, tmp_path, token):
    if token not in ("", "NA", "null", "#N/A", "-1.#IND"):
        assert token in set(pd._libs.parsers.STR_NA_VALUES)
        return
    write(tmp_path / "m.csv", [["1", token, "e", "b", "s", "2023-01-01"]])
    assert files.read_article_csv(spark, str(tmp_path / "m.csv")).first()["title"] is None


def test_sequence_follows_file_name_then_row(spark, tmp_path):
    folder = tmp_path / "with space"
    folder.mkdir()
    for name, n, first in (("b.csv", 3, 100), ("a.csv", 400, 0), ("c.csv", 50, 200)):
        write(folder / name, [[first + i, "t", "e", "b\n" * 9, "s", "2023-01-01"] for i in range(n)])
    landed = files.land_articles(
        files.read_article_csv(spark, str(folder)), f"{shared_folder(spark)}/landed"
    )
    got = [r["article_id"] for r in landed.orderBy("ingest_seq").collect()]
    assert got == [*range(400), 100, 101, 102, *range(200, 250)]
    assert landed.select("ingest_seq").distinct().count() == 453


@pytest.fixture
def tiny_splits(spark):
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_files_give_the_same_articles(spark, tmp_path, tiny_splits, end):
    random.seed(8)
    bits = ["a", '"', ",", "\n", "\n\n", "é", " ", "long " * 30, '""', "x\ny"]

    def field(n):
        return "".join(random.choices(bits, k=random.randrange(n)))

    for name in ("b.csv", "a.csv"):
        lines = [[i, field(5), "e", field(40), field(4), "2023-01-05"] for i in range(120)]
        lines[50][3] = '"quoted"\n' * 200  # one record over many splits
        write(tmp_path / name, lines, end=end)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    read = [files.read_article_csv(spark, str(tmp_path), split_files=s) for s in (False, True)]
    whole, split = [[tuple(r) for r in df.orderBy("ingest_seq").collect()] for df in read]
    assert [r[:-1] for r in split] == [r[:-1] for r in whole]
    want = as_pandas_reads(tmp_path / "a.csv") + as_pandas_reads(tmp_path / "b.csv")
    assert [(str(r[0]), *r[1:-1]) for r in split] == want


LINE_ENDS_INSIDE = [
    ["1", "a\r\nb", "e", "one\r\n\r\ntwo\nthree", "s", "2023-01-05"],
    ["2", "\r\n", "e", 'say "x"\r\n', "s\r\n", "2023-01-06"],
    *[[str(i), "t", "e", "long\r\n" * i, "s", "2023\r\n"] for i in range(3, 90)],
]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("how", [{"split_files": True}, {"line_end": None}])
def test_line_ends_inside_fields_are_kept(spark, tmp_path, tiny_splits, end, how):
    write(tmp_path / "a.csv", LINE_ENDS_INSIDE, end=end)
    how = {"line_end": end} if "line_end" in how else how
    got = files.read_article_csv(spark, str(tmp_path / "a.csv"), id_type="string", **how).orderBy("ingest_seq")
    want = [tuple(r[:2] + r[3:]) for r in LINE_ENDS_INSIDE]
    assert [tuple(r)[:-1] for r in got.collect()] == want


@pytest.mark.parametrize("limit", [split_csv.BROADCAST_BYTES, 0])
def test_records_of_split_files_are_whole(spark, tmp_path, tiny_splits, limit):
    random.seed(11)
    written = {}
    for name in ("a.csv", "b.csv", "empty.csv"):
        lines = [[str(i), random.choice(["x", "\n" * 400, '"', "a\r\nb" * 30])] for i in range(60 * (name != "empty.csv"))]
        write(tmp_path / name, lines, ["id", "text"])
        written[name] = lines
    found = split_csv.csv_records(spark, str(tmp_path), ["id", "text"], limit)
    for name, lines in written.items():
        texts = [r["text"] for r in found.where(F.col("file").endswith(name)).orderBy("position").collect()]
        assert list(csv.reader(io.StringIO("\n".join(texts), newline=""))) == lines


def test_only_cut_records_are_moved(spark, tmp_path):
    write(tmp_path / "a.csv", LINES)
    lines = split_csv._lines(spark, str(tmp_path))
    plan = split_csv._pieces(lines)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan
    assert split_csv._pieces(lines).where("cut").count() == 0


@pytest.mark.parametrize("split", [False, True])
def test_a_file_with_another_header_is_an_error(spark, tmp_path, split):
    write(tmp_path / "a.csv", LINES[:1])
    write(tmp_path / "b.csv", LINES[:1])
    assert files.read_article_csv(spark, str(tmp_path), split_files=split).count() == 2
    text = (tmp_path / "b.csv").read_text()
    header, rest = text.split("\n", 1)
    names = header.split(",")
    names[1], names[3] = names[3], names[1]
    (tmp_path / "b.csv").write_text(",".join(names) + "\n" + rest)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_article_csv(spark, str(tmp_path), split_files=split).collect()


def test_malformed_id_fails_instead_of_vanishing(spark, tmp_path):
    write(tmp_path / "bad.csv", [["x1", "t", "e", "b", "s", "2023-01-01"]])
    with pytest.raises(Exception, match="not a bigint: x1"):
        files.read_article_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_fact_roundtrip_replaces_months_and_prunes(spark):
    path = f"{shared_folder(spark)}/wh"
    fact = spark.createDataFrame(
        [(1, 2023, "01"), (2, 2023, "02"), (3, 2024, "02")], "article_id bigint, year int, month string"
    )
    warehouse.write_fact(fact, path)
    changed = fact.where("article_id = 2").selectExpr("article_id + 10 AS article_id", "year", "month")
    warehouse.write_fact(changed, path, only_own_partitions=True)
    assert rows(warehouse.scan_fact(spark, path)) == [(1, 2023, "01"), (12, 2023, "02"), (3, 2024, "02")]
    assert warehouse.scan_fact(spark, path, ["article_id", "nothing"]).columns == ["article_id"]
    plan = warehouse.scan_fact(spark, path).where("year = 2023 AND month = '02'")
    assert "article_id" in plan.columns and len(plan.collect()) == 1
    warehouse.write_fact(fact.where("article_id = 1"), path)
    assert rows(warehouse.scan_fact(spark, path)) == [(1, 2023, "01")]


def test_declared_columns_missing_in_some_files_are_null_there(spark):
    path = f"{shared_folder(spark)}/mixed"
    titles = spark.createDataFrame([(1, "t", 2023, "01")], "article_id bigint, title string, year int, month string")
    bodies = spark.createDataFrame([(2, "b", 2023, "02")], "article_id bigint, body string, year int, month string")
    warehouse.write_fact(titles, path)
    warehouse.write_fact(bodies, path, only_own_partitions=True)
    found = warehouse.scan_fact(spark, path, ["article_id", "title", "body", "month"], schema=warehouse.FACT_SCHEMA)
    assert rows(found) == [(1, "t", None, "01"), (2, None, "b", "02")]


def test_columns_of_all_files_are_found_without_a_schema(spark):
    path = f"{shared_folder(spark)}/differing"
    titles = spark.createDataFrame([(1, "t", 2023, "01")], "article_id bigint, title string, year int, month string")
    bodies = spark.createDataFrame([(2, "b", 2023, "02")], "article_id bigint, body string, year int, month string")
    warehouse.write_fact(titles, path)
    warehouse.write_fact(bodies, path, only_own_partitions=True)
    found = warehouse.scan_fact(spark, path, ["article_id", "title", "body", "month"], files_differ=True)
    assert rows(found) == [(1, "t", None, "01"), (2, None, "b", "02")]
    other = spark.createDataFrame([("x", 2023, "03")], "article_id string, year int, month string")
    warehouse.write_fact(other, path, only_own_partitions=True)
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        warehouse.scan_fact(spark, path, files_differ=True)


def test_missing_fact_is_an_error_and_missing_dimension_is_empty(spark):
    path = f"{shared_folder(spark)}/nowhere"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.scan_fact(spark, path)
    empty = warehouse.read_dimension(spark, path, "dim_x", "k", "v")
    assert empty.columns == ["k", "v"] and empty.count() == 0


def test_last_duplicate_of_a_dimension_key_wins(spark):
    path = f"{shared_folder(spark)}/dups"
    dim = spark.createDataFrame([(1, "old"), (2, "b"), (1, "new")], "k bigint, v string").coalesce(1)
    warehouse.write_dimension(dim, path, "dim_d")
    assert rows(warehouse.read_dimension(spark, path, "dim_d", "k", "v")) == [(1, "new"), (2, "b")]


def test_result_files_keep_order_types_and_odd_text(spark):
    schema = "name string, n bigint, x double, ok boolean"
    data = [('a "q", b', 2, 0.1, True), (" padded ", 3, 1e-9, False), ("línea\ndos", 1, 2.5, True)]
    path = f"{shared_folder(spark)}/res"
    results.write_result(spark.createDataFrame(data, schema), path, ["n"])
    back = results.read_result(spark, path, schema)
    assert [tuple(r) for r in back.collect()] == sorted(data, key=lambda r: r[1])


def test_materialize_uses_the_shared_folder(spark):
    df = materialize(spark.range(3), "numbers")
    assert rows(df) == [(0,), (1,), (2,)]
    assert all(f.startswith("file:") and "/shared" in f for f in df.inputFiles())


def test_month_with_most_rows_is_written_by_several_tasks(spark):
    path = f"{shared_folder(spark)}/hot"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    keep = spark.conf.get(size)
    month = F.when(F.col("id") % 10 == 0, F.lit("01")).otherwise(F.lit("02"))
    fact = spark.range(0, 40_000, 1, 8).select(
        F.col("id").alias("article_id"), F.sha2(F.col("id").cast("string"), 512).alias("body"),
        F.lit(2023).alias("year"), month.alias("month"),
    )
    try:
        spark.conf.set(size, "400k")
        warehouse.write_fact(fact, path)
    finally:
        spark.conf.set(size, keep)
    files = [f.rsplit("/", 2)[1] for f in spark.read.parquet(f"{path}/fact_news").inputFiles()]
    assert files.count("month=02") >= 4 and files.count("month=01") <= 2
    assert warehouse.scan_fact(spark, path).count() == 40_000
