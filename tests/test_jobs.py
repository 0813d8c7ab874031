import csv
import random
from collections import Counter
from datetime import date, timedelta

import pytest
from frames import rows

import model
from pyspark.sql import functions as F

from tintero import lexicon
from tintero.config import AnalyticsConfig, ReportConfig, TokenRules, WarehouseConfig
from tintero.plans.analytics import run_analytics
from tintero.plans.report import build_reports
from tintero.plans.warehouse import InvalidWarehouse, build_warehouse
from tintero.session import scratch_path
from tintero.sources import warehouse
from tintero.operators.fact import FACT_COLUMNS

CONFIG = AnalyticsConfig(
    top_k=5, min_global_count=8, min_regional_count=2, min_source_terms=30, region_limit=6,
    peak_window=3, peak_factor=1.2, peak_min_delta=1.0,
)


@pytest.fixture(scope="module")
def raw():
    """Articles in file order; one source, one month and one region hold most of them."""
    random.seed(21)
    places = [a for names in lexicon.REGION_ALIASES.values() for a in names]
    words = "gobierno presidente economía fútbol ciudad educación salud trabajo región niños para mayo".split()
    out = []
    for i in range(500):
        def phrase(n):
            some = random.choices(words, range(12, 0, -1), k=n)
            some += random.choices(["santiago"] * 3 + places, k=random.randrange(3))
            random.shuffle(some)
            return " ".join(some)

        day = date(2023, 1, 1) + timedelta(days=min(random.randrange(120), random.randrange(120)))
        out.append((
            random.choice([None, i, i, i, i, i // 2]), random.choice([None, phrase(4), phrase(3).upper()]),
            random.choice([None, phrase(20), phrase(30) + '\n"fin"']),
            random.choice([None, "emol", "emol", "emol", "latercera", "cooperativa", f"raro{i}"]),
            random.choice(["2023-13-01", None] + [day.isoformat()] * 8),
        ))
    return out


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    for i in range(3):
        with open(folder / f"part{i}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(["article_id", "title", "body", "source", "publish_date"])
            out.writerows([["NA" if v is None else v for v in r] for r in raw[i * 200 : i * 200 + 200]])
    path = scratch_path(spark, "warehouse")
    report = build_warehouse(spark, str(folder), path, WarehouseConfig(fail_on_invalid=True))
    return path, report, str(folder)


@pytest.fixture(scope="module")
def facts(raw):
    return model.facts(model.clean(raw), lexicon.REGION_ALIASES, lexicon.UNKNOWN_REGION)


def test_fact(spark, built, facts):
    got = warehouse.scan_fact(spark, built[0], FACT_COLUMNS)
    assert rows(got) == sorted(
        (tuple(f[c] for c in FACT_COLUMNS) for f in facts), key=lambda r: [(v is None, str(v)) for v in r]
    )
    assert len({f["region_id"] for f in facts}) > 5


def test_dimensions_and_report(spark, built, facts):
    path, report, _ = built
    assert [r["passed"] for r in report.collect()] == [True] * 5
    days = spark.read.parquet(f"{path}/dim_date").collect()
    keys = [f["date_id"] for f in facts]
    assert min(d["date_id"] for d in days) == min(keys) and max(d["date_id"] for d in days) == max(keys)
    sources = spark.read.parquet(f"{path}/dim_source").collect()
    assert sorted(s["source_id"] for s in sources) == list(range(1, len(sources) + 1))


def test_building_again_replaces(spark, built, facts):
    path, _, folder = built
    build_warehouse(spark, folder, path)
    assert warehouse.scan_fact(spark, path).count() == len(facts)


@pytest.fixture(scope="module")
def analysed(spark, built):
    out = scratch_path(spark, "results")
    return out, run_analytics(spark, built[0], out, CONFIG)


def expected(facts):
    rules = TokenRules()
    month = model.counts(facts, lambda r: f"{r['year']}-{r['month']}", rules)
    region = model.counts(facts, lambda r: r["region_id"], rules)
    source = model.counts(facts, lambda r: r["source_id"], rules)
    days = [date.fromisoformat(f"{f['date_id']}") for f in facts]
    return (
        model.top_terms(month, 5),
        model.lift(region, 8, 2, 17, 6),
        model.divergence(source, 8, 30),
        model.peaks(days, 3, 1.2, 1.0),
    )


def test_analytics(spark, built, analysed, facts):
    _, got = analysed
    monthly, regional, divergence, peaks = expected(facts)
    assert [tuple(r) for r in got["top_terms_monthly"].collect()] == monthly
    names = dict(enumerate(lexicon.REGION_NAMES, start=1))
    assert [tuple(r) for r in got["regional_word_distribution"].collect()] == [
        (c, names[c], *rest) for c, *rest in regional
    ]
    sources = {r["source_id"]: r["source_name"] for r in spark.read.parquet(f"{built[0]}/dim_source").collect()}
    found = [tuple(r) for r in got["source_vocabulary_divergence"].collect()]
    assert [f[:4] for f in found] == [(s, sources[s], t, v) for s, t, v, _ in divergence]
    assert [f[4] for f in found] == pytest.approx([d[3] for d in divergence], abs=1e-12)
    assert [tuple(r) for r in got["daily_peaks"].collect()] == peaks
    assert len(divergence) >= 3 and any(p[4] for p in peaks) and len(regional) > 10


def test_reports(spark, analysed, facts):
    frames = build_reports(spark, analysed[0], ReportConfig(top_n=4, terms_per_region=3))
    monthly, regional, divergence, peaks = expected(facts)
    totals = Counter()
    for _, term, n in monthly:
        totals[term] += n
    assert [tuple(r) for r in frames["global_top_terms"].collect()] == sorted(
        totals.items(), key=lambda t: (-t[1], t[0])
    )[:4]
    leaders = {}
    for month, term, n in monthly:
        leaders.setdefault(month, (month, term, n))
    assert [tuple(r) for r in frames["monthly_leading_terms"].collect()] == list(leaders.values())
    assert [r["kl_divergence"] for r in frames["divergent_sources"].collect()] == pytest.approx(
        [d[3] for d in divergence[:4]], abs=1e-12
    )
    assert [tuple(r) for r in frames["daily_series"].collect()] == peaks
    assert [tuple(r) for r in frames["peak_days"].collect()] == [p for p in peaks if p[4]]
    names = dict(enumerate(lexicon.REGION_NAMES, start=1))
    want = []
    for region in sorted(lexicon.REPORT_REGIONS):
        mine = [(n, x, t) for c, t, n, _, x in regional if names[c] == region]
        want += [(region, t, x, n) for n, x, t in sorted(mine, key=lambda r: (-r[0], -r[1], r[2]))[:3]]
    got = frames["regional_terms"].drop("region_slug").collect()
    assert [tuple(r) for r in got] == want and want


def test_placeholder_words_can_be_left_out(spark, built, facts):
    from tintero.plans.analytics import base_counts

    fact = warehouse.scan_fact(spark, built[0])
    leaked = base_counts(fact, CONFIG).where("term IN ('titulo', 'cuerpo')")
    assert leaked.count() > 0
    config = AnalyticsConfig(drop_placeholders=True)
    assert base_counts(fact, config).where("term IN ('titulo', 'cuerpo')").count() == 0


def test_stops_on_request_when_invalid(spark):
    schema = "article_id bigint, title string, body string, source string, publish_date string, ingest_seq bigint"
    articles = spark.createDataFrame([(1, "a", "b", "s", "2023-01-01", 0)], schema)
    path = scratch_path(spark, "bad")
    build_warehouse(spark, articles.withColumn("article_id", F.lit(7).cast("long")), path)
    config = WarehouseConfig(class_names=["solo"], fail_on_invalid=True)  # class 17 has no row
    with pytest.raises(InvalidWarehouse, match="referential_integrity"):
        build_warehouse(spark, articles, path, config)
    assert [r.article_id for r in warehouse.scan_fact(spark, path).collect()] == [7]
    assert spark.read.parquet(f"{path}/dim_region").count() == len(lexicon.REGION_NAMES)
    assert spark.read.parquet(f"{path}/validation_report").where("not passed").count() == 0
    build_warehouse(spark, articles, path)
    assert [r.article_id for r in warehouse.scan_fact(spark, path).collect()] == [1]


def test_empty_input(spark):
    schema = "article_id bigint, title string, body string, source string, publish_date string, ingest_seq bigint"
    path = scratch_path(spark, "empty")
    report = build_warehouse(spark, spark.createDataFrame([], schema), path)
    assert all(r["passed"] for r in report.collect())
