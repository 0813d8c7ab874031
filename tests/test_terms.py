import random

import pytest
from frames import rows

import model
from tintero.config import TokenRules
from tintero.operators import terms

RULES = TokenRules(min_length=2, max_length=9, stop_words=frozenset({"bebe"}))


@pytest.fixture(scope="module")
def corpus():
    random.seed(5)
    syllables = ["ba", "ce", "di", "fo", "gu", "ñá"]
    words = ["".join(random.choices(syllables, k=random.randint(1, 3))) for _ in range(60)] + ["bebe"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def phrase(n):
        return " ".join(random.choices(words, weights, k=n))

    return [
        {
            "title": phrase(3), "body": phrase(random.randrange(0, 25)),
            # one class and one month hold most of the articles
            "cls": random.choice([1, 1, 1, 1, 2, 3, 9]), "month": random.choice(["2023-01"] * 4 + ["2023-02"]),
        }
        for _ in range(400)
    ]


@pytest.fixture(scope="module")
def articles(spark, corpus):
    data = [(r["title"], r["body"], r["cls"], r["month"]) for r in corpus]
    return spark.createDataFrame(data, "title string, body string, cls int, month string")


@pytest.mark.parametrize("parts", [1, 6])
def test_counts(articles, corpus, parts):
    want = model.counts(corpus, lambda r: r["cls"], RULES)
    got = terms.term_counts(articles.repartition(parts), ["cls"], rules=RULES).collect()
    assert {(r["cls"], r["term"]): r["count"] for r in got} == want


@pytest.mark.parametrize("k", [0, 1, 7, 1000])
def test_top_terms(articles, corpus, k):
    want = model.top_terms(model.counts(corpus, lambda r: r["month"], RULES), k)
    counts = terms.term_counts(articles, ["month"], rules=RULES)
    got = [tuple(r) for r in terms.top_terms(counts, k, "month").collect()]
    assert got == want


def test_top_terms_beyond_the_group_limit(articles, corpus, monkeypatch):
    monkeypatch.setattr(terms, "GROUP_LIMIT_THRESHOLD", 2)
    want = model.top_terms(model.counts(corpus, lambda r: r["month"], RULES), 9)
    counts = terms.term_counts(articles, ["month"], rules=RULES)
    assert [tuple(r) for r in terms.top_terms(counts, 9, "month").collect()] == want


def test_equal_counts_rank_alphabetically(spark):
    counts = spark.createDataFrame([("m", "b", 2), ("m", "a", 2), ("m", "c", 3)], "year_month string, term string, count bigint")
    assert [r["term"] for r in terms.top_terms(counts, 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("excluded, limit, low, least", [(9, 0, 5, 2), (9, 4, 5, 2), (None, 3, 1, 1), (1, 0, 10**6, 1)])
def test_lift(articles, corpus, excluded, limit, low, least):
    want = model.lift(model.counts(corpus, lambda r: r["cls"], RULES), low, least, excluded, limit)
    counts = terms.term_counts(articles, ["cls"], rules=RULES)
    got = [tuple(r) for r in terms.relative_lift(counts, "cls", low, least, excluded, limit).collect()]
    assert got == want  # same order, and the same doubles: the arithmetic is the same
    finer = terms.term_counts(articles, ["cls", "month"], rules=RULES)
    common = terms.within_vocabulary(finer, terms.frequent_vocabulary(finer, low), "cls")
    again = terms.relative_lift(finer, "cls", low, least, excluded, limit, common)
    assert [tuple(r) for r in again.collect()] == want


def test_only_unknown_class_counts_globally_but_is_not_listed(spark):
    data = [(9, "rio", 4), (1, "rio", 1), (1, "mar", 1)]
    counts = spark.createDataFrame(data, "cls int, term string, count bigint")
    got = [tuple(r) for r in terms.relative_lift(counts, "cls", 1, 1, 9).collect()]
    assert [(r[0], r[1], r[3]) for r in got] == [(1, "mar", 1), (1, "rio", 5)]


def test_null_class_counts_globally_but_is_not_listed(spark):
    data = [(None, "rio", 4), (1, "rio", 1)]
    counts = spark.createDataFrame(data, "cls int, term string, count bigint")
    assert rows(terms.relative_lift(counts, "cls", 1, 1)) == [(1, "rio", 1, 5, 1.0)]
    assert [r["cls"] for r in terms.vocabulary_divergence(counts, "cls", 1, 1).collect()] == [1]


@pytest.mark.parametrize("low, least", [(1, 1), (20, 300), (20, 0), (10**6, 0)])
def test_divergence(articles, corpus, low, least):
    want = model.divergence(model.counts(corpus, lambda r: r["cls"], RULES), low, least)
    counts = terms.term_counts(articles, ["cls"], rules=RULES)
    got = [tuple(r) for r in terms.vocabulary_divergence(counts, "cls", low, least).collect()]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-12)
    finer = terms.term_counts(articles, ["cls", "month"], rules=RULES)
    common = terms.within_vocabulary(finer, terms.frequent_vocabulary(finer, low), "cls")
    again = terms.vocabulary_divergence(finer, "cls", low, least, common).collect()
    assert [tuple(r)[:3] for r in again] == [w[:3] for w in want]
    assert [r[3] for r in again] == pytest.approx([w[3] for w in want], abs=1e-12)


def test_vocabulary_too_large_to_broadcast(articles):
    counts = terms.term_counts(articles, ["cls", "month"], rules=RULES)
    words = terms.frequent_vocabulary(counts, 5)
    joined = [terms.within_vocabulary(counts, words, "cls", n) for n in (0, 10**6)]
    assert rows(joined[0]) == rows(joined[1]) != []
    direct = terms.allowed_terms(terms.recount(counts, ["cls", "term"]), "cls", 5)
    assert rows(direct) == rows(joined[0])


def test_totals_too_many_to_broadcast(articles):
    counts = terms.term_counts(articles, ["cls"], rules=RULES)
    assert rows(terms.shares(counts, "cls", 0)) == rows(terms.shares(counts, "cls")) != []


def test_class_at_the_minimum_stays_and_below_it_goes(spark):
    counts = spark.createDataFrame([(1, "aa", 10), (2, "aa", 9)], "cls int, term string, count bigint")
    got = terms.vocabulary_divergence(counts, "cls", 1, 10).collect()
    assert [(r["cls"], r["total_terms"]) for r in got] == [(1, 10)]


def test_recounts_totals_and_words(spark, articles, corpus):
    fine = terms.term_counts(articles, ["cls", "month"], rules=RULES)
    assert rows(terms.recount(fine, ["cls", "term"])) == rows(
        terms.term_counts(articles, ["cls"], rules=RULES)
    )
    by_class = model.counts(corpus, lambda r: r["cls"], RULES)
    assert rows(terms.grand_total(fine)) == [(sum(by_class.values()),)]
    assert rows(terms.grand_total(fine.where("false"))) == [(0,)]
    words = spark.createDataFrame([("bace",), ("ba",)], "word string")
    left = {r["term"] for r in terms.without_words(fine, words).collect()}
    assert left == {t for _, t in by_class} - {"bace", "ba"}


def test_sum_emitted(spark):
    df = spark.createDataFrame([("a", ["x", "y", "x"], 2), ("a", [], 9), ("b", None, 1)], "k string, e array<string>, v int")
    got = terms.sum_emitted(df, ["k"], df["e"], "item", df["v"])
    assert rows(got) == [("a", "x", 4), ("a", "y", 2)]
