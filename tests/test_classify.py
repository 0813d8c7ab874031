import random

import pytest
from pyspark.sql import functions as F

import model
from tintero import lexicon
from tintero.functions import text
from tintero.operators import alias_table, classify

SHARED = {1: ["la", "san"], 2: ["la serena", "serena"], 3: ["san antonio", "rm"], 4: ["o'higgins", "ohiggins"]}


def voted(spark, articles, aliases, unknown, **options):
    df = spark.createDataFrame(list(enumerate(articles)), "i int, a struct<t:string,b:string>")
    folded = text.with_folded(df, {"title_clean": F.col("a.t"), "body_clean": F.col("a.b")})
    got = classify.vote(folded, aliases, unknown, **options).orderBy("i").collect()
    return [r["region_id"] for r in got]


CASES = [
    (("Maule", "tarapaca iquique tarapaca"), 2),  # 3 : 3, the lowest id wins
    (("nada", "nada"), 17),
    (("", "región metropolitana de Santiago y RM"), 7),
    (("farmacia", "permaneció en la capitalina"), 17),  # inside longer words
    (("ßrm", "rm2 _rm"), 17),
    (("Viña del Mar", ""), 6),
    (("Chillán, ÑUBLE", "Santiago"), 10),
    ((None, None), 17),
    (("los ríos", "los lagos los lagos los lagos los lagos"), 14),
]


@pytest.mark.parametrize("article, want", CASES)
def test_default_aliases(spark, article, want):
    assert model.vote(*article, lexicon.REGION_ALIASES, 17) == want
    assert voted(spark, [article], lexicon.REGION_ALIASES, 17) == [want]


@pytest.mark.parametrize("aliases, unknown, overlap", [(lexicon.REGION_ALIASES, 17, False), (SHARED, 9, True)])
def test_random_texts_against_the_model(spark, aliases, unknown, overlap):
    assert classify.classes_overlap(aliases) is overlap
    random.seed(11)
    words = [w for names in aliases.values() for a in names for w in a.split()] + ["x", "de", "san", "ß", "É"]
    glue = [" ", " ", " ", ", ", "-", "'", "_", "\n"]

    def phrase():
        return "".join(random.choice(words) + random.choice(glue) for _ in range(random.randrange(12)))

    articles = [(phrase(), phrase()) for _ in range(300)]
    want = [model.vote(t, b, aliases, unknown) for t, b in articles]
    assert voted(spark, articles, aliases, unknown) == want
    assert len(set(want)) > 3


def test_title_breaks_ties_on_request(spark):
    article = ("maule", "tarapaca iquique tarapaca")
    assert voted(spark, [article], lexicon.REGION_ALIASES, 17, title_breaks_ties=True) == [9]


@pytest.mark.parametrize(
    "a, b, want",
    [("la", "la serena", True), ("san antonio", "antonio varas", True), ("arica", "atacama", False),
     ("rm", "rm", True), ("los rios", "los lagos", False), ("a b", "c a", True)],
)
def test_can_overlap(a, b, want):
    assert classify.can_overlap(a, b) is want and classify.can_overlap(b, a) is want


def test_no_aliases(spark):
    assert voted(spark, [("a", "b")], {1: [], 5: ["a"]}, 5) == [5]


def by_table(spark, articles, aliases, unknown, **options):
    df = spark.createDataFrame(list(enumerate(articles)), "article_id int, a struct<t:string,b:string>")
    folded = text.with_folded(df, {"title_clean": F.col("a.t"), "body_clean": F.col("a.b")})
    listed = [(k, a, i) for k, names in aliases.items() for i, a in enumerate(names)]
    table = spark.createDataFrame(listed, "class_id int, alias string, place int")
    got = alias_table.vote_by_table(folded, table, unknown, **options).orderBy("article_id").collect()
    return [r["region_id"] for r in got]


def phrases(aliases, n):
    random.seed(12)
    words = [w for names in aliases.values() for a in names for w in a.split()] + ["x", "de", "san", "ß", "É"]
    glue = [" ", " ", " ", ", ", "-", "'", "_", "\n"]

    def phrase():
        return "".join(random.choice(words) + random.choice(glue) for _ in range(random.randrange(12)))

    return [(phrase(), phrase()) for _ in range(n)]


@pytest.mark.parametrize("aliases, unknown", [(lexicon.REGION_ALIASES, 17), (SHARED, 9)])
@pytest.mark.parametrize("limit", [0, 1000])
def test_a_table_of_aliases_votes_as_the_dictionary(spark, aliases, unknown, limit):
    articles = phrases(aliases, 200) + [(None, None), ("", ""), *[a for a, _ in CASES]]
    want = [model.vote(t, b, aliases, unknown) for t, b in articles]
    assert by_table(spark, articles, aliases, unknown, max_broadcast_rows=limit) == want


def test_title_breaks_ties_by_table(spark):
    article = ("maule", "tarapaca iquique tarapaca")
    assert by_table(spark, [article], lexicon.REGION_ALIASES, 17, title_breaks_ties=True) == [9]


def test_an_alias_must_be_words(spark):
    with pytest.raises(Exception, match="begin and end with a word"):
        by_table(spark, [("a", "b")], {1: ["#a"]}, 5)


def test_no_aliases_in_the_table(spark):
    assert by_table(spark, [("a", "b"), ("c", None)], {5: ["a"]}, 5) == [5, 5]


def test_the_plan_does_not_grow_with_the_dictionary(spark):
    df = spark.createDataFrame([(i, f"alias{i * 3} und ort{i}x", "alias7 alias8") for i in range(50)], "article_id int, title string, body string")

    def of(n_aliases, n_classes):
        table = spark.range(n_aliases).selectExpr(f"cast(1 + id % {n_classes} as int) as class_id", "concat('alias', id) as alias")
        return alias_table.vote_by_table(df, table, 0, title="title", body="body")

    small, large = of(10, 2), of(10_000, 1_000)
    plans = [p._jdf.queryExecution().optimizedPlan().toString() for p in (small, large)]
    assert len(plans[0].splitlines()) == len(plans[1].splitlines())
    got = {r["article_id"]: r["region_id"] for r in large.collect()}
    assert got == {i: 1 + 3 * i % 1000 for i in range(50)}
