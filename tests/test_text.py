import re
import unicodedata

import pytest
from frames import rows
from pyspark.sql import functions as F

import model
from tintero.config import TokenRules
from tintero.functions import text
from tintero.operators import terms

SAMPLES = [
    None, "", "ÑUBLE", "ﬁn de mes", "5º lugar, 1ª vez", "straße", "a b", "½ kilo … ¿qué?", "´agudo¨",
    "İstanbul", "ĳs en ﬃ", "ⅷ capítulos", "⒜ ℡ ™ ㎏", "x²", "１２ ｆｕｌｌ", "Kelvin K", "été",
    "𝐚bc", "ΟΔΟΣ", "नमस्ते", "தமிழ்", "ﷺ", "ゞ゙か", "word\x1csep\x85sep end", "ά᾽",
]


@pytest.fixture(scope="module")
def samples(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    return text.with_folded(df, {"folded": F.col("s")}).withColumn("direct", text.fold(F.col("s")))


def test_fold_matches_unicode_data(samples):
    for row in samples.collect():
        assert row["folded"] == model.fold(row["s"]), row["s"]
        assert row["direct"] == row["folded"]


def test_fold_of_every_assigned_character(spark):
    """All of Unicode in blocks, against Python."""
    skip = set(range(0xD800, 0xE000))
    blocks = []
    for start in range(0x20, 0x30000, 64):
        chars = [chr(p) for p in range(start, start + 64) if p not in skip]
        # Case mappings may differ between the Unicode versions of Python and the
        # JVM for newly added letters; those have no decompositions.
        chars = [c for c in chars if unicodedata.category(c) != "Cn"]
        if chars:
            blocks.append((start, "|".join(chars)))
    df = spark.createDataFrame(blocks, "start int, s string").repartition(4)
    got = text.with_folded(df, {"folded": F.col("s")}).collect()
    assert len(got) > 1000
    for row in got:
        assert row["folded"] == model.fold(row["s"]), hex(row["start"])


def test_hangul_is_taken_apart(spark):
    texts = ["한국 ÁB", "각", "가", "힣", "a뷁ﬁ나", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(text.fold(F.col("s"))).collect()] == list(map(model.fold, texts))


def test_word_counts(samples):
    for row in samples.select("s", text.word_count(F.col("folded")).alias("n")).collect():
        assert row["n"] == model.word_count(row["s"]), row["s"]


@pytest.mark.parametrize("value, n", [("", 1), (" a ", 3), ("a  b", 2), (None, 1)])
def test_word_count_edges(spark, value, n):
    df = spark.createDataFrame([(value,)], "s string")
    assert df.select(text.word_count(text.fold(F.col("s")))).first()[0] == n


TOKENS = [
    "covid-19", "abab", "abcab", "abc", "abcd", "aaaa", "aabb", "aabbc", "x" * 3 + "yz", "a" * 30,
    "abcdefghijklmnopqrstuvwx", "abcdefghijklmnopqrstuvwxy", "para", "gobierno", "jajaja", "Ñandú",
]


def test_term_rules_in_pattern_and_as_predicate(spark):
    rules = TokenRules()
    want = model.terms("", " ".join(TOKENS), rules)
    df = spark.createDataFrame([("", " ".join(TOKENS))], "title string, body string")
    exploded = [r[0] for r in terms.explode_terms(df, [], rules=rules).collect()]
    assert sorted(exploded) == sorted(want)
    assert "gobierno" in want and "abcdefghijklmnopqrstuvwx" in want and "abab" not in want
    runs = df.select(F.explode(text.letter_runs(text.fold(F.col("body")))).alias("t"))
    assert sorted(r[0] for r in runs.where(text.is_term(F.col("t"), rules)).collect()) == sorted(want)


@pytest.mark.parametrize("low, high, two", [(1, 3, True), (2, 8, False), (4, 24, True), (5, 5, False)])
def test_term_pattern_against_filtering(low, high, two):
    rules = TokenRules(low, high, two, frozenset())
    joined = " ".join(TOKENS).lower()
    want = [
        t
        for t in re.findall("[a-z]+", joined)
        if low <= len(t) <= high and (not two or len(set(t)) > 2)
    ]
    found = [m.group(0) for m in re.finditer(text.term_pattern(rules), joined)]
    assert found == want


def test_joined_text_and_slug(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(text.joined(F.col("x"), F.col("y"))).collect()] == ["a ", " b", " "]
    named = spark.createDataFrame([("Los Rios/Sur",)], "n string")
    assert rows(named.select(text.slug(F.col("n")))) == [("los_rios_sur",)]
