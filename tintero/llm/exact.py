"""Exact duplicates by distributed radix partitioning, most significant bytes first.

Texts are split by their first bytes, then each group that still holds several
texts by the following bytes, and so on, until a group is a single text or its
texts have ended.  Bytes themselves are compared, so no digest decides.  A
pass takes ``GROWTH`` times as many bytes as the one before: copies of long
texts need few passes, and the others leave after the first.

Groups are counted with partial sums before the shuffle, and rows meet their
group's summary in a join whose large groups are split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintero.llm.common import SPACES, join_small, text_or_empty
from tintero.session import materialize

FIRST_DIGIT, GROWTH = 16, 16


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def _best() -> Column:
    """Most code points, then smallest id, then any one row."""
    return F.min(F.struct((-F.col("length")).alias("l"), F.isnull("doc_id").alias("x"), "doc_id", "row"))


def _summary(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(_best().alias("best"), F.count("*").alias("n"), F.min("row").alias("group"))


def _decided(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def exact_duplicates(docs: DataFrame, first_digit: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of ``docs(doc_id, text)``.

    Texts are equal when they are identical without blanks and the characters
    9 to 13.  The longest original stays, then the smallest id.  A null text
    counts as empty; empty texts are equal to one another.  Null ids come last;
    of rows that repeat both id and text one stays.  Other columns are ignored;
    an empty table gives an empty result.
    """
    plain = without_spaces(text_or_empty())
    rows = docs.select(
        "doc_id",
        F.char_length(text_or_empty()).cast("long").alias("length"),
        plain.alias("plain"),
    )
    hashed = F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256")

    def head(width: int) -> Column:
        return F.substring(F.col("plain").cast("binary"), 1, width)

    first = rows.select(
        "doc_id", "length", hashed, head(first_digit).alias("digit"), F.monotonically_increasing_id().alias("row")
    )
    first = materialize(first, "first-digits")
    groups = _summary(first, "digit")
    still_open = (F.col("n") > 1) & (F.octet_length("digit") == first_digit)
    open_digits = materialize(groups.where(still_open).select("digit"), "open-digits")
    results = [_decided(first.join(groups.where(~still_open), "digit"))]

    digits = rows.withColumn("digit", head(first_digit))
    state = join_small(digits, open_digits, ["digit"], "left_semi", 48).select(
        "doc_id",
        "length",
        F.col("plain").cast("binary").alias("tail"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(0).cast("long").alias("group"),
    )
    state = materialize(state, "open-texts")
    texts, width = state, first_digit
    while not state.isEmpty():
        width *= growth
        state = state.withColumn("digit", F.substring("tail", 1, width)).withColumn(
            "tail", F.expr(f"substring(tail, {width + 1})")
        )
        groups = _summary(state.withColumnRenamed("group", "parent"), "parent", "digit")
        joined = state.withColumnRenamed("group", "parent").join(groups, ["parent", "digit"])
        joined = materialize(
            joined.select(
                "doc_id", "row", "length", "tail", "best", "n", "group",
                ((F.col("n") == 1) | (F.octet_length("digit") < width)).alias("done"),
            ),
            "radix-pass",
        )
        results.append(joined.where("done").select("doc_id", "row", "best", "n"))
        state = joined.where(~F.col("done")).select("doc_id", "row", "length", "tail", "group")
    if len(results) > 1:
        ended = results[1]
        for more in results[2:]:
            ended = ended.union(more)
        hashes = texts.select("row", F.sha2("tail", 256).alias("text_sha256"))
        results = [results[0], _decided(ended.join(hashes, "row"))]
    return results[0] if len(results) == 1 else results[0].union(results[1])
