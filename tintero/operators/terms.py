"""Term counts and what is derived from them.

Every result starts from a table of counts.  :func:`term_counts` is the only
place that reads text; the rest re-aggregates its output, which is far smaller
than the text, so several results can share one pass (:func:`recount`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintero.config import TokenRules
from tintero.functions import text
from tintero.operators.joins import BROADCAST_ROWS, fits_broadcast, lookup
from tintero.session import materialize


def sum_emitted(
    df: DataFrame,
    keys: Sequence[str | Column],
    emitted: Column,
    name: str,
    value: Column | None = None,
    out: str = "count",
) -> DataFrame:
    """Flat-map then sum: one row per element of the array ``emitted``, summed by key and element."""
    value = F.lit(1) if value is None else value
    pairs = df.select(*keys, value.alias("_value"), emitted.alias("_emitted"))
    names = [*pairs.columns[:-2], name]
    flat = pairs.select(*pairs.columns[:-1], F.explode("_emitted").alias(name))
    return flat.groupBy(*names).agg(F.sum("_value").cast("long").alias(out))


def explode_terms(
    df: DataFrame,
    keys: Sequence[str | Column],
    texts: Sequence[str | Column] = ("title", "body"),
    rules: TokenRules = TokenRules(),
) -> DataFrame:
    """One row per accepted term of the joined ``texts``."""
    columns = [F.col(t) if isinstance(t, str) else t for t in texts]
    # Keys are computed here, per article, and not after the explode, per term.
    keyed = df.select(*keys, text.joined(*columns).alias("_text"))
    keyed = text.half_folded(keyed, {"_text": F.col("_text")})
    candidates = text.term_candidates(text.finish_fold(F.col("_text")), rules)
    terms = keyed.select(*keyed.columns[:-1], F.explode(candidates).alias("term"))
    return terms.where(text.not_stop_word(F.col("term"), rules))


def term_counts(
    df: DataFrame,
    keys: Sequence[str | Column] = (),
    texts: Sequence[str | Column] = ("title", "body"),
    rules: TokenRules = TokenRules(),
) -> DataFrame:
    """``(keys..., term, count)``.  Frequent terms are summed before the shuffle."""
    terms = explode_terms(df, keys, texts, rules)
    return terms.groupBy(*terms.columns).agg(F.count("*").alias("count"))


def recount(counts: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Coarser counts from finer ones."""
    return counts.groupBy(*keys).agg(F.sum("count").cast("long").alias("count"))


def without_words(counts: DataFrame, words: DataFrame, word: str = "word") -> DataFrame:
    """Drop the terms listed in a table of stop words of any size."""
    return counts.join(words, counts["term"] == words[word], "left_anti")


def at_least(df: DataFrame, column: str, minimum: float) -> DataFrame:
    return df.where(F.col(column) >= minimum)


def exclude_class(df: DataFrame, column: str, excluded) -> DataFrame:
    """Drop one class, and rows without a class."""
    return df.where(F.col(column) != excluded)


#: Spark cuts ranks before the shuffle up to spark.sql.optimizer.windowGroupLimitThreshold
GROUP_LIMIT_THRESHOLD = 1000
_SALTS = 64


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows of each group.

    Each task ranks and cuts before the shuffle, so a group sends at most ``k``
    rows per task whatever its size.  For a ``k`` above Spark's threshold for that,
    each group is first cut to ``k`` rows in each of several hashed parts.
    """
    name = rank or "_rank"

    def first_k(rows: DataFrame, *within: str) -> DataFrame:
        window = Window.partitionBy(*within).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)

    if k > GROUP_LIMIT_THRESHOLD:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        df = first_k(salted, *group, "_salt").drop(name, "_salt")
    ranked = first_k(df, *group)
    return ranked if rank else ranked.drop(name)


def top_terms(counts: DataFrame, k: int, group: str = "year_month") -> DataFrame:
    """Most frequent terms of each month; equal counts in alphabetical order."""
    top = top_per_group(counts, [group], [F.desc("count"), F.asc("term")], k)
    return top.orderBy(group, F.desc("count"), "term")


def class_totals(counts: DataFrame, key: str, out: str = "total") -> DataFrame:
    """Accepted tokens per class."""
    return counts.groupBy(key).agg(F.sum("count").cast("long").alias(out))


def grand_total(counts: DataFrame, out: str = "total") -> DataFrame:
    return counts.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias(out))


def vocabulary(counts: DataFrame, key: str) -> DataFrame:
    """Tokens and distinct terms per class, from counts that hold one row per (class, term)."""
    return counts.groupBy(key).agg(
        F.sum("count").cast("long").alias("total_terms"),
        F.count("*").alias("vocabulary_size"),
    )


def allowed_terms(
    counts: DataFrame, key: str, min_global_count: int, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``(key, term, global_count, count)`` of the terms that reach a global minimum.

    ``counts`` are stored first: they serve the vocabulary and its join, and the
    text is read once.
    """
    stored = materialize(counts, "class-counts")
    words = materialize(frequent_vocabulary(stored, min_global_count), "vocabulary")
    return within_vocabulary(stored, words, key, max_broadcast_rows)


def frequent_vocabulary(counts: DataFrame, min_global_count: int) -> DataFrame:
    """``(term, global_count)`` of the terms that reach the minimum."""
    totals = counts.groupBy("term").agg(F.sum("count").cast("long").alias("global_count"))
    return at_least(totals, "global_count", min_global_count)


def within_vocabulary(
    counts: DataFrame, vocabulary: DataFrame, key: str, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``(key, term, global_count, count)`` of the terms in a stored ``vocabulary``.

    Most distinct terms are rare.  With a vocabulary that can be broadcast (its
    rows are counted) they are dropped where ``counts`` are read and never reach
    the shuffle by class.  A larger one is joined after the recount, when a term
    has one row per class, by (term, salt of the class).
    """
    if fits_broadcast(vocabulary, max_broadcast_rows):
        return recount(counts.join(F.broadcast(vocabulary), "term"), [key, "term", "global_count"])
    recounted = recount(counts, [key, "term"])
    found = lookup(recounted, vocabulary, "term", "term", key, 0).where("global_count IS NOT NULL")
    return found.select(key, "term", "global_count", "count")


def with_totals(
    counts: DataFrame, rows: DataFrame, key: str, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``class_total`` and ``corpus_total`` of ``counts`` to ``rows``; both null for rows without a class.

    The totals have one row per class and are stored and counted: a number that
    fits is broadcast, more are joined by (class, salt of the term).
    """
    totals = materialize(class_totals(counts, key, "class_total"), "class-totals")
    corpus = totals.agg(F.sum("class_total").alias("corpus_total"))
    found = lookup(rows, totals, key, key, "term", max_broadcast_rows)
    return found.withColumn("corpus_total", corpus.scalar())


def shares(counts: DataFrame, key: str, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Each count relative to its class and to the corpus."""
    counts = materialize(counts, "class-counts")
    return with_totals(counts, counts, key, max_broadcast_rows).select(
        *counts.columns,
        (F.col("count") / F.col("class_total")).alias("class_share"),
        (F.col("count") / F.col("corpus_total")).alias("corpus_share"),
    )


def relative_lift(
    counts: DataFrame,
    key: str,
    min_global_count: int,
    min_class_count: int,
    excluded=None,
    limit: int = 0,
    frequent: DataFrame | None = None,
) -> DataFrame:
    """How over-represented each term is in a class.

    ``(key, term, regional_count, global_count, relative_ratio)``, where the ratio
    is the term's share of the class over its share of the corpus.  The global
    side covers everything, the excluded class and unclassified rows included.
    ``limit`` keeps that many terms per class, 0 keeps all.  ``frequent`` may bring
    the result of :func:`within_vocabulary`; ``counts`` are then a stored table and
    may be finer.
    """
    if frequent is None:
        counts = materialize(counts, "class-counts")
        words = materialize(frequent_vocabulary(counts, min_global_count), "vocabulary")
        frequent = within_vocabulary(counts, words, key)
    rows = with_totals(counts, at_least(frequent, "count", min_class_count), key)
    if excluded is not None:
        rows = exclude_class(rows, key, excluded)
    else:
        rows = rows.where(F.col(key).isNotNull())
    share = F.col("count") / F.col("class_total")
    corpus_share = F.col("global_count") / F.col("corpus_total")
    rows = rows.select(
        key,
        "term",
        F.col("count").alias("regional_count"),
        "global_count",
        (share / corpus_share).alias("relative_ratio"),
    )
    order = [F.desc("relative_ratio"), F.desc("regional_count"), F.asc("term")]
    if limit > 0:
        rows = top_per_group(rows, [key], order, limit)
    return rows.orderBy(key, *order)


def vocabulary_divergence(
    counts: DataFrame,
    key: str,
    min_global_count: int,
    min_class_terms: int,
    frequent: DataFrame | None = None,
) -> DataFrame:
    """Kullback-Leibler divergence (nats) of each class's terms from the corpus.

    ``(key, total_terms, vocabulary_size, kl_divergence)`` over the terms that
    reach ``min_global_count``.  With class total T and corpus total G,

        sum n/T * ln((n/T) / (g/G))  =  sum n*(ln n - ln g) / T  - ln T + ln G

    so one aggregate per class suffices, G is the sum of the class totals, and no
    total has to be joined back to the terms.  The aggregate is stored, as G and
    the order would each compute it again.  ``frequent`` may bring the result of
    :func:`within_vocabulary`.
    """
    if frequent is None:
        frequent = allowed_terms(counts, key, min_global_count)
    n, g = F.col("count"), F.col("global_count")
    per_class = (
        frequent.groupBy(key)
        .agg(
            F.sum("count").cast("long").alias("total_terms"),
            F.count("*").alias("vocabulary_size"),
            F.sum(n * (F.ln(n) - F.ln(g))).alias("_weighted"),
        )
    )
    per_class = materialize(per_class, "class-divergence")
    corpus = per_class.agg(F.sum("total_terms").alias("_corpus"))
    total = F.col("total_terms")
    divergence = F.col("_weighted") / total - F.ln(total) + F.ln(corpus.scalar())
    return (
        per_class.where(total >= min_class_terms)
        .where(F.col(key).isNotNull())
        .select(key, "total_terms", "vocabulary_size", divergence.alias("kl_divergence"))
        .orderBy(F.desc("kl_divergence"), key)
    )
