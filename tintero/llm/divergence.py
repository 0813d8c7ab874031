"""How far each source's vocabulary lies from the others of its language, by hash-consed segment trees.

The kept terms of a language are numbered by falling count and cut into
segments of a power of two.  Over a segment every group has a binary tree whose
leaves are its counts.  Nodes are hash-consed: a node is the pair of its
children's numbers, so equal count subtrees are one node, wherever they stand
and whichever group they belong to.  Neighbours in the numbering have like
counts, mostly 0 or 1 where there are many terms, so trees share most nodes.

Two groups are compared by walking both trees at once from the roots.  A pair
of nodes met a second time is the same entry of the walk's memo, so it is
priced once; a pair of one node under one denominator is worth nothing and is
not entered.  Segments are summed by Spark.

All shares are integers, ``1 + floor(1e9 * (count + 5) / (N + 5 V))``, computed
with unbounded integers once for each distinct count of a group and segment.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintero.llm.common import join_small, ship_package, sliced
from tintero.session import materialize

SCALE = 1_000_000_000
PRIOR = 5
#: Term counts that a task holds before it passes them on.
HELD_TERMS = 250_000
#: Most cells (groups times terms) of a segment, and its largest and smallest number of terms.
SEGMENT_CELLS, LARGEST, SMALLEST = 1 << 21, 1 << 13, 1 << 6
_SLICE = 1 << 20
#: Letters in lower case, bytes of other scripts as they are, all else blank.
_TERM_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"
_FOUND = "part string, source string, item string, value long"


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in slices that end between terms."""
    text = text.translate(_TERM_BYTES)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + _SLICE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            size = len(n)
            columns = [
                pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()),
                pa.array([docs[t] for t in n], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in sliced(batches):
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            in_document: set[bytes] = set()
            for terms in _terms(text):
                n.update(terms)
                in_document.update(terms)
            docs.update(in_document)
        if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
            yield from passed_on()
    yield from passed_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, counted in the tasks before the shuffle."""
    read = docs.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")],
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    parts = read.mapInArrow(_count, _COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: int, total: int) -> int:
    return 1 + SCALE * (int(count) + PRIOR) // int(total)


class Forest:
    """Trees over one segment, built level by level; ``roots`` has a node for each row of ``counts``."""

    def __init__(self, counts: np.ndarray):
        self.leaves, nodes = np.unique(counts, return_inverse=True)
        nodes = nodes.reshape(counts.shape)
        self.levels = []  # from the leaves up: the children (left, right) of each node
        while nodes.shape[1] > 1:
            pairs = nodes[:, 0::2].astype(np.int64) << 32 | nodes[:, 1::2]
            distinct, nodes = np.unique(pairs, return_inverse=True)
            nodes = nodes.reshape(pairs.shape)
            self.levels.append((distinct >> 32, distinct & 0xFFFFFFFF))
        self.roots = nodes[:, 0]

    def walk(self, a: int, b: int, same: bool) -> tuple[np.ndarray, np.ndarray, list]:
        """Simultaneous walk from two nodes down to pairs of leaves, with the memo of every level.

        A memo entry is a distinct pair of nodes; ``same`` says that both sides
        have one denominator, so that a node met with itself need not be entered.
        """
        x, y = np.array([a]), np.array([b])
        steps = []
        for left, right in reversed(self.levels):
            pairs = np.concatenate([left[x], right[x]]) << 32 | np.concatenate([left[y], right[y]])
            pairs, at = np.unique(pairs, return_inverse=True)
            if same:
                # node pair (i, i) keeps a place in the memo, but nothing below it is walked
                equal = pairs >> 32 == pairs & 0xFFFFFFFF
                place = np.where(equal, -1, np.cumsum(~equal) - 1)
                pairs, at = pairs[~equal], place[at]
            steps.append(at)
            x, y = pairs >> 32, pairs & 0xFFFFFFFF
        return x, y, steps

    @staticmethod
    def price(leaf_prices: np.ndarray, steps: list) -> int:
        """Price of the walk's start: the sum over both children of each memo entry, from the leaves up."""
        prices = leaf_prices
        for at in reversed(steps):
            prices = np.append(prices, 0)[at]  # the last place is that of a node met with itself
            prices = prices[: len(at) // 2] + prices[len(at) // 2 :]
        return int(prices.sum())


def _shares(forest: Forest, total: int) -> np.ndarray:
    return np.array([share(c, total) for c in forest.leaves.tolist()], np.int64)


def _price_segment(top: int):
    """For one (lang, segment): prices of all pairs of its groups, and each group's ``top`` terms above the language."""

    def priced(cells: pd.DataFrame) -> pd.DataFrame:
        heads = cells[cells["slot"] < 0].sort_values("source")
        cells = cells[cells["slot"] >= 0]
        sources, totals = heads["source"].tolist(), heads["n"].tolist()
        slots, column = np.unique(cells["slot"].to_numpy(), return_inverse=True)
        width = 1 << max(0, int(len(slots) - 1).bit_length())
        counts = np.zeros((len(sources) + 1, width), np.int64)
        row = np.searchsorted(np.array(sources, object), cells["source"].to_numpy(object))
        counts[row, column] = cells["n"].to_numpy()
        counts[-1] = counts[:-1].sum(axis=0)
        names = np.empty(width, object)
        names[column] = cells["term"].to_numpy(object)

        forest, used = Forest(counts), np.arange(width) < len(slots)
        shares = [_shares(forest, t) for t in totals]
        lang_shares = _shares(forest, int(heads["lang_total"].iloc[0]))
        # the places beyond the last term hold zeros in every tree and are taken off again
        beyond = width - len(slots)
        zero = int(np.searchsorted(forest.leaves, 0))
        found = []
        for i, a in enumerate(sources):
            for j in range(i):
                same = totals[i] == totals[j]
                x, y, steps = forest.walk(forest.roots[i], forest.roots[j], same)
                if steps:
                    value = forest.price(np.abs(shares[i][x] - shares[j][y]), steps)
                else:
                    value = abs(int(shares[i][x[0]]) - int(shares[j][y[0]]))
                value -= beyond * abs(int(shares[i][zero]) - int(shares[j][zero])) if beyond else 0
                found.append(("pair", sources[j], a, value))
        for i, a in enumerate(sources):
            own = np.searchsorted(forest.leaves, counts[i])
            above = shares[i][own] - lang_shares[np.searchsorted(forest.leaves, counts[-1])]
            at = np.nonzero((counts[i] > 0) & (above > 0) & used)[0]
            ranked = sorted(zip((-above[at]).tolist(), (t.encode() for t in names[at])))[:top]
            found += [("term", a, term.decode(), -value) for value, term in ranked]
        return pd.DataFrame(found, columns=["part", "source", "item", "value"])

    def with_lang(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        found = priced(cells)
        found.insert(0, "lang", key[0])
        return found

    return with_lang


def segment_bits(groups: int, cells: int = SEGMENT_CELLS) -> int:
    """Bits of the terms of a segment, so that all groups' counts of it stay within ``cells``."""
    terms = max(SMALLEST, min(LARGEST, cells // max(1, groups)))
    return terms.bit_length() - 1


def source_divergence(
    docs: DataFrame, min_docs: int = 30, top: int = 50, cells: int = SEGMENT_CELLS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for each group (lang, source) of ``docs(text, lang, source)``.

    Part ``pair`` has each other source of the language with the summed
    distance of the shares, part ``term`` the ``top`` terms whose share in the
    group exceeds that in the language.  Terms are runs of letters and
    non-ASCII characters, A-Z in lower case, found in ``min_docs`` documents
    (rows) of the language.  Ties rank by the UTF-8 bytes of the item.

    Null texts, languages and sources count as empty strings.  A group without
    kept terms has a share from the prior alone; a language without kept terms
    has distances of 0.  Repeated rows count each time.  Other columns are
    ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    counts = materialize(term_counts(docs), "term-counts")
    sums = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    # similar counts become neighbours, and each range of terms is numbered in its own task
    ranged = sums.where(F.col("docs") >= min_docs).select("lang", "term", "lang_n")
    ranged = ranged.repartitionByRange("lang", F.desc("lang_n"), "term").sortWithinPartitions("lang", F.desc("lang_n"), "term")
    ranged = materialize(
        ranged.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("place")), "kept-terms"
    )
    # numbers without gaps, from the sizes of the ranges before: one row per range and language
    ranges = ranged.groupBy("lang", "range").agg(F.min("place").alias("first"), F.count("*").alias("terms"))
    before = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("lang", "range", (F.coalesce(F.sum("terms").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    kept = join_small(ranged, materialize(ranges, "term-ranges"), ["lang", "range"], "inner", 64)
    kept = kept.select("lang", "term", "lang_n", (F.col("place") + F.col("shift")).alias("id"))

    groups = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = materialize(groups, "groups")
    largest = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    bits = segment_bits(largest, cells)
    placed = F.shiftright("id", bits).alias("segment"), F.col("id").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("slot")

    held = join_small(counts, kept, ["lang", "term"], "inner", 96)
    held = materialize(held.select("lang", *placed, "source", "term", "n"), "cells")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("n"))
    sizes = sizes.select("lang", "v", (F.col("n") + F.col("v") * PRIOR).alias("lang_total"))
    sizes = materialize(sizes, "languages")
    own = held.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    totals = join_small(groups, sizes, ["lang"], "inner", 64).join(own, ["lang", "source"], "left")
    totals = totals.select("lang", "source", (F.coalesce("own", F.lit(0)) + F.col("v") * PRIOR).alias("n"), "lang_total")
    totals = materialize(totals, "group-totals")
    segments = kept.select("lang", placed[0]).distinct()
    # one head per segment and group carries the denominator, also of groups without a term there
    heads = join_small(segments, totals, ["lang"], "inner", 96).select(
        "lang", "segment", F.lit(-1).alias("slot"), "source", F.lit("").alias("term"), "n", "lang_total"
    )
    rows = heads.union(held.withColumn("lang_total", F.lit(0).cast("long")))
    priced = rows.groupBy("lang", "segment").applyInPandas(_price_segment(top), f"lang string, {_FOUND}")
    priced = materialize(priced, "priced-segments")

    pairs = join_small(groups, groups.withColumnRenamed("source", "item"), ["lang"], "inner", 64).where("source <> item")
    summed = priced.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    summed = summed.union(summed.select("lang", F.col("item"), F.col("source"), "value"))
    pairs = pairs.join(summed, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    terms = priced.where("part = 'term'").select("lang", "source", "part", "item", "value")
    return pairs.select("*", rank).union(terms.select("*", rank).where(F.col("rank") <= top))
