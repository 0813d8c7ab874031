"""Keyword vote: assign each text to the class whose aliases it mentions most."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Mapping, Sequence
from itertools import combinations, groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintero.functions.text import WORD_CHAR

Aliases = Mapping[int, Sequence[str]]


def _boundary(text: str, at: int) -> bool:
    """Whether a word starts or ends at ``at``, taking the text's own edges as such."""
    if at in (0, len(text)):
        return True
    return bool(re.match(r"\w", text[at - 1])) != bool(re.match(r"\w", text[at]))


def can_overlap(a: str, b: str) -> bool:
    """Whether some text holds whole-word matches of ``a`` and ``b`` that share a character."""

    def from_within(x: str, y: str) -> bool:
        for start in range(len(x)):
            if not _boundary(x, start):
                continue
            rest = x[start:]
            if rest.startswith(y) and _boundary(x, start + len(y)):
                return True
            if y.startswith(rest) and _boundary(y, len(rest)):
                return True
        return False

    return from_within(a, b) or from_within(b, a)


def classes_overlap(aliases: Aliases) -> bool:
    """Whether aliases of two classes can overlap; compares only aliases with a word in common."""
    sharing: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for key, names in aliases.items():
        for name in names:
            for part in set(re.findall(r"\w+|[^\w\s]", name)):
                sharing[part].append((key, name))
    return any(
        ka != kb and can_overlap(a, b)
        for group in sharing.values()
        for (ka, a), (kb, b) in combinations(group, 2)
    )


def alias_pattern(names: Sequence[str]) -> str:
    """Whole-word alternation; of several that fit at one place the first listed wins.

    Grouping by first letter keeps that rule, as alternatives of different groups
    never fit at the same place, and spares the matcher most of the list.
    """
    by_letter = sorted(names, key=lambda a: a[0])  # stable: keeps the order within a letter
    groups = [
        re.escape(letter) + "(?:" + "|".join(re.escape(a[1:]) for a in group) + ")"
        for letter, group in groupby(by_letter, key=lambda a: a[0])
    ]
    return f"(?<!{WORD_CHAR})(?:{'|'.join(groups)})(?!{WORD_CHAR})"


def _usable(aliases: Aliases, unknown: int) -> dict[int, list[str]]:
    return {k: list(names) for k, names in sorted(aliases.items()) if names and k != unknown}


def vote(
    df: DataFrame,
    aliases: Aliases,
    unknown: int,
    title: str = "title_clean",
    body: str = "body_clean",
    out: str = "region_id",
    title_weight: int = 3,
    title_breaks_ties: bool = False,
) -> DataFrame:
    """Add the class with the highest ``title_weight * title hits + body hits``.

    Ties go to the lowest class id (with ``title_breaks_ties`` to the higher title
    count first); without any hit the class is ``unknown``.  Texts are expected
    folded.  When no alias of one class can overlap one of another, each text is
    searched once for all classes and only the hits are counted per class;
    otherwise every class searches on its own.
    """
    usable = _usable(aliases, unknown)
    if not usable:
        return df.withColumn(out, F.lit(unknown).cast("int"))
    if classes_overlap(usable):
        texts = {"_title_hits": F.col(title), "_body_hits": F.col(body)}
        patterns = {k: alias_pattern(names) for k, names in usable.items()}
    else:
        anything = alias_pattern([a for names in usable.values() for a in names])
        texts = {
            "_title_hits": F.array_join(_matches(title, anything), "\n"),
            "_body_hits": F.array_join(_matches(body, anything), "\n"),
        }
        patterns = {
            k: "(?m)^(?:" + "|".join(map(re.escape, names)) + ")$" for k, names in usable.items()
        }

    def hits(where: str, pattern: str) -> Column:
        return F.regexp_count(F.col(where), F.lit(pattern))

    ballots = []
    for key, pattern in patterns.items():
        in_title = hits("_title_hits", pattern)
        score = in_title * title_weight + hits("_body_hits", pattern)
        parts = [score.alias("score"), F.lit(-key).alias("neg_id")]
        if title_breaks_ties:
            parts.insert(1, in_title.alias("in_title"))
        ballots.append(F.struct(*parts))
    best = F.greatest(*ballots) if len(ballots) > 1 else ballots[0]
    return (
        df.withColumns(texts)
        .withColumn("_best", F.when((F.col("_title_hits") != "") | (F.col("_body_hits") != ""), best))
        .withColumn(
            "_class",
            F.when(F.col("_best.score") >= 1, -F.col("_best.neg_id")).otherwise(unknown).cast("int"),
        )
        # A filter by class must not reach below the search, where it would repeat it for
        # every mention of the class; none passes what explode gives.
        .withColumn(out, F.explode(F.array("_class")))
        .drop("_title_hits", "_body_hits", "_best", "_class")
    )


def _matches(column: str, pattern: str) -> Column:
    return F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0))
