"""Benchmark items inside documents, found up to a budget of edits.

Pigeonhole: an item of length n is given a budget of k edits and is cut into
k + 1 pieces; wherever it occurs with at most k edits, one piece occurs
unchanged.  One automaton finds all pieces of all items in a text; around
each hit the edit distance is computed bit-parallel (Myers 1999) and decides.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintero.llm.common import ship_package, text_or_empty

EDIT_SHARE = 0.08
#: Characters of benchmark text that are sent to the executors at once.
BLOCK_CHARS = 4_000_000


def plain(text: str) -> str:
    """Lower case, runs of white space as one blank."""
    return " ".join(text.lower().split())


def edit_budget(item: str, share: float) -> int:
    return int(len(item) * share)


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``budget + 1`` pieces of nearly equal length."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def best_end(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of the item to any substring of the text, and where that first ends."""
    size = len(item)
    mask, top = (1 << size) - 1, 1 << (size - 1)
    at: dict[str, int] = defaultdict(int)
    for i, char in enumerate(item):
        at[char] |= 1 << i
    above, below, score = mask, 0, size
    best, end = size, 0
    for j, char in enumerate(text, 1):
        equal = at.get(char, 0)
        vertical = equal | below
        diagonal = (((equal & above) + above) ^ above) | equal
        up = below | (~(diagonal | above) & mask)
        down = above & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & mask, down << 1 & mask
        above = down | (~(vertical | up) & mask)
        below = up & vertical
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Items of one block, with the automaton of their pieces."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        self.items = [(item_id, text, edit_budget(text, share)) for item_id, text in items if text]
        where = defaultdict(list)
        for number, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                where[piece].append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of the stretches that can hold an item; they overlap at most within an item."""
        starts = defaultdict(set)
        for last, (length, places) in self.automaton.iter(text):
            for number, offset in places:
                starts[number].add(last - length + 1 - offset)
        for number, found in starts.items():
            _, item, budget = self.items[number]
            low = high = None
            for start in sorted(found):
                if low is not None and start - high > budget:
                    yield number, low - budget, high + len(item) + budget
                    low = None
                low, high = start if low is None else low, start
            yield number, low - budget, high + len(item) + budget

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end) of the best occurrence of each item in a plain text."""
        if self.empty or not text:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        for number, low, high in self.windows(text):
            _, item, budget = self.items[number]
            low = max(0, low)
            window = text[low:high]
            edits, end = best_end(item, window)
            if edits <= budget and (number not in best or (edits, low + end) < best[number][:2]):
                _, back = best_end(item[::-1], window[:end][::-1])
                best[number] = (edits, low + end, low + end - back)
        return [(self.items[n][0], edits, start, end) for n, (edits, end, start) in sorted(best.items())]


def _search(block, share: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(block.value, share)
        for batch in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch["doc_id"], batch["text"])
                for match in matcher.matches(plain(text))
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "start", "end"])
            yield out.astype({c: "Int64" for c in out.columns})

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, item_id, edits, start, end) for every document that holds an item within its budget.

    The budget is ``share`` of the item's length, rounded down.  Case and runs
    of white space don't count; ``start`` and ``end`` are code points of the
    text so normalised, of the occurrence with the fewest edits, the first of
    equals.  Null or blank texts and items match nothing; null ids are carried
    along; repeated rows and repeated items are each reported.  The benchmark
    is the query set: it is searched in blocks of about ``block_chars``, each
    against all documents, so no block grows with either table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = "doc_id long, item_id long, edits long, start long, end long"
    items = benchmark.select("item_id", text_or_empty().alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_chars))
    corpus = docs.select("doc_id", text_or_empty().alias("text"))
    found = None
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        block = spark.sparkContext.broadcast([(r.item_id, plain(r.text)) for r in rows])
        part = corpus.mapInPandas(_search(block, share), schema)
        found = part if found is None else found.union(part)
    return found
