"""Toxic documents by multiple-instance learning over sentences.

A document's label says that some sentence is toxic, not which.  A sentence
with evidence scores sigmoid(bias + weights of its features), one without
scores 0; a document is harmless if all of its sentences are and no leak
explains the label (noisy-or): score = 1 - (1 - leak) * prod(1 - p).  Weights are
fitted to document labels only, yet the sentence scores then locate what
offends.  The score doesn't rise with the length of a harmless text.

Features are a sentence's words and their beginnings (``PREFIXES`` letters), so
that inflected forms share what is learnt about their stem.  Evidence is what
occurs in toxic documents far more often than chance allows; its weights are
not negative.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintero.llm.common import ship_package, text_or_empty
from tintero.session import materialize

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
#: Labelled documents that the fit takes at most: those with the least hash of their id.
SAMPLE = 12_000
#: Least log-likelihood ratio of a feature's documents against chance.
EVIDENCE = 11.0
STEPS, RATE, DECAY = 300, 0.3, 1e-5
_SEED = 17


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence; a text without any is one empty sentence."""
    return [m.span() for m in SENTENCE.finditer(text)] or [(0, 0)]


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*{n}" for n in PREFIXES if len(word) >= n)]


class Known:
    """A set of features, with the beginnings that any word with one of them has."""

    def __init__(self, names):
        self.names = frozenset(names)
        self.starts = frozenset(n.split("*")[0][: min(PREFIXES)] for n in self.names)

    def candidates(self, text: str) -> list[str]:
        """Distinct words that begin like a word with a feature: few, found at little cost."""
        starts, size = self.starts, min(PREFIXES)
        return [w for w in set(WORD.findall(text)) if w[:size] in starts]

    def of(self, text: str) -> set[str]:
        return {f for w in self.candidates(text) for f in features(w) if f in self.names}


def evidence(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Features that occur in toxic documents too often for chance."""
    share = toxic.mean()
    bad, good = Counter(), Counter()
    for text in (t for t, label in zip(texts, toxic) if label):
        bad.update({f for w in set(WORD.findall(text)) for f in features(w)})
    bad = {f: n for f, n in bad.items() if -n * np.log(share) >= EVIDENCE}
    known = Known(bad)
    for text in (t for t, label in zip(texts, toxic) if not label):
        good.update(known.of(text))
    found = []
    for name, n in bad.items():
        every = n + good[name]
        excess = n * np.log(n / (every * share))
        if good[name]:
            excess += good[name] * np.log(good[name] / (every * (1 - share)))
        if n > every * share and excess >= EVIDENCE:
            found.append(name)
    return sorted(found)


def first_of_copies(texts: list[str]) -> list[int]:
    """Places of texts without later near copies: the words of one text must not pass for evidence.

    Texts with the same least hash of three-word shingles count as copies.
    """
    seen: dict[int, int] = {}
    for place, text in enumerate(texts):
        words = text.lower().split()
        shingles = map(" ".join, zip(words, words[1:], words[2:]))
        least = min((zlib.crc32(s.encode()) for s in shingles), default=-1 - place)
        seen.setdefault(least, place)
    return sorted(seen.values())


def fit(texts: list[str], labels: list[int]) -> tuple[dict[str, float], float, float]:
    """(weights, bias, leak) by full-batch steps with per-weight rates."""
    places = first_of_copies(texts)
    texts, toxic = [texts[i] for i in places], np.array([labels[i] for i in places], int)
    if not len(toxic) or toxic.min() == toxic.max():
        return {}, -4.0, float(toxic.mean()) if len(toxic) else 0.0
    texts = [t.lower() for t in texts]
    names = evidence(texts, toxic)
    number = {n: i for i, n in enumerate(names)}
    known = Known(number)
    columns, rows, bags = [], [], []
    for bag, text in enumerate(texts):
        for a, b in sentences(text) if known.of(text) else ():
            if held := known.of(text[a:b]):
                columns.extend(number[f] for f in sorted(held))
                rows.extend([len(bags)] * len(held))
                bags.append(bag)
    columns, rows, bags = (np.array(x, int) for x in (columns, rows, bags))
    bare = np.ones(len(texts), bool)
    bare[bags] = False
    leak = (toxic[bare].sum() + 0.1) / (bare.sum() + 2)
    weights, bias = np.full(len(names), 2.0), -2.0
    squares, bias_squares = np.full(len(names), 1e-8), 1e-8
    for _ in range(STEPS):
        z = np.bincount(rows, weights[columns], len(bags)) + bias
        softplus = np.logaddexp(0, z)
        harmless = np.bincount(bags, softplus, len(texts)) - np.log1p(-leak)
        # the slope of the loss by z: p in a harmless document, -p (1 - P) / P in a toxic one
        score = -np.expm1(-harmless)
        pull = np.where(toxic > 0, -(1 - score) / np.maximum(score, 1e-9), 1.0) / len(texts)
        slope = np.exp(z - softplus) * pull[bags]
        gradient = np.bincount(columns, slope[rows], len(names)) + DECAY * weights
        squares += gradient**2
        weights = np.maximum(0, weights - RATE * gradient / np.sqrt(squares))
        total = slope.sum()
        bias_squares += total**2
        bias = min(0.0, bias - RATE * total / np.sqrt(bias_squares))
    return dict(zip(names, weights.tolist())), float(bias), float(leak)


class Model:
    """A fitted model."""

    def __init__(self, weights: dict[str, float], bias: float, leak: float):
        self.weights, self.bias, self.leak = weights, bias, leak
        self.known = Known(f for f, w in weights.items() if w > 0)

    def score(self, text: str) -> tuple[float, float, int, int]:
        """(score, score of the worst sentence, its start and end); the sentence is empty without evidence."""
        low = text.lower()
        if len(low) != len(text):  # some capitals lower to two characters: keep places in the text as given
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        harmless, worst = -np.log1p(-self.leak), (0.0, 0, 0)
        if self.known.candidates(low):
            for a, b in sentences(low):
                if held := self.known.of(low[a:b]):
                    softplus = np.logaddexp(0, self.bias + sum(map(self.weights.__getitem__, sorted(held))))
                    harmless += softplus
                    worst = max(worst, (float(-np.expm1(-softplus)), -a, b))
        return float(-np.expm1(-harmless)), worst[0], -worst[1], worst[2]


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled rows that are not held out, by the least hash of the id."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
    order = F.xxhash64(F.col("doc_id"), F.lit(_SEED))
    chosen = known.select("doc_id", "toxic").orderBy(order, "doc_id", "toxic").limit(sample)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def train(rows: DataFrame) -> Broadcast:
    """The fitted model, sent to the executors.  ``rows`` is bounded by the sample and stored; one task fits them.

    Rows of one label only, or none, give a model without evidence.
    """
    spark = rows.sparkSession
    ship_package(spark)
    # stored first, so that the documents are read in parallel and the one task meets the sample alone
    rows = materialize(rows, "sample")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = sorted((t, y) for batch in batches for t, y in zip(batch["text"], batch["toxic"]))
        weights, bias, leak = fit([t for t, _ in every], [y for _, y in every])
        names = [*weights, "", ""]
        yield pd.DataFrame({"name": names, "value": [*weights.values(), bias, leak]})

    found = [(r.name, r.value) for r in rows.coalesce(1).mapInPandas(run, "name string, value double").collect()]
    found = found or [("", -4.0), ("", 0.0)]  # no rows at all: no task ran
    (_, bias), (_, leak) = found[-2:]
    return spark.sparkContext.broadcast((dict(found[:-2]), bias, leak))


def score(docs: DataFrame, model: Broadcast) -> DataFrame:
    """``docs`` with score, predicted, and the score, start and end of the sentence that offends most.

    ``score`` is between 0 and 1; a null or empty text scores as the leak alone.
    Columns named score, predicted, worst, start and end are replaced, all
    others pass unchanged.  Repeated rows score alike; an empty table gives an
    empty table.
    """
    ship_package(docs.sparkSession)
    kept = docs.drop("score", "predicted", "worst", "start", "end", "_scored")
    names = ["score", "worst", "start", "end"]

    @F.pandas_udf("score double, worst double, start int, end int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = Model(*model.value)
        for texts in batches:
            yield pd.DataFrame([fitted.score(t) for t in texts], columns=names)

    scored = kept.withColumn("_scored", run(text_or_empty()))
    predicted = (F.col("_scored.score") >= 0.5).cast("int").alias("predicted")
    return scored.select(*kept.columns, "_scored.score", predicted, "_scored.worst", "_scored.start", "_scored.end")
