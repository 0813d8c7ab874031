"""Repeated byte strings of a fixed length, by depth-limited radix passes over suffixes.

Every start of a ``width``-byte string is a suffix that matters through
``width`` bytes only.  The passes group suffixes by ever more of those bytes:

* First digit: the anchor, the ``width // 2`` bytes with the least rolling
  hash inside the string (leftmost of equals).  Equal strings have equal
  anchors at equal places, and neighbouring starts share an anchor, so this
  pass has one row per run of starts, about one per hundred bytes.
* Each following pass cuts the runs that are not decided into shorter ones,
  at places fixed by the anchor, down to single starts.  A run whose bytes
  all occur again is repeated as a whole; a run whose common bytes occur
  nowhere else is not; the others go on.

What is equal through all passes is exactly what is repeated.  Counts combine
before the shuffle, and one row stands for all copies in the next pass, so
large groups of copies cost no more than small ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tintero.llm.common import BROADCAST_BYTES, join_small, ship_package, text_or_empty
from tintero.session import materialize

WIDTH = 400
#: Lengths of the runs of starts in the passes after the first.
RUNS = (16, 1)
#: Runs of starts that are passed on together.
_RUNS_AT_ONCE = 200_000
_BASE = 0x9E3779B97F4A7C15
_U64 = (1 << 64) - 1
_PIECE = 1 << 22


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base & _U64, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


class Roller:
    """Hashes of all ``gram``-byte substrings, from running sums modulo 2^64."""

    def __init__(self, gram: int):
        self.gram, self.size = gram, 0

    def hashes(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > self.size:
            self.size = max(n, 1 << 16)
            self.up = _powers(_BASE, self.size)
            self.down = _powers(pow(_BASE, -1, 1 << 64), self.size)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
            h = (sums[self.gram :] - sums[: -self.gram]) * self.down[: n - self.gram + 1]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
        return h


def _sliding_least(keys: np.ndarray, window: int) -> np.ndarray:
    blocks = -(-len(keys) // window)
    padded = np.full(blocks * window, _U64, np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(blocks, window)
    from_left = np.minimum.accumulate(rows, axis=1).ravel()
    from_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(keys) - window + 1
    return np.minimum(from_right[:count], from_left[window - 1 : window - 1 + count])


def anchored_runs(data: bytes, width: int, roller: Roller) -> tuple[np.ndarray, ...]:
    """(anchor hash, anchor place, first start, last start) of the runs of starts that share an anchor.

    Long texts are done in overlapping pieces; a run may then be cut in two,
    which changes no decision.
    """
    window = width - roller.gram + 1
    found = []
    for at in range(0, len(data) - width + 1, _PIECE):
        part = np.frombuffer(data, np.uint8, min(len(data) - at, _PIECE + width - 1), at)
        h = roller.hashes(part)
        places = np.arange(len(h), dtype=np.uint64)
        keys = (h & np.uint64(0xFFFFFFFF00000000)) | places
        anchor = (_sliding_least(keys, window) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:], len(anchor)] - 1
        found.append((h[anchor[first]].view(np.int64), anchor[first] + at, first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*found))


def _named() -> list[Column]:
    """(doc, body): the id and 64 bits of the text; a row without an id is known by 128 bits of its text."""
    text = text_or_empty()
    doc = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no id"), text))
    return [doc.alias("doc"), F.xxhash64(text).alias("body")]


def _texts(docs: DataFrame) -> DataFrame:
    """(doc, body, data): bytes of the text, by id and a hash that tells texts of one id apart."""
    return docs.select(*_named(), text_or_empty().cast("binary").alias("data"))


_RUN = "core {core}, whole {core}, doc long, body long, anchor int, a int, b int, copies int"


def _first_pass(width: int):
    def frame(found: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        core, anchor, a, b, whole, doc, body = map(np.concatenate, zip(*found))
        places = {name: x.astype(np.int32) for name, x in (("anchor", anchor), ("a", a), ("b", b))}
        return pd.DataFrame({"core": core, "whole": whole, "doc": doc, "body": body} | places | {"copies": np.int32(1)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roller, found, size = Roller(width // 2), [], 0
        for batch in batches:
            for doc, body, data in zip(batch["doc"], batch["body"], batch["data"]):
                if len(data) < width:
                    continue
                core, anchor, a, b = anchored_runs(data, width, roller)
                whole = [
                    xxh3_64_intdigest(data[i : j + width], seed=p - i)
                    for p, i, j in zip(anchor.tolist(), a.tolist(), b.tolist())
                ]
                whole = np.array(whole, np.uint64).view(np.int64)
                found.append((core, anchor, a, b, whole, np.full(len(a), doc), np.full(len(a), body)))
                size += len(a)
                if size >= _RUNS_AT_ONCE:
                    yield frame(found)
                    found, size = [], 0
        if found:
            yield frame(found)

    return run


def _next_pass(width: int, size: int):
    """Cut runs at multiples of ``size`` before the anchor; hash what a cut's starts share and all they cover."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, body, data, runs in zip(batch["doc"], batch["body"], batch["data"], batch["runs"]):
                for one in runs:
                    anchor, copies = one["anchor"], one["copies"]
                    far, near = anchor - one["a"], anchor - one["b"]
                    for low in range(near - near % size, far + 1, size):
                        high = min(low + size - 1, width - width // 2)
                        a, b = anchor - min(far, high), anchor - max(near, low)
                        core = xxh3_128_digest(data[anchor - low : anchor - high + width])
                        whole = core if size == 1 else xxh3_128_digest(data[a : b + width], seed=anchor - a)
                        rows.append((core, whole, doc, body, anchor, a, b, copies))
            yield pd.DataFrame(rows, columns=["core", "whole", "doc", "body", "anchor", "a", "b", "copies"])

    return run


def _classes(runs: DataFrame) -> DataFrame:
    """Per distinct content: its copies, and one of them."""
    one = F.min(F.struct("doc", "body", "anchor", "a", "b")).alias("one")
    return runs.groupBy("core", "whole").agg(F.sum("copies").alias("n"), one)


def _repeated_cores(runs: DataFrame) -> DataFrame:
    return runs.groupBy("core").agg(F.sum("copies").alias("n")).where("n > 1").select("core")


_WHERE = ["doc", "body", "anchor", "a", "b"]


def _pass(runs: DataFrame, core_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Runs repeated as a whole, and the runs for the next pass."""
    shared = materialize(_repeated_cores(runs), "shared-cores")
    left = materialize(join_small(runs, shared, ["core"], "left_semi", core_bytes + 16), "shared-runs")
    classes = materialize(_classes(left), "run-classes")
    several = materialize(classes.where("n > 1").select("core", "whole"), "repeated-runs")
    by_whole = ["core", "whole"]
    repeated = join_small(left.where("copies = 1"), several, by_whole, "left_semi", 2 * core_bytes + 16)
    single = classes.where("n = 1")
    undecided = materialize(single.select("core").distinct(), "undecided-cores")
    stand_ins = join_small(classes.where("n > 1"), undecided, ["core"], "left_semi", core_bytes + 16)
    onward = single.select("one.*", F.lit(1).alias("copies")).union(stand_ins.select("one.*", F.lit(2).alias("copies")))
    return repeated.select("doc", "body", "a", "b"), onward


@F.pandas_udf(T.ArrayType(T.LongType()))
def _merged(spans: pd.Series) -> pd.Series:
    """Union of half-open spans, each packed as start * 2^32 + end."""
    out = []
    for packed in spans:
        packed = np.sort(np.asarray(packed, np.int64))
        start, end = packed >> 32, np.maximum.accumulate(packed & 0xFFFFFFFF)
        new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
        out.append((start[new] << 32) | end[np.r_[new[1:], len(end)] - 1])
    return pd.Series(out)


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, body, spans): per text the maximal runs of bytes covered by repeated strings, packed."""
    texts = _texts(docs)
    runs = materialize(texts.mapInPandas(_first_pass(width), _RUN.format(core="long")), "runs")
    repeated, onward = _pass(runs, 8)
    covered = [repeated]
    for size in RUNS:
        runs_of = onward.groupBy("doc", "body").agg(
            F.collect_list(F.struct("anchor", "a", "b", "copies")).alias("runs")
        )
        runs_of = materialize(runs_of, "open-runs")
        bytes_ = runs_of.agg(F.sum(F.size("runs") * 32 + 64)).first()[0] or 0
        if not bytes_:
            break
        side = F.broadcast(runs_of) if bytes_ <= BROADCAST_BYTES else runs_of
        cut = texts.join(side, ["doc", "body"]).mapInPandas(_next_pass(width, size), _RUN.format(core="binary"))
        repeated, onward = _pass(materialize(cut, "runs"), 16)
        covered.append(repeated)
    every = covered[0]
    for more in covered[1:]:
        every = every.union(more)
    packed = F.shiftleft(F.col("a").cast("long"), 32) + F.col("b") + width
    spans = every.groupBy("doc", "body").agg(F.collect_list(packed).alias("spans"))
    return spans.select("doc", "body", _merged("spans").alias("spans"))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        kept, removed, count = [], [], []
        for data, spans in zip(batch["data"], batch["spans"]):
            at, parts, spans = 0, [], [] if spans is None else spans
            for span in map(int, spans):
                parts.append(data[at : span >> 32])
                at = span & 0xFFFFFFFF
            parts.append(data[at:])
            kept.append(b"".join(parts))
            removed.append(len(data) - len(kept[-1]))
            count.append(len(spans))
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "n_bytes": batch["data"].map(len), "n_removed": removed,
            "n_spans": count, "kept": kept,
        })


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for each row of ``docs(doc_id, text)``.

    Removes each byte of the UTF-8 text that lies in a ``width``-byte string
    which also starts elsewhere, in this text or another; strings are judged
    on the input.  ``kept`` is binary, since a cut may fall inside a character.
    Null texts count as empty, texts below ``width`` bytes stay whole, repeated
    rows are copies of each other, null ids are carried along, other columns
    are ignored, an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    spans = materialize(repeated_spans(docs, width), "repeated-spans")
    bytes_ = spans.agg(F.sum(F.size("spans") * 8 + 64)).first()[0] or 0
    side = F.broadcast(spans) if bytes_ <= BROADCAST_BYTES else spans
    data = text_or_empty().cast("binary").alias("data")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_named(), data)
    rows = rows.join(side, ["doc", "body"], "left").select("doc_id", "data", "spans")
    return rows.mapInPandas(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
