"""SimHash near-duplicates found with Burkhard-Keller trees.

Two fingerprints within ``radius`` bits of each other agree in at least one of
``radius + 1`` blocks of their bits.  Every distinct fingerprint goes to one
shard per block, named by the block's value.  A shard's tree keeps its
children by integer Hamming distance to the parent; a search follows only the
edges within the radius of the distance at hand.

A shard above ``tree_nodes`` fingerprints is dealt out again by blocks of the
bits that its members don't share yet, until it fits.  Since a shard with f
free bits can't hold more than 2^f distinct fingerprints, this ends, however
many near copies there are, and every tree has a bounded size.  The trees
together grow with the data, so they are not broadcast: the fingerprints of a
shard meet in the task that builds its tree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tintero.llm.common import join_small, join_spread, ship_package, text_or_empty
from tintero.llm.graph import connected_components
from tintero.session import materialize

SEED = 42
TREE_NODES = 4096
_CHUNK = 1 << 16


def fingerprint(text: bytes, words: int) -> int:
    """The majority fingerprint of the text's word shingles, 0 for a text without words."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = [b" ".join(s) for s in zip(*(found[i:] for i in range(words)))]
    ones = np.zeros(64, np.int64)
    for start in range(0, len(shingles), _CHUNK):
        part = shingles[start : start + _CHUNK]
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in part), "<u8", len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(words: int):
    @F.pandas_udf(T.LongType())
    def udf(texts: pd.Series) -> pd.Series:
        values = [fingerprint(t.encode(), words) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return udf


class BKTree:
    """A tree over integers whose children hang by Hamming distance."""

    def __init__(self, root: int):
        self.values, self.children = [root], [{}]

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [0]
        while stack:
            at = stack.pop()
            distance = (value ^ self.values[at]).bit_count()
            if distance <= radius:
                yield self.values[at]
            children = self.children[at]
            for edge in range(distance - radius, distance + radius + 1):
                if edge in children:
                    stack.append(children[edge])

    def add(self, value: int) -> None:
        at = 0
        while distance := (value ^ self.values[at]).bit_count():
            following = self.children[at].setdefault(distance, len(self.values))
            if following == len(self.values):
                self.values.append(value)
                self.children.append({})
                return
            at = following


def shard_links(values: Iterable[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what the radius joins: a spanning forest of the shard."""
    values = iter(values)
    tree = BKTree(first := next(values))
    root = {first: first}
    links = []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for value in values:
        root.setdefault(value, value)
        for other in tree.within(value, radius):
            a, b = top(value), top(other)
            if a != b:
                root[a] = b
                links.append((value, other))
        tree.add(value)
    return links


def _block_key(value: Column, lowest: int, width: int) -> Column:
    return F.shiftrightunsigned(value, lowest).bitwiseAND(F.lit((1 << width) - 1))


def _cuts(size: int, parts: int) -> list[int]:
    return [size * i // parts for i in range(parts + 1)]


def _free_bits(shard: str, parts: int) -> list[int]:
    """Bits that the members of a shard need not share; the shard's name lists its blocks."""
    free = list(range(64))
    for step in shard.split("/"):
        block = int(step.split(":")[0])
        cuts = _cuts(len(free), parts)
        free = free[: cuts[block]] + free[cuts[block + 1] :]
    return free


def _finer(parts: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shards, values = [], []
            for shard, value in zip(batch["shard"], batch["fp"]):
                free = _free_bits(shard, parts)
                cuts = _cuts(len(free), parts)
                for block in range(parts):
                    bits = free[cuts[block] : cuts[block + 1]]
                    key = sum((int(value) >> bit & 1) << i for i, bit in enumerate(bits))
                    shards.append(f"{shard}/{block}:{key:x}")
                    values.append(value)
            yield pd.DataFrame({"shard": shards, "fp": values})

    return split


def _tree_links(radius: int):
    mask = (1 << 64) - 1

    def signed(values: list[int]) -> np.ndarray:
        return np.array(values, np.uint64).view(np.int64)

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, members = None, []

        def close() -> pd.DataFrame | None:
            found = shard_links(members, radius) if len(members) > 1 else []
            if not found:
                return None
            return pd.DataFrame({"u": signed([a for a, _ in found]), "v": signed([b for _, b in found])})

        for batch in batches:
            for name, value in zip(batch["shard"].tolist(), batch["fp"].tolist()):
                if name != shard:
                    if (done := close()) is not None:
                        yield done
                    shard, members = name, []
                members.append(value & mask)
        if shard is not None and (done := close()) is not None:
            yield done

    return links


def near_links(nodes: DataFrame, radius: int, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links (u, v) between the distinct values ``nodes.fp`` that join what the radius joins."""
    parts = radius + 1
    cuts = _cuts(64, parts)
    keys = [
        F.concat(F.lit(f"{b}:"), F.hex(_block_key(F.col("fp"), cuts[b], cuts[b + 1] - cuts[b])))
        for b in range(parts)
    ]
    rows = nodes.select(F.explode(F.array(*keys)).alias("shard"), "fp")
    fitting = []
    while True:
        sizes = rows.groupBy("shard").agg(F.count("*").alias("n"))
        large = materialize(sizes.where(F.col("n") > tree_nodes).select("shard"), "large-shards")
        if large.isEmpty():
            fitting.append(rows)
            break
        fitting.append(join_small(rows, large, ["shard"], "left_anti", 64))
        hot = join_small(rows, large, ["shard"], "left_semi", 64)
        rows = materialize(hot.mapInPandas(_finer(parts), "shard string, fp long"), "finer-shards")
    links = None
    for level in fitting:
        together = level.repartition("shard").sortWithinPartitions("shard")
        found = together.mapInPandas(_tree_links(radius), "u long, v long")
        links = found if links is None else links.union(found)
    return links


def _groups(marked: DataFrame, radius: int, tree_nodes: int) -> DataFrame:
    """(fp, first, group_size) per distinct fingerprint of the stored ``marked(fp, doc_id, row)``, stored.

    ``first`` is the smallest (no_id, doc_id, row) of the group, so a row without an id comes last.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    nodes = materialize(marked.groupBy("fp").agg(first, F.count("*").alias("n")), "nodes")
    roots = connected_components(near_links(nodes, radius, tree_nodes))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialize(rooted.select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "rooted")
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    named = join_spread(rooted.select("fp", "root"), materialize(groups, "groups"), ["root"], 64)
    return materialize(named.select("fp", "first", "group_size"), "named-fingerprints")


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, tree_nodes: int = TREE_NODES, id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, fingerprint, component_id, group_size) for each row of ``docs(doc_id, text)``.

    A null or blank text has fingerprint zero and is linked like any other.
    Repeated rows stay repeated.  A null id is carried along and never names a
    component unless all ids of the component are null.  An empty table gives
    an empty result; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    marked = docs.select(
        F.col(id_col).alias("doc_id"), fingerprints(words)(text_or_empty()).alias("fp"), F.lit(0).alias("row")
    )
    marked = materialize(marked, "fingerprints")
    groups = _groups(marked, radius, tree_nodes)
    found = join_spread(marked.select("doc_id", "fp"), groups, ["fp"], 64)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(
        "doc_id", hexed.alias("fingerprint"), F.col("first.doc_id").alias("component_id"), "group_size"
    )


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2, tree_nodes: int = TREE_NODES) -> DataFrame:
    """One row of ``docs`` of each group of near duplicates, the one with the smallest id.

    Rows are told apart by a number of their own, so repeated ids and rows
    without an id are treated like any other; a row without an id stays only
    where its whole group has none.
    """
    ship_package(docs.sparkSession)
    numbered = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    marked = numbered.select("row", "doc_id", fingerprints(words)(text_or_empty()).alias("fp"))
    marked = materialize(marked, "fingerprints")
    found = join_spread(marked.select("row", "fp"), _groups(marked, radius, tree_nodes), ["fp"], 64)
    gone = materialize(found.where(F.col("row") != F.col("first.row")).select("row"), "near-copies")
    return join_small(numbered, gone, ["row"], "left_anti", 16).drop("row")
