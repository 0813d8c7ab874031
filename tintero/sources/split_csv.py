"""Records of CSV files too large for one task each.

Quoted line breaks keep Spark's reader from splitting a file.  Here the files are
read as lines, in parallel, and lines are put together again: a line starts a
record unless the number of quotes before it in the file is odd.  A first pass
counts the quotes of each split; with the sum over the splits before, a second
one goes through each split once and puts its lines together.  Only the pieces
of records that two or more splits share are moved to meet, at most two a split.
Holds for files that quote as RFC 4180 says.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tintero.session import materialize

SPLIT = ["file", "block"]
#: Bytes of split names up to which every task is sent the quotes before each split.
BROADCAST_BYTES = 32 << 20
_PIECES = "file string, block long, record long, at long, cut boolean, piece string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            (quotes % 2).alias("odd"),
            "value",
        )
    )


def _open_at_start(lines: DataFrame) -> DataFrame:
    """``(file, block, carried)``: 1 for splits that begin inside a quoted field.  One row per split."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = lines.groupBy(*SPLIT).agg(F.sum("odd").alias("odd"))
    return odd.select(*SPLIT, (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("carried"))


class _Split:
    """The records of one split, of which lines are added in their order."""

    def __init__(self, file: str, block: int, carried: int):
        self.file, self.block, self.inside = file, block, carried
        self.lines = self.record = 0  # of what is done, and of the record in hand
        self.at, self.parts = 1, []  # where the record in hand starts, and its lines so far

    def _rows(self, records: Sequence[int], at: Sequence[int], cut: bool, pieces: pa.Array) -> pa.RecordBatch:
        n = len(pieces)
        places = [pa.array(np.full(n, self.block)), pa.array(records, pa.int64()), pa.array(at, pa.int64())]
        columns = [pa.array([self.file] * n, pa.string()), *places, pa.array(np.full(n, cut)), pieces]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "record", "at", "cut", "piece"])

    def _in_hand(self, cut: bool) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield self._rows([self.record], [self.at], cut, pa.array(["\n".join(self.parts)], pa.string()))

    def add(self, odd: np.ndarray, values: pa.Array) -> Iterator[pa.RecordBatch]:
        inside = (self.inside + np.cumsum(odd)) % 2
        starts = np.flatnonzero(np.r_[self.inside, inside[:-1]] == 0)
        self.inside = int(inside[-1])
        first = int(starts[0]) if len(starts) else len(values)
        self.parts += values[:first].to_pylist()
        if len(starts):
            # the rest of a record of an earlier split, number 0, is a piece even if it ends here
            yield from self._in_hand(cut=self.record == 0)
            closed = values[first : starts[-1]]
            offsets = pa.array((starts - first).astype(np.int32))
            pieces = pc.binary_join(pa.ListArray.from_arrays(offsets, closed), "\n")
            records = np.arange(len(starts) - 1) + self.record + 1
            if len(pieces):
                yield self._rows(records, self.lines + 1 + starts[:-1], False, pieces)
            self.record += len(starts)
            self.at, self.parts = self.lines + 1 + int(starts[-1]), values[starts[-1] :].to_pylist()
        self.lines += len(values)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._in_hand(cut=self.record == 0 or self.inside == 1)


def _forward(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over the lines of one split after the other; holds a batch and the record in hand."""
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block, carried = (batch.column(n) for n in (*SPLIT, "carried"))
        if carried.null_count:
            raise ValueError("the files were split in another way than a moment ago: fix spark.sql.files.maxPartitionBytes")
        odd = batch.column("odd").to_numpy(zero_copy_only=False)
        other = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        edges = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            name, offset = file[start].as_py(), block[start].as_py()
            if split is None or (split.file, split.block) != (name, offset):
                if split is not None:
                    yield from split.end()
                split = _Split(name, offset, carried[start].as_py())
            yield from split.add(odd[start:stop], batch.column("value")[start:stop])
    if split is not None:
        yield from split.end()


def _pieces(lines: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``(file, block, record, at, cut, piece)``: the part of each record that lies in one split.

    ``record`` counts the records that start in the split; 0 is the rest of one
    that started in an earlier split.  ``cut`` marks what isn't a whole record.
    Lines stay where they are read, unless the names of the splits are too many
    for a broadcast: then the lines of a split meet in a task and are sorted.
    """
    carried = materialize(_open_at_start(lines), "csv-quotes")
    size = carried.agg(F.sum(F.octet_length("file") + 32)).first()[0] or 0
    if size <= limit:
        placed = lines.join(F.broadcast(carried), SPLIT, "left")
    else:
        placed = lines.join(carried, SPLIT, "left").repartition(*SPLIT).sortWithinPartitions(*SPLIT, "line")
    return placed.select(*SPLIT, "carried", "odd", "value").mapInArrow(_forward, _PIECES)


def _no_header(columns: Sequence[str]) -> Column:
    """False for a file's first record; an error if that isn't the header ``columns``."""
    names = F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(columns))), {"quote": '"', "escape": '"'})
    as_expected = F.array(*[names[f"c{i}"] for i in range(len(columns))]) == F.array(*map(F.lit, columns))
    other = F.raise_error(F.concat(F.lit("another header in "), "file")).cast("boolean")
    first = (F.col("block") == 0) & (F.col("record") == 1)
    return F.when(~first, True).when(F.coalesce(as_expected, F.lit(False)), False).otherwise(other)


def _rejoined(cut: DataFrame) -> DataFrame:
    """``(file, block, record, at, piece)`` of the records whose pieces lie in several splits.

    A piece belongs to the last head at or before it: a head has a number, what
    follows it in later splits has none.  Only names and numbers are ordered by
    file; a record's pieces meet by its head.
    """
    in_file = Window.partitionBy("file").orderBy("block", "record")
    head = F.when(F.col("record") > 0, F.struct("block", "record", "at"))
    owners = cut.select(*SPLIT, "record", F.last(head, ignorenulls=True).over(in_file).alias("head"))
    parts = F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("parts")
    met = cut.drop("at").join(owners, [*SPLIT, "record"]).groupBy("file", "head").agg(parts)
    return met.select("file", "head.*", F.array_join("parts.piece", "\n").alias("piece"))


def csv_records(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(file, position, text)`` of every record but blank lines and the header, which must be ``columns``.

    ``position`` increases along the file: split offset plus line number, which
    is below the next offset as a line takes at least one byte.  ``text`` is as
    written, line ends inside fields included, without the line end after it.
    """
    pieces = materialize(_pieces(_lines(spark, path), limit), "csv-pieces")
    names = [*SPLIT, "record", "at", "piece"]
    records = pieces.where("NOT cut").select(*names).union(_rejoined(pieces.where("cut")).select(*names))
    return (
        records.withColumn("text", F.rtrim("piece", F.lit("\r")))
        .where(_no_header(columns))
        .select("file", (F.col("block") + F.col("at") - 1).alias("position"), "text")
        .where(F.trim("text") != "")
    )
