"""What each of several filters removes, in every order of applying them.

Whether a text has a smaller copy elsewhere is known only when all files have
been read, so files are processed as a stream of available-now micro-batches.
A document is counted at once as the first of its text.  State keyed by the
text's digest, in buckets of bounded size, holds the least id met so far and
what was counted for it.  When
a smaller id arrives, the earlier count is retracted and entered again with the
copy filter's bit; when a larger one arrives, that one's is.  The counters of a
part are the sums of this log of entries and retractions.

Before the shuffle each task keeps, per text, only the rows of its least id;
the others are copies for certain.  So a text that a third of all rows share
sends one row a task to its state.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tintero.llm.common import join_small, ship_package, sliced
from tintero.session import scratch_path

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Least number of micro-batches that the files are dealt to, most bytes of one, and of the input that a state partition serves.
BATCHES, BATCH_BYTES, STATE_BYTES = 3, 1 << 40, 64 << 20
#: Bytes of input whose texts share one state: a call of the state function costs more than many of its rows.
BUCKET_BYTES = 1 << 20
#: Texts that a task holds before it passes them on.
HELD_TEXTS = 50_000

_UPPER, _SYMBOLS = bytes(range(0x41, 0x5B)), b"#$%&*|"
_ENTRY = "part string, mask int, good boolean, toxic boolean, n long"
_KEYED = "key binary, id long, mask int, part string, good boolean, toxic boolean, n long"
_STATE = "texts binary"
_SCHEMA = pa.schema([
    ("key", pa.binary()), ("id", pa.int64()), ("mask", pa.int32()), ("part", pa.string()),
    ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64()),
])


def failed(text: bytes, code_points: int) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails."""
    words = text.split()
    shouted = len(text) - len(text.translate(None, _UPPER))
    checks = (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * shouted > 10 * code_points,
        len(text.translate(None, _SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, fails in enumerate(checks) if fails)


def _first_entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (null key) and, per text, the rows of the task's least id (keyed by digest).

    Every row is entered once: as a copy if the task holds a smaller id of its
    text, otherwise as the first.  Rows without an id have no smaller one.
    """
    entered: Counter = Counter()
    least: dict[bytes, tuple[int, int, Counter]] = {}
    def passed_on() -> Iterator[pa.RecordBatch]:
        rows = []
        for key, (doc_id, mask, held) in least.items():
            rows += [(key, doc_id, mask, *row, n) for row, n in held.items()]
            for (part, good, toxic), n in held.items():
                entered[mask, part, good, toxic] += n
        # entries need no state; keys of their own spread them
        rows += [(None, i, *entry, n) for i, (entry, n) in enumerate(entered.items())]
        least.clear()
        entered.clear()
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    for batch in sliced(batches):
        lengths = pc.utf8_length(batch.column("text")).to_pylist()
        names = ("doc_id", "part", "text", "good", "toxic")
        ids, parts, texts, goods, toxics = (batch.column(c).to_pylist() for c in names)
        for doc_id, part, text, good, toxic, length in zip(ids, parts, texts, goods, toxics, lengths):
            data = text.encode()
            key = hashlib.sha256(data).digest()
            earlier = least.get(key)
            mask = failed(data, length) if earlier is None else earlier[1]
            row = (part, good, toxic)
            if doc_id is None:
                entered[mask, part, good, toxic] += 1
            elif earlier is None or doc_id < earlier[0]:
                for (p, g, t), n in earlier[2].items() if earlier else ():
                    entered[mask | COPY, p, g, t] += n
                least[key] = (doc_id, mask, Counter([row]))
            elif doc_id == earlier[0]:
                earlier[2][row] += 1
            else:
                entered[mask | COPY, part, good, toxic] += 1
        if len(least) > HELD_TEXTS:
            yield from passed_on()
    yield from passed_on()


def _moved(rows: Counter, mask: int) -> list[tuple]:
    """Retraction of rows counted as the first of their text, and their entries as copies."""
    taken = [(p, mask, g, t, -n) for (p, g, t), n in rows.items()]
    return taken + [(p, mask | COPY, g, t, n) for (p, g, t), n in rows.items()]


def _stored(texts: dict[bytes, tuple[int, int, Counter]]) -> bytes:
    """The texts of a state as an Arrow table, a row for each kind of row counted as first."""
    rows = [(key, at, mask, *row, n) for key, (at, mask, held) in texts.items() for row, n in held.items()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _SCHEMA) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _restored(data: bytes) -> dict[bytes, tuple[int, int, Counter]]:
    texts: dict[bytes, tuple[int, int, Counter]] = {}
    with pa.ipc.open_stream(data) as reader:
        for batch in reader:
            for key, at, mask, part, good, toxic, n in zip(*(c.to_pylist() for c in batch.columns)):
                texts.setdefault(key, (at, mask, Counter()))[2][part, good, toxic] += n
    return texts


def _retract(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Log rows that the arrivals of a bucket of texts cause; entries (no text key) pass as they are."""
    columns = ["part", "mask", "good", "toxic", "n"]
    texts = _restored(state.get[0]) if state.exists else {}
    changed, log = False, []
    for frame in frames:
        for text, doc_id, *entry in zip(*(frame[c].tolist() for c in ["key", "id", *columns])):
            if text is None:
                log.append(tuple(entry))
                continue
            part, row_mask, good, toxic, n = entry
            arrived = Counter({(part, good, toxic): n})
            at, mask, held = texts.get(text, (None, 0, Counter()))
            if at is None or doc_id < at:
                log += _moved(held, mask)
                texts[text], changed = (doc_id, row_mask, arrived), True
            elif doc_id == at:
                texts[text], changed = (at, mask, held + arrived), True
            else:
                log += _moved(arrived, row_mask)
    if changed:
        state.update((_stored(texts),))
    if log:
        yield pd.DataFrame(log, columns=columns)


def _streaming_session(spark: SparkSession, size: int) -> SparkSession:
    """A session of the same application with state partitions by the size of the input."""
    session = spark.newSession()
    splits = "spark.sql.files.maxPartitionBytes"
    session.conf.set(splits, spark.conf.get(splits))
    session.conf.set("spark.sql.shuffle.partitions", str(max(8, -(-size // STATE_BYTES))))
    return session


def _input_files(spark: SparkSession, path: str) -> tuple[int, int, str]:
    """Number of the table's files, their bytes, and a path that a stream takes, as Spark lists them.

    A stream wants a folder or a pattern, so a table of one file is named by a pattern that fits nothing else.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    row = files.select("path", "length").agg(F.count("*"), F.sum("length"), F.min("path")).first()
    path = path.rstrip("/")
    name = path.rsplit("/", 1)[-1]
    single = row[0] == 1 and row[2].rsplit("/", 1)[-1] == name
    return row[0], row[1] or 0, f"{path[:-1]}[{path[-1]}]" if single else path


def part_counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n): documents of the Parquet table at ``path`` by the filters that they fail.

    ``labels(doc_id, quality, toxic)`` may label an id several times; any 1 counts.
    """
    ship_package(spark)
    schema = spark.read.parquet(path).schema
    n_files, size, path = _input_files(spark, path)
    session = _streaming_session(spark, size)
    marks = labels.groupBy(F.col("doc_id").alias("_doc")).agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")
    )
    marked = scratch_path(spark, "marks")
    marks.where("_doc IS NOT NULL AND (good OR toxic)").write.parquet(marked)
    marks = session.read.schema("_doc long, good boolean, toxic boolean").parquet(marked)
    per_batch = -(-n_files // max(batches, -(-size // BATCH_BYTES)))
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)
    stream = stream.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    no = F.lit(False)
    stream = join_small(stream.withColumn("_doc", F.col("doc_id")), marks, ["_doc"], "left", 16)
    stream = stream.withColumns({c: F.coalesce(c, no) for c in ("good", "toxic")})
    keyed = stream.select("doc_id", "part", "text", "good", "toxic").mapInArrow(_first_entries, _KEYED)
    # entries have no text: a hash of the entry and its place spreads them
    buckets = F.lit(max(1, -(-size // BUCKET_BYTES)))
    keyed = keyed.withColumn("bucket", F.pmod(F.coalesce(F.xxhash64("key"), F.xxhash64("part", "mask", "id")), buckets))
    log = keyed.groupBy("bucket").applyInPandasWithState(
        _retract, _ENTRY, _STATE, "append", GroupStateTimeout.NoTimeout
    )
    out = scratch_path(spark, "retractions")
    query = log.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "retraction-state")
    ).trigger(availableNow=True).outputMode("append").start()
    query.awaitTermination()
    entries = spark.read.schema(_ENTRY).parquet(out)
    sums = entries.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return sums.where("n <> 0")


def _steps() -> list[dict]:
    """Every step of every order: its filter's bit and the bits of the filters before it."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "letter": letter, "bit": bit, "before": before})
            before |= bit
    return steps


def interactions(counters: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    schema = "array<struct<filter_order:string,step:int,letter:string,bit:int,before:int>>"
    steps = F.explode(F.from_json(F.lit(json.dumps(_steps())), schema)).alias("s")
    rows = counters.select("*", steps).select("part", "mask", "good", "toxic", "n", "s.*")
    fails, earlier = F.expr("mask & bit <> 0"), F.expr("mask & before <> 0")
    removed = fails & ~earlier

    def total(rows_counted: Column) -> Column:
        return F.sum(F.when(rows_counted, F.col("n")).otherwise(F.lit(0).cast("long")))

    steps = rows.groupBy("part", "filter_order", "step", "letter").agg(
        total(~earlier & ~fails).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.expr("mask = bit")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return steps.withColumn("shapley", shapley).drop("letter")


def filter_interactions(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The interactions of the filters over the Parquet table ``documents(doc_id, text, lang)`` at ``path``.

    A: under 100 words; B: distinct words under 80 in 100; C: A-Z over 10 in
    100 code points; D: a character of ``#$%&*|``; E: the text of a smaller id.
    Null texts count as empty, null languages as the part ''.  A row without an
    id has no smaller id and is smaller than none.  Rows that repeat an id and
    a text are all first or all copies.  Other columns are ignored; an empty
    table gives an empty result.
    """
    return interactions(part_counters(spark, path, labels, batches))
