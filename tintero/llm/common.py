"""What several operators share: column handling, checked broadcasts, folding of ASCII."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero.session import materialize

#: The white space of the contracts: blank and the characters 9 to 13.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Largest side, in bytes, that a join sends to every executor.
BROADCAST_BYTES = 32 << 20

#: Rows of one key, above which a shuffled join deals them to several tasks.
HOT_GROUP = 50_000

#: Bytes of rows that cross to Python together, see ``arrow_batches``.
ARROW_BYTES = 4 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else.

    ``lower`` does the same on pure ASCII and is the faster of the two.
    """
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def join_small(
    large: DataFrame, small: DataFrame, on: Sequence[str], how: str, row_bytes: int, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join with ``small``, a stored table: broadcast if its counted rows are within the limit.

    Beyond the limit both sides are shuffled, where skewed keys are split at run time.
    """
    if small.count() * row_bytes <= limit:
        small = F.broadcast(small)
    return large.join(small, list(on), how)


def join_spread(
    large: DataFrame, small: DataFrame, on: Sequence[str], row_bytes: int, how: str = "inner", hot: int = HOT_GROUP
) -> DataFrame:
    """Inner or left join with ``small``, a stored table with one row per key, that no key can overload.

    Broadcast if the counted rows are within the limit.  Otherwise keys of more
    than ``hot`` rows are counted; their rows are dealt to pieces of about that
    size by a hash of the row, and the key's row is repeated for each piece.
    """
    on = list(on)
    if small.count() * row_bytes <= BROADCAST_BYTES:
        return large.join(F.broadcast(small), on, how)
    counts = large.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > hot)
    many = materialize(counts.select(*on, F.ceil(F.col("_n") / hot).alias("_pieces")), "hot-keys")
    if many.isEmpty():
        return large.join(small, on, how)
    pieces = F.coalesce("_pieces", F.lit(1))
    dealt = join_small(large, many, on, "left", 64)
    dealt = dealt.withColumn("_piece", F.pmod(F.xxhash64(*large.columns), pieces)).drop("_pieces")
    repeated = join_small(small, many, on, "left", 64)
    repeated = repeated.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("_pieces")
    return dealt.join(repeated, [*on, "_piece"], how).drop("_piece")


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that only a slice of the texts exists as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@contextmanager
def _set_inside(spark: SparkSession, name: str, value: int | bool) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def arrow_batches(spark: SparkSession, size: int = ARROW_BYTES) -> Iterator[None]:
    """What is run inside hands rows to Python in batches that end with the row that fills ``size`` bytes.

    Without it a batch holds 10,000 rows whatever their length, and an executor
    holds it outside its heap several times over: as vectors that double as they
    grow, and once more as bytes on their way.  Frames returned from inside but
    run later are not bound by it.
    """
    with _set_inside(spark, _ARROW_BYTES, size):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run inside go when the run that wrote them ends.

    Without it they stay on the executors' disks until the driver happens to
    collect its garbage.  For steps that each store what later ones read, so
    that the disk holds the shuffles of one step and not of all.
    """
    with _set_inside(spark, _DROP_SHUFFLES, True):
        yield


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, which may not find it by themselves.  Once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for path in package.rglob("*.py"):
            file.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
