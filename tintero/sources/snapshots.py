"""Versions of a warehouse: which build of each table, and of each month of the fact, is the current one.

Tables are written under build folders that nothing points to yet.  A snapshot
is a small file that names one build per dimension and one per month of each
fact table.  Publishing is one step: the finished file is renamed to the next
number, which fails if another writer has taken it.  A reader looks up the
highest number once and then reads only the folders it names, so whatever
breaks off, it meets one whole build.  Months that a build doesn't touch keep
their older folders; nothing is copied.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_snapshots"
BUILD = "build"

Month = tuple[int, str]


class PublishConflict(RuntimeError):
    """Another writer published while this build was made; build again on top of its snapshot."""


@dataclass(frozen=True)
class Snapshot:
    """Builds by table name, and by month for partitioned tables; number 0 is an empty warehouse."""

    root: str
    number: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    months: dict[str, dict[Month, str]] = field(default_factory=dict)

    def with_table(self, name: str, build: str) -> Snapshot:
        return Snapshot(self.root, self.number, self.tables | {name: build}, self.months)

    def with_months(self, name: str, build: str, written: Iterable[Month], dropped: Iterable[Month] = ()) -> Snapshot:
        """``written`` months come from ``build`` now, ``dropped`` ones are gone, all others stay."""
        gone = set(dropped)
        kept = {m: b for m, b in self.months.get(name, {}).items() if m not in gone}
        return Snapshot(self.root, self.number, self.tables, self.months | {name: kept | dict.fromkeys(written, build)})

    def with_builds(self, name: str, builds: dict[Month, str]) -> Snapshot:
        """The months of the table and their builds as given."""
        return Snapshot(self.root, self.number, self.tables, self.months | {name: builds})

    def folder(self, name: str) -> str | None:
        return f"{self.root}/{name}/{BUILD}={self.tables[name]}" if name in self.tables else None

    def month_folders(self, name: str, only: Iterable[Month] | None = None) -> list[str]:
        months = self.months.get(name, {})
        wanted = sorted(months if only is None else months.keys() & set(only))
        return [f"{self.root}/{name}/year={y}/month={m}/{BUILD}={months[y, m]}" for y, m in wanted]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def new_build() -> str:
    return uuid4().hex


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, path = _files(spark, f"{root}/{LOG}")
    if not files.exists(path(f"{root}/{LOG}")):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path(f"{root}/{LOG}"))]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def current(spark: SparkSession, root: str) -> Snapshot:
    """The newest snapshot of a warehouse."""
    numbers = _numbers(spark, root)
    return at(spark, root, numbers[-1]) if numbers else Snapshot(root)


def at(spark: SparkSession, root: str, number: int) -> Snapshot:
    """An earlier snapshot by its number."""
    text = spark.read.text(f"{root}/{LOG}/{number:09d}.json", wholetext=True).first()[0]
    stored = json.loads(text)
    months = {t: {(y, m): b for y, m, b in rows} for t, rows in stored["months"].items()}
    return Snapshot(root, number, stored["tables"], months)


def publish(spark: SparkSession, snapshot: Snapshot) -> Snapshot:
    """Make ``snapshot`` the current one, unless another was published since the one it was made from."""
    root, number = snapshot.root, snapshot.number + 1
    files, path = _files(spark, f"{root}/{LOG}")
    months = {t: [[y, m, b] for (y, m), b in sorted(rows.items())] for t, rows in snapshot.months.items()}
    content = json.dumps({"tables": snapshot.tables, "months": months}, indent=1)
    draft = path(f"{root}/{LOG}/_draft-{uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(content.encode())
    finally:
        out.close()
    target = path(f"{root}/{LOG}/{number:09d}.json")
    # a rename onto a file that exists fails on HDFS; elsewhere it may replace it, hence the look before
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise PublishConflict(f"snapshot {number} of {root} exists already")
    return Snapshot(root, number, snapshot.tables, snapshot.months)


def write_table(df: DataFrame, snapshot: Snapshot, name: str, build: str) -> Snapshot:
    """Write ``df`` as a build of the table ``name``; the snapshot that has it isn't published yet."""
    changed = snapshot.with_table(name, build)
    df.write.parquet(changed.folder(name))
    return changed


def write_months(df: DataFrame, snapshot: Snapshot, name: str, build: str) -> list[Month]:
    """Write the months of ``df(year, month, ...)`` as builds of theirs; returns the months."""
    root = f"{snapshot.root}/{name}"
    rows = df.withColumn(BUILD, F.lit(build)).hint("rebalance", "year", "month")
    rows.write.mode("append").partitionBy("year", "month", BUILD).parquet(root)
    return months_written(df.sparkSession, root, build)


def months_written(spark: SparkSession, root: str, build: str) -> list[Month]:
    """Months that have a folder of the build, by the names of the folders."""
    files, path = _files(spark, root)
    found = files.globStatus(path(f"{root}/year=*/month=*/{BUILD}={build}"))
    months = []
    for status in found or ():
        month = status.getPath().getParent()
        months.append((int(month.getParent().getName().removeprefix("year=")), month.getName().removeprefix("month=")))
    return sorted(months)


def read_table(spark: SparkSession, snapshot: Snapshot, name: str) -> DataFrame | None:
    folder = snapshot.folder(name)
    return None if folder is None else spark.read.parquet(folder)


def read_months(
    spark: SparkSession, snapshot: Snapshot, name: str, schema: str, only: Sequence[Month] | None = None
) -> DataFrame:
    """The months of a table that the snapshot names, or of those ``only`` some."""
    folders = snapshot.month_folders(name, only)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(f"{schema}, {BUILD} string").option("basePath", f"{snapshot.root}/{name}")
    table = reader.parquet(*folders).drop(BUILD)
    return table.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
