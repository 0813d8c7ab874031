"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tintero", **conf: str) -> SparkSession:
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named in ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local session that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tintero-")
    return _LOCAL_SCRATCH[app]


#: Bytes of text a task takes where its memory grows with what it reads.
TASK_BYTES = 16 << 20


def text_bytes(df: DataFrame) -> int:
    """Bytes of all string columns together; reads them once."""
    strings = [name for name, kind in df.dtypes if kind == "string"]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in strings), F.lit(0).cast("long"))
    return df.agg(F.sum(size)).first()[0] or 0


def spread_by_bytes(scan: DataFrame, key: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Deal the rows of ``scan`` by ``key`` so that a task holds about ``task_bytes`` of text.

    For work whose memory grows with the text of a task, such as counts by a key
    that hardly repeats.  The bytes are summed first, as sizes of files say little
    about compressed text.  Rows of one key stay together.
    """
    return scan.repartition(_tasks(scan, task_bytes), key)


def spread_in_order(scan: DataFrame, order: Sequence[str | Column], task_bytes: int = TASK_BYTES) -> DataFrame:
    """Deal the rows of the stored table ``scan`` by ranges of ``order``, about ``task_bytes`` of text a task.

    For counts by the first columns of ``order`` and something found in the text: a
    task meets few of their values, so it holds fewer counts and sends fewer on.
    The last column should tell rows apart, so that frequent values are cut too.
    """
    return scan.repartitionByRange(_tasks(scan, task_bytes), *order)


def _tasks(scan: DataFrame, task_bytes: int) -> int:
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return max(2 * cores, -(-text_bytes(scan) // task_bytes))


def spread_small(scan: DataFrame, key: str) -> DataFrame:
    """Spread a scan with few splits over all cores before CPU-heavy work on its text.

    A file with one row group, or a handful of small files, would keep one core
    busy.  Spark makes more than two splits per core of anything above a few
    hundred MB per core, so large inputs pass unchanged and are never shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() > 2 * cores:
        return scan
    return scan.repartition(2 * cores, key)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage at a place that outlives any executor, so that several
    results can share one expensive pass.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
