"""Web archives with a two-level capture index.

Pages are written as WARC records, one gzip member each, into archives in the
shared folder.  Of pages with equal payloads one is a response, the others
revisit it.  The index has a line per record, sorted by the URL with its host
reversed, then by record id.  Lines are packed into compressed blocks of
``BLOCK_LINES`` and a sparse directory keeps each block's first key.  A lookup
binary-searches the directory, unpacks one block, and reads one range of one
archive.

A task writes archives of its own, under a name no other attempt uses; only
records of attempts whose results were committed are in the manifest, so lost
executors and repeated tasks do no harm.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintero.llm.common import join_spread, ship_package, text_or_empty
from tintero.session import materialize, scratch_path

ARCHIVE_BYTES = 512 << 20
BLOCK_LINES = 2000
#: Characters of a URL that its key keeps; a hash stands for the rest.
KEY_CHARS = 300
_DATE = "2024-01-01T00:00:00Z"
_LEVEL = 4
#: Tasks that read archives, at most; each streams one archive after another.
_READERS = 20_000
_NO_ID = -(1 << 63)
#: First keys in the directory's upper level.
TOP_ENTRIES = 50_000


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def url_key(url: str | None) -> str:
    """The URL with its host's labels reversed: ``com,example,www)/path?query``."""
    url = (url or "").strip()
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", f":{parts.port}" if parts.port else ""
    except ValueError:
        host = port = ""
        parts = urlsplit("")
    if host:
        host = ",".join(reversed(host.removeprefix("www.").split(".")))
        url = f"{host}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")
    if len(url) > KEY_CHARS:
        url = url[:KEY_CHARS] + "#" + hashlib.sha1(url.encode()).hexdigest()
    return " ".join(url.split())


def key_line(url: str, page_id: int, named: str) -> str:
    """A record's key; the digest tells records of one page id apart."""
    return f"{url_key(url)} {page_id:020d} {named}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def record(
    page_id: int, url: str, payload: bytes, named: str, refers_to: int | None = None, target: str = ""
) -> bytes:
    """A WARC record of a page; a revisit has no payload and names the record it refers to."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{named}",
        "Content-Type: text/html",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head[-2:-2] = [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            f"WARC-Refers-To-Target-URI: {target}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _page_of(urn: str) -> int:
    return int(urn.rpartition(":")[2].rstrip(">"))


def classified(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to, target): each page with the response that it revisits, if any.

    Of equal payloads of ``least_bytes`` or more, the largest page_id is the
    response.  Payloads are compared by SHA-1 and length.
    """
    html = text_or_empty("html")
    page_id = F.coalesce(F.col("page_id").cast("long"), F.lit(_NO_ID)).alias("page_id")
    url = text_or_empty("url").alias("url")
    sha, size = F.unhex(F.sha1(html.cast("binary"))).alias("sha"), F.octet_length(html).alias("size")
    groups = pages.select(page_id, url, sha, size).where(F.col("size") >= least_bytes).groupBy("sha", "size")
    best = groups.agg(F.max_by(F.struct("page_id", "url"), F.struct("page_id", "url")).alias("best"), F.count("*").alias("n"))
    several = best.where("n > 1").select("sha", "size", F.col("best.page_id").alias("response"),
                                         F.col("best.url").alias("target"))
    several = materialize(several, "responses")
    rows = pages.select(page_id, url, html.alias("html"), sha, size)
    joined = join_spread(rows, several, ["sha", "size"], 400, "left")
    revisits = F.col("response") != F.col("page_id")
    return joined.select("page_id", "url", "html", F.when(revisits, F.col("response")).alias("refers_to"),
                         F.when(revisits, F.col("target")).alias("target"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``classified`` pages into archives under ``folder``; the stored manifest (key, archive, start, size)."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                ids = zip(*(batch[c].tolist() for c in ("page_id", "url", "html", "refers_to", "target")))
                for page_id, url, html, refers_to, target in ids:
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    url, payload = _one_line(url), html.encode()
                    named = digest(payload)
                    other = int(refers_to) if refers_to else None
                    member = gzip.compress(record(page_id, url, payload, named, other, _one_line(target)), _LEVEL, mtime=0)
                    out.write(member)
                    rows.append((key_line(url, page_id, named), name, at, len(member)))
                    at += len(member)
                yield pd.DataFrame(rows, columns=["key", "archive", "start", "size"])
        finally:
            if out is not None:
                out.close()

    named = pages.withColumn("refers_to", F.col("refers_to").cast("string"))
    return materialize(named.mapInPandas(run, "key string, archive string, start long, size long"), "manifest")


# ------------------------------------------------------------------ the index


def _pack(lines: list[tuple]) -> bytes:
    return zlib.compress("\n".join("\t".join(map(str, line)) for line in lines).encode(), _LEVEL)


def _unpack(block: bytes) -> list[list[str]]:
    return [line.split("\t") for line in zlib.decompress(block).decode().split("\n")]


def build_index(manifest: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """The stored index (first, block): compressed blocks of sorted lines, each with its first key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines: list[tuple] = []

        def blocks(size: int) -> pd.DataFrame:
            cut = [lines[i : i + block_lines] for i in range(0, size, block_lines)]
            del lines[:size]
            return pd.DataFrame({"first": [c[0][0] for c in cut], "block": [_pack(c) for c in cut]})

        for batch in batches:
            lines.extend(zip(*(batch[c] for c in ("key", "archive", "start", "size"))))
            if len(lines) >= block_lines:
                yield blocks(len(lines) // block_lines * block_lines)
        if lines:
            yield blocks(len(lines))

    ranged = manifest.select("key", "archive", "start", "size").repartitionByRange("key").sortWithinPartitions("key")
    return materialize(ranged.mapInPandas(run, "first string, block binary"), "capture-index")


def lookup(keys: DataFrame, index: DataFrame, top_entries: int = TOP_ENTRIES) -> DataFrame:
    """(key, archive, start, size) of the distinct ``keys`` that the stored index holds.

    Two binary searches name a key's block: one among about ``top_entries``
    first keys, which every executor gets, one among the first keys between
    two of those, which are joined.  A directory of ``top_entries`` blocks or
    fewer needs the first only.  Keys of one block meet in one task, which
    unpacks the block once.
    """
    spark = keys.sparkSession
    ship_package(spark)
    firsts = index.select("first").distinct()
    step = max(1, -(-firsts.count() // top_entries))
    chosen = F.pmod(F.xxhash64("first"), F.lit(step)) == 0
    least = firsts.agg(F.min("first").alias("first"))
    top = sorted({r[0] for r in firsts.where(chosen).union(least).collect() if r[0] is not None})
    directory = spark.sparkContext.broadcast(top)

    @F.pandas_udf("int")
    def slot(found: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(directory.value, k) - 1 for k in found], dtype="int32")

    @F.pandas_udf("string")
    def block_of(found: pd.Series, within: pd.Series) -> pd.Series:
        return pd.Series([w[bisect.bisect_right(list(w), k) - 1] for k, w in zip(found, within)])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for block, wanted in zip(batch["block"], batch["wanted"]):
                lines = _unpack(block)
                names = [line[0] for line in lines]
                for key in wanted:
                    at = bisect.bisect_left(names, key)
                    if at < len(names) and names[at] == key:
                        rows.append((key, lines[at][1], int(lines[at][2]), int(lines[at][3])))
            yield pd.DataFrame(rows, columns=["key", "archive", "start", "size"])

    slots = firsts.select(slot("first").alias("slot"), "first").groupBy("slot")
    slots = slots.agg(F.array_sort(F.collect_list("first")).alias("within"))
    placed = keys.select("key", slot("key").alias("slot")).join(slots, "slot")
    wanted = placed.select("key", block_of("key", "within").alias("first"))
    wanted = wanted.groupBy("first").agg(F.collect_set("key").alias("wanted"))
    found = index.join(wanted, "first").select("block", "wanted")
    return found.mapInPandas(search, "key string, archive string, start long, size long")


# ------------------------------------------------------------------ reading


def members(stream: BinaryIO, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The unpacked members of a gzip stream, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(chunk)):
        parts.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


_RECORD = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, target string"


def _fields(data: bytes) -> tuple:
    """A row of ``_RECORD``; a revisit has the digest that it names and no size."""
    fields, payload = parse_record(data)
    page_id, kind = _page_of(fields["WARC-Record-ID"]), fields["WARC-Type"]
    if kind == "revisit":
        refers_to, named = _page_of(fields["WARC-Refers-To"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        return page_id, kind, None, named, refers_to, key_line(fields["WARC-Refers-To-Target-URI"], refers_to, named)
    return page_id, kind, len(payload), digest(payload), None, None


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "target"])
    return out.astype({"page_id": "int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives named in the manifest, each read as a stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        for batch in batches:
            for name in batch["archive"]:
                rows = []
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        rows.append(_fields(data))
                        if len(rows) == 5000:
                            yield _frame(rows)
                            rows = []
                yield _frame(rows)

    archives = materialize(manifest.select("archive").distinct(), "archive-names")
    tasks = max(1, min(archives.count(), _READERS))
    return archives.repartition(tasks).mapInPandas(run, _RECORD)


def read_ranges(places: DataFrame, folder: str) -> DataFrame:
    """The records at (key, archive, start, size), each by one range read, with their key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        name, file = None, None
        try:
            for batch in batches:
                rows = []
                for archive, start, size in zip(batch["archive"], batch["start"], batch["size"]):
                    if archive != name:
                        if file is not None:
                            file.close()
                        name, file = archive, system.open_input_file(f"{root}/{archive}")
                    file.seek(int(start))
                    rows.append(_fields(gzip.decompress(file.read(int(size)))))
                yield _frame(rows).assign(key=batch["key"].tolist())
        finally:
            if file is not None:
                file.close()

    return places.sortWithinPartitions("archive", "start").mapInPandas(run, f"{_RECORD}, key string")


def archive_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of ``pages(page_id, url, html)``, read back.

    Writes the archives to ``folder``, by default one in the shared folder, and
    reads every record from them.  What a revisit lacks is read from the
    response that it names, found through the capture index.  A null html is an
    empty payload, a null url an empty one; rows without an id are archived
    under a reserved one that counts as the smallest and read back as null.
    Rows that repeat the largest id of their payload are all responses.  Other
    columns are ignored; an empty table gives an empty result.
    """
    folder = folder or scratch_path(pages.sparkSession, "archives")
    manifest = write_archives(classified(pages, least_bytes), folder)
    records = materialize(read_archives(manifest, folder), "records")
    targets = records.where("target IS NOT NULL").select(F.col("target").alias("key")).distinct()
    places = lookup(targets, build_index(manifest))
    found = read_ranges(places, folder).select(F.col("key").alias("target"), F.col("payload_bytes").alias("full_bytes"),
                                               F.col("payload_digest").alias("full_digest"))
    revisits = records.where("target IS NOT NULL")
    revisits = join_spread(revisits, materialize(found, "responses-read"), ["target"], 500, "left")
    whole = revisits.unionByName(records.where("target IS NULL"), allowMissingColumns=True)

    def id_or_null(name: str):
        return F.when(F.col(name) != _NO_ID, F.col(name)).alias(name)

    return whole.select(
        id_or_null("page_id"),
        F.coalesce("full_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("full_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        id_or_null("refers_to"),
    )
