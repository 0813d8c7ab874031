"""Repeated lines: kept once, in the newest document that holds them.

Line hashes are range-partitioned and sorted by document and position, so one
pass over a sorted range meets the first occurrence in each document in turn.
What leaves the pass is not text but a bitmap per document.  It is compressed:
only 64-line words with a dropped line are stored.

A line in very many documents would make one range too long.  Lines above
``hot_line`` occurrences are counted first, their occurrences are dealt to
as many pieces of that size, and the pieces' summaries are combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintero.llm.common import BROADCAST_BYTES, SPACES, ascii_lower, join_small, text_or_empty
from tintero.session import materialize

HOT_LINE = 200_000
_NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    return F.trim(ascii_lower(line), F.lit(SPACES))


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _identified(docs: DataFrame) -> DataFrame:
    """Rows by (doc, body): the id, null as the smallest, and a hash that tells texts of one id apart."""
    return docs.withColumns({
        "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
        "_body": F.xxhash64(text_or_empty()),
    })


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, body, pos): a 128-bit hash of each line's key, for keys of ``min_chars`` or more."""
    lines = _identified(docs).select(
        F.col("_doc").alias("doc"),
        F.col("_body").alias("body"),
        F.posexplode(_split(text_or_empty())).alias("pos", "line"),
    )
    keys = lines.select("doc", "body", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "body", "pos"
    )


def dropped_lines(found: DataFrame, min_docs: int, hot_line: int = HOT_LINE) -> DataFrame:
    """(doc, body, pos) of the lines that go; ``found`` is a stored table of occurrences."""
    sizes = found.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    pieces = F.ceil(F.col("n") / hot_line).alias("pieces")
    hot = materialize(sizes.where(F.col("n") > hot_line).select("h1", "h2", pieces), "hot-lines")
    dealt = join_small(found, hot, ["h1", "h2"], "left", 32).withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("doc"), F.col("pieces")) + 1, F.lit(0))
    )
    ranged = dealt.repartitionByRange("h1", "h2", "piece").sortWithinPartitions(
        "h1", "h2", "piece", F.desc("doc"), "pos"
    )
    newest_first = Window.partitionBy("h1", "h2", "piece").orderBy(F.desc("doc"))
    whole = newest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranged.withColumns({
        "nth": F.dense_rank().over(newest_first),
        "newest": F.first("doc").over(whole),
        "oldest": F.last("doc").over(whole),
        "again": F.coalesce(F.lag("doc").over(newest_first) == F.col("doc"), F.lit(False)),
    })
    where = ["doc", "body", "pos"]
    # the nth newest document and the oldest one give the number of documents as far as it matters
    enough = F.when(F.col("oldest") < F.col("doc"), F.col("nth") + 1).otherwise(F.col("nth"))
    once = ranked.where("piece = 0")
    if min_docs > 3:
        counted = F.max("nth").over(Window.partitionBy("h1", "h2", "piece"))
        once, enough = once.withColumn("docs", counted), F.col("docs")
    dropped = once.where((F.col("doc") < F.col("newest")) & (enough >= min_docs)).select(where)
    if hot.isEmpty():
        return dropped
    parts = ranked.where("piece > 0").groupBy("h1", "h2")
    totals = parts.agg(F.sum(F.when(F.col("again"), 0).otherwise(1)).alias("docs"), F.max("doc").alias("last"))
    totals = materialize(totals.where(F.col("docs") >= min_docs), "hot-line-totals")
    many = join_small(dealt.where("piece > 0"), totals, ["h1", "h2"], "inner", 48)
    return dropped.union(many.where(F.col("doc") < F.col("last")).select(where))


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc, body, gone): for each document the non-zero 64-line words of its bitmap of dropped lines."""
    word = F.floor(F.col("pos") / 64).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = dropped.groupBy("doc", "body", word).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc", "body").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "bits")))).alias("gone")
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, hot_line: int = HOT_LINE) -> DataFrame:
    r"""``docs`` with kept text and the columns n_lines and n_dropped.

    A line's key is the line without white space at its ends, A-Z in lower
    case.  Keys of ``min_chars`` code points found under ``min_docs`` ids lose
    all their lines but those under the largest id.  Texts are cut at \n only;
    a null or empty text is one empty line and becomes an empty text.  A null
    id counts as one id below all others; rows that repeat an id and a text
    are treated alike.  All other columns pass unchanged, but for columns of
    the names n_lines, n_dropped, _doc, _body and _gone, which are replaced.
    An empty table gives an empty table.
    """
    docs = docs.drop("n_lines", "n_dropped", "_doc", "_body", "_gone")
    found = materialize(occurrences(docs, min_chars), "lines")
    maps = materialize(drop_bitmaps(dropped_lines(found, min_docs, hot_line)), "line-bitmaps")
    size = maps.agg(F.sum(F.size("gone") * 16 + 64)).first()[0] or 0
    maps = maps.withColumnsRenamed({"doc": "_doc", "body": "_body", "gone": "_gone"})
    maps = F.broadcast(maps) if size <= BROADCAST_BYTES else maps
    rows = _identified(docs).join(maps, ["_doc", "_body"], "left")
    lines = _split(text_or_empty())
    kept = F.filter(lines, lambda line, i: _is_kept(i))
    text = F.when(F.col("_gone").isNull(), text_or_empty()).otherwise(F.array_join(kept, "\n"))
    dropped = F.aggregate(F.map_values("_gone"), F.lit(0).cast("long"), lambda n, bits: n + F.bit_count(bits))
    out = rows.withColumns({
        "text": text,
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(dropped, F.lit(0).cast("long")),
    })
    return out.select(*docs.columns, "n_lines", "n_dropped")


def _is_kept(position: Column) -> Column:
    bits = F.coalesce(F.element_at("_gone", F.floor(position / 64).cast("int")), F.lit(0).cast("long"))
    return F.getbit(bits, (position % 64).cast("int")) == 0
