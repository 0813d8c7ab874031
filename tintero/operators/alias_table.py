"""Keyword vote against a table of aliases.

:func:`tintero.operators.classify.vote` turns a dictionary into patterns, so
its plan and the cost of a match grow with the dictionary.  Here the aliases
stay a table ``(class_id, alias[, place])``: every text is cut into words, the
word n-grams of the lengths that aliases have are joined with the table, and
the hits of a class are resolved from left to right as one search would find
them.  The plan is the same for ten aliases and for a million.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintero.functions.text import WORD_CHAR
from tintero.operators.joins import BROADCAST_ROWS, fits_broadcast
from tintero.session import materialize

#: Runs of word characters and of all others, in turn.
_PIECES = f"{WORD_CHAR}++|[^{WORD_CHAR[1:]}++"
_HASHES = ("_h1", "_h2")


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s){_PIECES}"), F.lit(0))


def _is_word(piece: Column) -> Column:
    return F.rlike(piece, F.lit(f"^{WORD_CHAR}"))


def _hashed(gram: Column) -> dict[str, Column]:
    """A gram as 128 bits, so that no text is shuffled."""
    return {"_h1": F.xxhash64(gram), "_h2": F.xxhash64(F.lit(1), gram)}


def prepared_aliases(aliases: DataFrame, unknown: int) -> DataFrame:
    """(class_id, place, pieces, _h1, _h2) per alias, stored; ``pieces`` is its length in words and gaps.

    Of aliases of one class that fit at the same place, the one with the
    smallest ``place`` wins, as the first of an alternation does; without that
    column the longest does.  An alias must begin and end with a word.
    """
    rows = aliases.where((F.col("class_id") != unknown) & (F.col("alias") != ""))
    pieces = F.size(_pieces(F.col("alias")))
    place = F.col("place") if "place" in aliases.columns else -F.char_length("alias")
    whole = F.rlike("alias", F.lit(f"(?s)^{WORD_CHAR}(.*{WORD_CHAR})?$"))
    wrong = F.raise_error(F.concat(F.lit("an alias must begin and end with a word: "), "alias")).cast("int")
    rows = rows.select(
        F.col("class_id").cast("int").alias("class_id"),
        place.cast("long").alias("place"),
        F.when(whole, pieces).otherwise(wrong).alias("pieces"),
        *[c.alias(name) for name, c in _hashed(F.col("alias")).items()],
    )
    kept = rows.groupBy("class_id", "pieces", *_HASHES).agg(F.min("place").alias("place"))
    return materialize(kept, "aliases")


def alias_hits(
    df: DataFrame, key: str, texts: dict[str, int], prepared: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(key, field, class_id, at, place, pieces): every alias that fits a place in a text; ``field`` is the text's weight."""
    sizes = sorted(r[0] for r in prepared.select("pieces").distinct().collect())  # the lengths of aliases, in words
    fields = F.array(*[F.struct(F.lit(w).alias("field"), F.col(t).alias("text")) for t, w in texts.items()])
    cut = df.select(F.col(key).alias("_key"), F.explode(fields).alias("_f"))
    cut = cut.select("_key", "_f.field", _pieces(F.col("_f.text")).alias("_pieces"))
    # Words and gaps take turns, so the first piece tells which are words.
    first_word = F.when(_is_word(F.try_element_at("_pieces", F.lit(1))), 0).otherwise(1)
    cut = cut.select("*", first_word.alias("_first"))
    grams = F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>")
    sized = cut.select("*", F.explode(grams).alias("pieces"))

    def gram_at(piece: Column, at: Column) -> Column:
        gram = F.when(F.col("pieces") == 1, piece).otherwise(F.array_join(F.slice("_pieces", at + 1, F.col("pieces")), ""))
        fits = (at % 2 == F.col("_first")) & (at + F.col("pieces") <= F.size("_pieces"))
        return F.when(fits, F.struct(at.alias("at"), gram.alias("gram")))

    # The grams of a text are cut inside its row: what is exploded holds no list of pieces.
    found = F.filter(F.transform("_pieces", gram_at), lambda g: g.isNotNull())
    placed = sized.select("_key", "field", "pieces", F.explode(found).alias("_g"))
    hashed = placed.select("_key", "field", "_g.at", "pieces", *[c.alias(n) for n, c in _hashed(F.col("_g.gram")).items()])
    small = fits_broadcast(prepared, max_broadcast_rows)
    return hashed.join(F.broadcast(prepared) if small else prepared, ["pieces", *_HASHES])


def resolved_counts(hits: DataFrame) -> DataFrame:
    """(key, field, class_id, n): hits of a class that one search from the left finds, none overlapping another."""
    of_place = hits.groupBy("_key", "field", "class_id", "at").agg(F.min(F.struct("place", "pieces")).alias("first"))
    found = F.sort_array(F.collect_list(F.struct("at", F.col("first.pieces").alias("pieces"))))
    lists = of_place.groupBy("_key", "field", "class_id").agg(found.alias("found"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(state: Column, hit: Column) -> Column:
        taken = F.struct((hit["at"] + hit["pieces"]).alias("end"), (state["n"] + 1).alias("n"))
        return F.when(hit["at"] >= state["end"], taken).otherwise(state)

    return lists.select("_key", "field", "class_id", F.aggregate("found", start, step)["n"].alias("n"))


def vote_by_table(
    df: DataFrame,
    aliases: DataFrame,
    unknown: int,
    key: str = "article_id",
    title: str = "title_clean",
    body: str = "body_clean",
    out: str = "region_id",
    title_weight: int = 3,
    title_breaks_ties: bool = False,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(key, out): the class with the most votes for every row of ``df``, by the rules of ``vote``.

    ``key`` must be unique.  Rows without a hit get ``unknown``.  The result
    is narrow, to be joined where the texts are next shuffled anyway.  A null
    text holds no alias.
    """
    prepared = prepared_aliases(aliases, unknown)
    fields = {title: 1, body: 0}
    counts = resolved_counts(alias_hits(df, key, fields, prepared, max_broadcast_rows))
    in_title = F.sum(F.when(F.col("field") == 1, F.col("n")).otherwise(0))
    in_body = F.sum(F.when(F.col("field") == 0, F.col("n")).otherwise(0))
    ballots = counts.groupBy("_key", "class_id").agg(in_title.alias("in_title"), in_body.alias("in_body"))
    score = (F.col("in_title") * title_weight + F.col("in_body")).alias("score")
    order = [score, *([F.col("in_title")] if title_breaks_ties else []), (-F.col("class_id")).alias("neg_id")]
    best = ballots.groupBy("_key").agg(F.max(F.struct(*order)).alias("best")).where("best.score >= 1")
    best = materialize(best.select("_key", (-F.col("best.neg_id")).cast("int").alias("_class")), "votes")
    rows = df.select(F.col(key).alias("_key"))
    voted = rows.join(F.broadcast(best) if fits_broadcast(best, max_broadcast_rows) else best, "_key", "left")
    return voted.select(F.col("_key").alias(key), F.coalesce("_class", F.lit(unknown)).cast("int").alias(out))


def most_voted(votes: DataFrame, out: str = "region_id") -> DataFrame:
    """(out, n, rank): classes by the rows that they won."""
    n = votes.groupBy(out).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), out)))
