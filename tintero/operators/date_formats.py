"""Finding the format of a date column from all of its values.

One aggregate over the distinct values counts, for every candidate, the rows it
reads, those among them with a plausible year, and those that another day and
month order would read as well.  The candidate that reads most rows is elected;
where two read the same rows, as when no day is above the twelfth, the first of
the list is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tintero.functions import dates

#: Candidates by preference; the ISO day comes first.
CANDIDATES = (
    "yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy.M.d", "yyyyMMdd",
    "d MMM yyyy", "MMM d, yyyy", "d MMMM yyyy", "MMMM d, yyyy",
)
#: Formats that read the same texts with day and month exchanged.
SWAPPED = {"M/d/yyyy": "d/M/yyyy", "M-d-yyyy": "d-M-yyyy"}
PLAUSIBLE_YEARS = (1900, 2100)


def format_scores(
    df: DataFrame,
    column: str,
    candidates: Sequence[str] = CANDIDATES,
    years: tuple[int, int] = PLAUSIBLE_YEARS,
) -> DataFrame:
    """(format, place, parsed, plausible, ambiguous) per candidate, in rows of ``df``.

    The rows are counted by value first, so that parsing grows with the
    distinct values and a value that most rows share is read once a task.
    """
    values = df.select(dates.day_text(F.col(column)).alias("day")).where("day IS NOT NULL")
    values = values.groupBy("day").agg(F.count("*").alias("n"))
    swapped = SWAPPED | {b: a for a, b in SWAPPED.items()}

    def parsed(name: str) -> Column:
        return dates.parsed_day(F.col("day"), name)

    values = values.withColumns({f"_{i}": parsed(name) for i, name in enumerate(candidates)})

    def rows(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0))

    scores = []
    for i, name in enumerate(candidates):
        read = F.col(f"_{i}").isNotNull()
        other = swapped.get(name)
        either = read & F.col(f"_{candidates.index(other)}").isNotNull() if other in candidates else F.lit(False)
        scores.append(F.struct(
            F.lit(name).alias("format"), F.lit(i).alias("place"), rows(read).alias("parsed"),
            rows(F.year(f"_{i}").between(*years)).alias("plausible"), rows(either).alias("ambiguous"),
        ))
    return values.agg(F.array(*scores).alias("scores")).select(F.inline("scores"))


def elect_format(df: DataFrame, column: str, candidates: Sequence[str] = CANDIDATES) -> str | None:
    """The candidate that reads most rows of ``column``; null if none reads any, or if it isn't text."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return None
    scores = format_scores(df, column, candidates).where("parsed > 0")
    best = scores.orderBy(F.desc("plausible"), F.desc("parsed"), "place").first()  # one row per candidate
    return best["format"] if best else None
