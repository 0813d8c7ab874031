"""Text expressions: folding, tokens, word counts, slugs.

All of them are built-in JVM expressions.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintero.config import TokenRules

_HANGUL_SYLLABLES = range(0xAC00, 0xD7A4)
#: the parts of a syllable, of which its number is made up; the first ending is none
_LEADS, _VOWELS, _ENDINGS = range(0x1100, 0x1113), range(0x1161, 0x1176), range(0x11A8, 0x11C3)
_PAIR, _FIELD = "\x01", "\x02"

#: what Python's ``\w`` matches; spelled out because ``\b`` depends on the JDK
WORD_CHAR = r"[\p{L}\p{N}_]"
#: what Python's ``\s`` matches
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def _decomposed(ch: str) -> str:
    return "".join(p for p in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(p))


def _ranges(points: list[int], max_gap: int) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for p in points:
        if runs and p - runs[-1][1] <= max_gap:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return [(a, b) for a, b in runs]


def _char_class(points: list[int], max_gap: int = 1) -> str:
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _ranges(points, max_gap))


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """``(source, target, expansions)`` of the compatibility fold of lower-case text.

    ``source``/``target`` drive one ``translate``: one-to-one folds first, then
    the combining marks, which have no counterpart and are therefore deleted.
    ``expansions`` holds the characters that become several, but for Hangul
    syllables, whose parts are computed.
    """
    single: dict[str, str] = {}
    dropped: list[str] = []
    expansions: dict[str, str] = {}
    for point in range(0x80, 0x30000):  # no decompositions exist above
        if point in _HANGUL_SYLLABLES or 0xD800 <= point < 0xE000:
            continue
        ch = chr(point)
        if ch.lower() != ch:
            continue  # gone once the text is in lower case
        folded = _decomposed(ch)
        if folded == ch:
            continue
        if not folded:
            dropped.append(ch)
        elif len(folded) == 1:
            single[ch] = folded
        else:
            expansions[ch] = folded
    return "".join(single) + "".join(dropped), "".join(single.values()), expansions


@lru_cache(maxsize=1)
def _expansion_literals() -> tuple[str, str, str]:
    expansions = fold_tables()[2]
    points = sorted([*map(ord, expansions), *_HANGUL_SYLLABLES])
    first = f"\\x{{{points[0]:x}}}"
    before = f"\\x{{0}}-\\x{{{points[0] - 1:x}}}"
    # A coarse guard of few ranges, cheap to test on every row, then the exact
    # class for the few rows that pass it.  Both decide on plain characters with
    # one comparison before they look at the ranges.
    guard = f"[{first}-\\x{{10ffff}}&&[{_char_class(points, max_gap=0x40)}]]"
    exact = f"[{first}-\\x{{10ffff}}&&[{_char_class(points)}]]"
    others = f"[{before}[^{_char_class(points)}]]+"
    pairs = _PAIR.join(f"{k}{_FIELD}{v}" for k, v in expansions.items())
    return guard, f"{exact}|{others}", pairs


def as_text(c: Column) -> Column:
    """Cast to string, missing becomes the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def _syllable(piece: Column) -> Column:
    """The two or three parts of a Hangul syllable; null for any other piece."""
    number = F.ascii(piece) - _HANGUL_SYLLABLES.start

    def part(letters: range, at: Column) -> Column:
        return F.substring(F.lit("".join(map(chr, letters))), at.cast("int"), F.lit(1))

    vowel_and_ending = len(_VOWELS) * (len(_ENDINGS) + 1)
    lead = part(_LEADS, F.floor(number / vowel_and_ending) + 1)
    vowel = part(_VOWELS, F.floor(number % vowel_and_ending / (len(_ENDINGS) + 1)) + 1)
    ending_number = number % (len(_ENDINGS) + 1)
    ending = F.when(ending_number > 0, part(_ENDINGS, ending_number)).otherwise("")
    return F.when(number.between(0, len(_HANGUL_SYLLABLES) - 1), F.concat(lead, vowel, ending))


def _expand(lowered: Column) -> Column:
    """Replace every character that folds to several, in the texts that have any."""
    guard, pieces, pairs = _expansion_literals()
    table = F.str_to_map(F.lit(pairs), F.lit(_PAIR), F.lit(_FIELD))
    replaced = F.transform(
        F.regexp_extract_all(lowered, F.lit(pieces), F.lit(0)),
        lambda piece: F.coalesce(F.try_element_at(table, piece), _syllable(piece), piece),
    )
    affected = ~_is_ascii(lowered) & F.rlike(lowered, F.lit(guard))
    return F.when(affected, F.array_join(replaced, "")).otherwise(lowered)


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _translated(expanded: Column) -> Column:
    source, target, _ = fold_tables()
    return F.when(_is_ascii(expanded), expanded).otherwise(F.translate(expanded, source, target))


def fold(c: Column) -> Column:
    """Lower case, compatibility-decomposed, without combining marks; missing becomes empty."""
    return _translated(_expand(F.lower(as_text(c))))


def half_folded(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add ``columns`` with all of :func:`fold` done but its last step, :func:`finish_fold`.

    The steps use their input several times.  As columns of their own they are
    computed once per row, and the step that generated code cannot take in keeps
    to itself, so what follows is still compiled into one stage.
    """
    lowered = df.withColumns({name: F.lower(as_text(c)) for name, c in columns.items()})
    return lowered.withColumns({name: _expand(F.col(name)) for name in columns})


def finish_fold(c: Column) -> Column:
    return _translated(c)


def with_folded(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns with the :func:`fold` of the given ones."""
    return half_folded(df, columns).withColumns({name: finish_fold(F.col(name)) for name in columns})


def joined(*columns: Column) -> Column:
    """Columns as one text, separated by single spaces; missing counts as empty."""
    return F.concat_ws(" ", *[as_text(c) for c in columns])


def letter_runs(folded: Column) -> Column:
    """Every maximal run of a-z, in order."""
    return F.regexp_extract_all(folded, F.lit("[a-z]+"), F.lit(0))


def term_pattern(rules: TokenRules) -> str:
    """One pattern that finds only the letter runs of acceptable length and variety.

    Doing the checks inside the match keeps rejected runs from ever becoming
    strings, and needs no lambda over the extracted array.
    """
    few_letters = r"(?!([a-z])\1*+(?:([a-z])(?:\1|\2)*+)?(?![a-z]))"
    return (
        "(?<![a-z])"
        + (few_letters if rules.reject_two_letter_words else "")
        + f"[a-z]{{{rules.min_length},{rules.max_length}}}+(?![a-z])"
    )


def term_candidates(folded: Column, rules: TokenRules) -> Column:
    """Letter runs that pass ``rules``, stop words still included."""
    return F.regexp_extract_all(folded, F.lit(term_pattern(rules)), F.lit(0))


def is_term(token: Column, rules: TokenRules) -> Column:
    """The rules of :class:`TokenRules` as a predicate on single letter runs."""
    ok = F.length(token).between(rules.min_length, rules.max_length)
    if rules.reject_two_letter_words:
        ok = ok & (F.size(F.array_distinct(F.split(token, ""))) > 2)
    return ok & not_stop_word(token, rules)


def not_stop_word(token: Column, rules: TokenRules) -> Column:
    reachable = sorted(w for w in rules.stop_words if rules.min_length <= len(w) <= rules.max_length)
    return ~token.isin(reachable) if reachable else F.lit(True)


def word_count(folded: Column) -> Column:
    """Runs of white space plus one, so the empty text counts as one word."""
    return (F.regexp_count(folded, F.lit(SPACE_RUN)) + 1).cast("long")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[ /]", "_")
