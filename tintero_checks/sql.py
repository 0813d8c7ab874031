"""Building blocks of the oracle SQL (DuckDB dialect)."""

from __future__ import annotations

from tintero import lexicon

ARTICLES = """articles AS (
  SELECT doc_id AS article_id, source, lang, doc_id AS ingest_seq,
         CASE WHEN instr(text, chr(10)) > 0
              THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS title,
         CASE WHEN instr(text, chr(10)) > 0
              THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body,
         CAST(DATE '2023-01-01' + CAST(doc_id % 365 AS INTEGER) AS DATE) AS publish_date
  FROM documents)"""

RAW = (
    ARTICLES
    + """,
flags AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id),
raw_articles AS (
  SELECT article_id, CASE WHEN lang <> 'fr' THEN title END AS title,
         nullif(body, '') AS body, nullif(source, 'src3') AS source,
         CASE WHEN source = 'src5' THEN 'sin fecha'
              ELSE strftime(publish_date, '%Y-%m-%d') END AS publish_date, ingest_seq
  FROM articles
  UNION ALL
  SELECT article_id, title || ' "rev"', nullif(body, ''), source,
         CASE WHEN toxic = 1 THEN '2024-02-30'
              ELSE strftime(publish_date, '%Y-%m-%d') END,
         ingest_seq + 1000000000000
  FROM articles JOIN flags ON article_id = doc_id
  UNION ALL
  SELECT NULL, role, nullif(text, ''), 'chat', '2023-06-15',
         2000000000000 + conv_id * 100000 + turn
  FROM conversations)"""
)


def fold(expr: str) -> str:
    return f"strip_accents(lower({expr}))"


def spaces(expr: str) -> str:
    return rf"CAST(len(regexp_extract_all({expr}, '\s+')) + 1 AS BIGINT)"


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words))


_LONG_STOP_WORDS = quoted(w for w in lexicon.STOP_WORDS if len(w) >= 4)


def kept_terms(stop_words: bool = False, source: str = "articles") -> str:
    """CTEs ``raw_terms`` and ``kept`` over ``articles``: one row per (accepted) token."""
    stop = f" AND term NOT IN ({_LONG_STOP_WORDS})" if stop_words else ""
    return f"""raw_terms AS (
  SELECT article_id, source, lang, strftime(publish_date, '%Y-%m') AS year_month,
         unnest(regexp_extract_all({fold("title || ' ' || body")}, '[a-z]+')) AS term
  FROM {source}),
kept AS (
  SELECT * FROM raw_terms
  WHERE length(term) BETWEEN 4 AND 24
    AND len(list_distinct(string_split(term, ''))) > 2{stop})"""


def _plain_words(expr: str) -> str:
    """DuckDB's ``\\b`` knows ASCII only: let other letters and digits count as word characters too."""
    return rf"regexp_replace({expr}, '[^\x00-\x7F\p{{P}}\p{{S}}\p{{Z}}\p{{C}}\p{{M}}]', 'x', 'g')"


def _hits(expr: str, words: list[str]) -> str:
    return rf"len(regexp_extract_all({expr}, '\b(?:{'|'.join(words)})\b'))"


def voted(
    aliases: dict[int, list[str]],
    unknown: int,
    title_first: bool = False,
    relation: str = "articles",
) -> str:
    """CTE ``voted(article_id, region_id)`` over articles."""
    ballots = " UNION ALL ".join(
        f"SELECT article_id, {k} AS id, {_hits('t', w)} AS in_title, {_hits('b', w)} AS in_body FROM folded"
        for k, w in aliases.items()
    )
    tie = "in_title DESC, " if title_first else ""
    return f"""folded AS (
  SELECT article_id, {_plain_words(fold("title"))} AS t, {_plain_words(fold("body"))} AS b
  FROM {relation}),
ballots AS ({ballots}),
ranked AS (
  SELECT article_id, id, 3 * in_title + in_body AS score,
         row_number() OVER (PARTITION BY article_id
                            ORDER BY 3 * in_title + in_body DESC, {tie}id) AS rn
  FROM ballots),
voted AS (
  SELECT article_id, CAST(CASE WHEN score < 1 THEN {unknown} ELSE id END AS INTEGER) AS region_id
  FROM ranked WHERE rn = 1)"""


def sources(relation: str = "articles") -> str:
    return f"""dim_source AS (
  SELECT source AS source_name,
         row_number() OVER (ORDER BY min(ingest_seq), source) AS source_id
  FROM {relation} GROUP BY source)"""


def fact_of(relation: str, aliases: dict[int, list[str]], unknown: int, also: str = "") -> str:
    """CTEs up to ``fact``: the warehouse's fact columns of the articles in ``relation``."""
    return f"""{voted(aliases, unknown, relation=relation)}, {sources(relation)},
fact AS (
  SELECT a.article_id, a.title, a.body,
         {spaces(fold("a.title"))} AS word_count_title,
         {spaces(fold("a.body"))} AS word_count_body,
         CAST(strftime(publish_date, '%Y%m%d') AS INTEGER) AS date_id,
         s.source_id, v.region_id,
         CAST(year(publish_date) AS INTEGER) AS year,
         strftime(publish_date, '%m') AS month{also}
  FROM {relation} a
  JOIN voted v ON a.article_id IS NOT DISTINCT FROM v.article_id
  LEFT JOIN dim_source s ON a.source = s.source_name)"""


def fact(aliases: dict[int, list[str]], unknown: int) -> str:
    """CTEs up to ``fact`` over ``articles``, with source, lang and publish_date."""
    also = ", a.source, a.lang, a.publish_date"
    return f"{ARTICLES}, {fact_of('articles', aliases, unknown, also)}"


def lift(counts: str, key: str, min_global: int, min_class: int, excluded: str | None, limit: int) -> str:
    """CTE ``lift`` from a relation ``counts(key, term, n)``."""
    keep = f"WHERE {key} <> {excluded}" if excluded else ""
    cut = f"WHERE rn <= {limit}" if limit else ""
    return f"""overall AS (SELECT term, sum(n) AS g FROM {counts} GROUP BY term),
totals AS (SELECT {key}, sum(n) AS t FROM {counts} GROUP BY {key}),
lifted AS (
  SELECT c.{key}, c.term, CAST(c.n AS BIGINT) AS regional_count, CAST(g AS BIGINT) AS global_count,
         (c.n / t) / (g / (SELECT sum(n) FROM {counts})) AS ratio
  FROM {counts} c JOIN overall USING (term) JOIN totals USING ({key})
  WHERE g >= {min_global} AND c.n >= {min_class}),
ranked_lift AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ratio DESC, regional_count DESC, term) AS rn
  FROM lifted {keep}),
lift AS (
  SELECT {key}, term, regional_count, global_count, round(ratio, 6) AS relative_ratio
  FROM ranked_lift {cut})"""


def divergence(counts: str, key: str, min_global: int, min_terms: int) -> str:
    """CTE ``divergence`` from a relation ``counts(key, term, n)``."""
    return f"""allowed AS (
  SELECT term, sum(n) AS g FROM {counts} GROUP BY term HAVING sum(n) >= {min_global}),
used AS (
  SELECT c.{key}, c.n, g, sum(c.n) OVER (PARTITION BY c.{key}) AS t,
         (SELECT sum(g) FROM allowed) AS gt
  FROM {counts} c JOIN allowed USING (term)),
divergence AS (
  SELECT {key}, CAST(sum(n) AS BIGINT) AS total_terms, count(*) AS vocabulary_size,
         round(sum((n / t) * ln((n / t) / (g / gt))), 6) AS kl_divergence
  FROM used GROUP BY {key} HAVING sum(n) >= {min_terms})"""


def peaks(day_sql: str, window: int, factor: float, delta: float, keys: str = "") -> str:
    """CTE ``peaks`` from a select of ``(keys, date)`` rows."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    join = f"s.{keys} = d.{keys} AND " if keys else ""
    sk = f"s.{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""days AS ({day_sql}),
daily AS (SELECT {k}date, count(*) AS n FROM days GROUP BY {k}date),
ends AS (SELECT {k}min(date) AS lo, max(date) AS hi FROM daily {group}),
spine AS (
  SELECT {k}CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM ends
  WHERE lo IS NOT NULL),
dense AS (
  SELECT {sk}s.date, coalesce(d.n, 0) AS article_count
  FROM spine s LEFT JOIN daily d ON {join}s.date = d.date),
averaged AS (
  SELECT *, coalesce(avg(article_count) OVER ({part}ORDER BY date
              ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING), 0.0) AS mean
  FROM dense),
peaks AS (
  SELECT {k}date, CAST(article_count AS BIGINT) AS article_count,
         round(mean, 6) AS moving_average, round(article_count - mean, 6) AS delta,
         mean > 0 AND article_count >= mean * {factor} AND article_count - mean >= {delta} AS is_peak
  FROM averaged)"""
