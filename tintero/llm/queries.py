"""Thin queries over the operators, named opN_<name>, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero.llm import bpe, chat, decontaminate, divergence, exact, filters, html, jaccard, lines, simhash, toxicity, warc, windows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_sha256(column: str) -> F.Column:
    return F.sha2(F.col(column).cast("binary"), 256)


@register("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)


@register(
    "op2_exact_dedup",
    r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS o,
      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS p FROM documents),
    w AS (SELECT doc_id, p, first_value(doc_id) OVER (PARTITION BY p ORDER BY length(o) DESC, doc_id) AS keep_id,
      count(*) OVER (PARTITION BY p) AS group_size FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(p) AS text_sha256 FROM w""",
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


_ESCAPED = r"""regexp_replace(replace({0}, '\\', '\\\\'), '(<)(/?s>)|(\[)(/?INST\])|(<)(</?SYS>>)|(<)(\|)',
  '\1\3\5\7\\\2\4\6\8', 'g')"""


@register(
    "op3_chat_format",
    rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    e AS (SELECT *, length({_ESCAPED.format("text")}) + length(role) + 8 AS marked FROM c)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(marked) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id""",
)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema)
    formatted = chat.format_records(chat.records_of_turns(rows.union(added)))
    turns = chat.read_turns(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.transform(
        "loss_spans",
        lambda s: chat.unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
    )
    read = formatted.withColumn("turns", turns).withColumn("loss", F.array_join(under, ""))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        hex_sha256("loss").alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _base32(hexed: str) -> str:
    """SQL for the base-32 form of a hex digest: five hex digits make four letters."""
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr({0}, {1}, 5) AS BIGINT) >> {2}) & 31), 1)"
    return " || ".join(letter.format(hexed, 1 + 5 * g, 15 - 5 * i) for g in range(8) for i in range(4))


@register(
    "op4_warc",
    f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS r FROM p)
    SELECT page_id, payload_bytes, {_base32("x")} AS payload_digest,
      CASE WHEN r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN r <> page_id THEN r END AS refers_to FROM d""",
)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@register("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@register("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        hex_sha256("ids").alias("ids_sha256"),
        hex_sha256("decoded").alias("decoded_sha256"),
    )


@register(
    "op9_line_dedup",
    r"""WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
    l AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM t),
    k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    g AS (SELECT key, max(doc_id) AS newest FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    d AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id < g.newest, false) AS gone
      FROM k LEFT JOIN g USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM d GROUP BY doc_id""",
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", hex_sha256("text").alias("kept_sha256"))


@register("op10_repeated_windows")
def op10_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = windows.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", hex_sha256("kept").alias("kept_sha256"))


@register(
    "op11_source_divergence",
    r"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
      row_number() OVER () AS doc FROM documents),
    t AS (SELECT lang, source, doc, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
    a AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang)
      LEFT JOIN c USING (lang, source, term)),
    p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p
      FROM a WINDOW w AS (PARTITION BY lang, source)),
    l AS (SELECT lang, term, sum(n) AS n FROM a GROUP BY lang, term),
    q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q
      FROM l WINDOW w AS (PARTITION BY lang)),
    m AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term)
      WHERE x.source <> y.source GROUP BY ALL),
    r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(m.value, 0) AS BIGINT) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN m ON m.lang = x.lang AND m.source = x.source AND m.item = y.source
      UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p JOIN q USING (lang, term)
      WHERE n > 0 AND p > q),
    s AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM r)
    SELECT * FROM s WHERE part = 'pair' OR rank <= 50""",
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@register("op12_ngram_jaccard")
def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


@register(
    "op13_filter_interactions",
    r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
      min(doc_id) OVER (PARTITION BY text) AS least FROM d),
    b AS (SELECT doc_id, part, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
      + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
      + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
      + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask FROM w),
    l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
    c AS (SELECT part, mask, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic, count(*) AS n
      FROM b LEFT JOIN l USING (doc_id) GROUP BY ALL),
    f AS (SELECT chr(65 + CAST(i AS INTEGER)) AS letter, CAST(1 << i AS INTEGER) AS bit FROM range(5) r(i)),
    o AS (SELECT v.letter || w.letter || x.letter || y.letter || z.letter AS filter_order FROM f v, f w, f x, f y, f z
      WHERE (v.bit | w.bit | x.bit | y.bit | z.bit) = 31),
    e AS (SELECT filter_order, CAST(step AS INTEGER) AS step, f.letter, f.bit,
      (SELECT coalesce(bit_or(g.bit), 0) FROM f g WHERE instr(filter_order, g.letter) < step) AS before
      FROM o, range(1, 6) s(step), f WHERE f.letter = substr(filter_order, step, 1)),
    t AS (SELECT part, filter_order, step, letter,
      sum(n) FILTER (mask & (before | bit) = 0) AS kept,
      sum(n) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
      sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant,
      sum(n) FILTER (mask = bit) AS unique_fails,
      sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND good) AS good_lost,
      sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND toxic) AS toxic_lost
      FROM c, e GROUP BY ALL)
    SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
      CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
      CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
      CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
      CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley FROM t""",
)
def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_interactions(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))
