"""Near and exact duplicates, lines, windows, benchmark items and BPE against plain versions."""

import random

import brute
import duckdb
import public_tokenizers
import pytest
from edges import edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tintero.llm import bpe, decontaminate, exact, lines, simhash, windows

SMALL = "/root/testdata/sf0.001"
VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def small_docs():
    return duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def expected(rows):
    return sorted((tuple(r) for r in rows), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def mixed_texts(seed, count=60):
    """Short texts with shared stretches, from a small alphabet."""
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abc \n", k=rng.randint(5, 60))) for _ in range(12)]
    return [(i, "".join(rng.choices(pool, k=rng.randint(0, 6)))) for i in range(count)]


# ------------------------------------------------------------------ near duplicates


def test_near_duplicates_of_tables_and_edges(spark, edge_docs):
    docs = frame(spark, small_docs())
    columns = ("doc_id", "fingerprint", "component_id")
    assert got(simhash.near_duplicates(docs), *columns) == expected(brute.near_duplicates(small_docs()))
    assert got(simhash.near_duplicates(edge_docs), *columns) == expected(brute.near_duplicates(edge_rows()))


def clustered(count, seed=5):
    """Fingerprints in tight clusters: many share all of a block."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = set()
    while len(values) < count:
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 7)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    return sorted(values)


@pytest.mark.parametrize("tree_nodes", [4, 64, 4096])
def test_links_join_what_the_radius_joins(spark, tree_nodes):
    values = clustered(500)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 2, tree_nodes).collect()
    pairs = {(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in links}
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    mine = brute.components(values, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    assert mine == brute.components(values, lambda a, b: (a ^ b).bit_count() <= 2)


def test_tree_follows_only_edges_within_the_radius():
    values = clustered(300)
    tree = simhash.BKTree(values[0])
    for v in values[1:]:
        tree.add(v)
    for v in values[:40]:
        assert sorted(tree.within(v, 3)) == [w for w in values if (v ^ w).bit_count() <= 3]


# ------------------------------------------------------------------ exact duplicates


@pytest.mark.parametrize("digit, growth", [(16, 16), (1, 2), (3, 3)])
def test_exact_duplicates_of_edges(spark, edge_docs, digit, growth):
    found = exact.exact_duplicates(edge_docs, digit, growth)
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    assert got(found, *columns) == expected(brute.exact_groups(edge_rows()))
    kept = found.where("kept").groupBy("text_sha256").count().collect()
    assert all(r["count"] == 1 for r in kept)
    assert len(kept) == found.select("text_sha256").distinct().count()


# ------------------------------------------------------------------ lines


@pytest.mark.parametrize("hot, least", [(200_000, 3), (1, 3), (2, 4), (200_000, 4), (200_000, 2)])
def test_lines_of_edges(spark, edge_docs, hot, least):
    kept = lines.dedup_lines(edge_docs, min_docs=least, hot_line=hot)
    want = expected(brute.dedup_lines(edge_rows(), min_docs=least))
    assert got(kept, "doc_id", "n_lines", "n_dropped", "text") == want
    assert set(kept.columns) == set(edge_docs.columns) | {"n_dropped"}


def test_lines_with_hot_pieces(spark):
    docs = frame(spark, small_docs())
    want = expected(brute.dedup_lines(small_docs()))
    assert got(lines.dedup_lines(docs, hot_line=5), "doc_id", "n_lines", "n_dropped", "text") == want


def test_line_dedup_runs_no_python(spark):
    plan = lines.dedup_lines(frame(spark, edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ repeated windows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [8, 23, 40])
def test_windows_of_mixed_texts(spark, seed, width):
    docs = mixed_texts(seed) + [(100, "ab" * 50), (101, None), (102, "c" * 45), (102, "c" * 45), (None, "a b" * 20)]
    found = windows.remove_repeats(frame(spark, docs), width)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    mine = [(*r[:4], bytes(r[4])) for r in found.select(*columns).collect()]
    assert expected(mine) == expected(brute.remove_repeats(docs, width))


def test_windows_of_tables_and_edges(spark, edge_docs):
    for docs, rows in ((frame(spark, small_docs()), small_docs()), (edge_docs, edge_rows())):
        found = windows.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
        want = brute.remove_repeats(rows, 400)
        assert expected([(*r[:4], brute.sha(bytes(r[4]))) for r in found]) == expected(
            [(*r[:4], brute.sha(r[4])) for r in want]
        )


def test_windows_tell_texts_without_id_apart(spark):
    """Texts of null id whose 32-bit hashes agree keep their own spans."""
    digests = F.concat(*[F.sha2(F.concat(F.lit(f"{k} "), F.col("id").cast("string")), 256) for k in range(8)])
    texts = spark.range(300_000).select(digests.alias("text")).withColumn("h", F.hash("text"))
    twins = texts.groupBy("h").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").limit(1).collect()
    assert twins
    one, other = twins[0].a, twins[0].b
    docs = spark.createDataFrame([(None, one), (None, other), (1, one)], "doc_id long, text string")
    found = [(r.doc_id, r.n_removed, bytes(r.kept).decode()) for r in windows.remove_repeats(docs).collect()]
    assert sorted(found, key=str) == sorted([(None, 512, ""), (None, 0, other), (1, 512, "")], key=str)


def test_planted_passages_of_the_width_are_all_found(spark):
    """Passages of 400 bytes and more in two texts each go; those of 399 bytes stay."""
    rng = random.Random(5)

    def letters(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))

    docs, want = [], {}
    for case, size in enumerate([399, 400, 401, 450, 800, 2_000] * 5):
        passage = letters(size)
        for copy in range(2):
            doc_id = 2 * case + copy
            # the neighbours of a passage differ, so that it doesn't grow by chance
            docs.append((doc_id, f"{letters(rng.randrange(900))}{copy}{passage}{copy}{letters(rng.randrange(900))}"))
            want[doc_id] = size if size >= 400 else 0
    docs += [(1_000 + i, letters(3_000)) for i in range(40)]
    want |= {1_000 + i: 0 for i in range(40)}
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in windows.remove_repeats(table).collect()} == want


def test_windows_cut_at_piece_borders(monkeypatch):
    rng = random.Random(1)
    text = bytes(rng.choices(b"abc", k=5000))
    whole = windows.anchored_runs(text, 40, windows.Roller(20))
    monkeypatch.setattr(windows, "_PIECE", 700)
    pieces = windows.anchored_runs(text, 40, windows.Roller(20))

    def by_start(runs):
        return {s: (h, p) for h, p, a, b in zip(*map(list, runs)) for s in range(a, b + 1)}

    assert by_start(whole) == by_start(pieces)


# ------------------------------------------------------------------ benchmark items


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
def test_bit_parallel_distance(item, text):
    edits, end = decontaminate.best_end(item, text)
    assert edits == brute.edit_distance_inside(item, text)
    assert end == 0 or brute.edit_distance_inside(item, text[:end]) == edits


def edited(text, edits, rng):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + "z" + text[i:], text[:i] + "q" + text[i + 1 :]])
    return text


def test_contamination_with_edits(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 40)))) for i in range(25)] + [(90, ""), (91, None)]
    docs = [(1, None), (2, ""), (None, items[0][1])]
    for i in range(80):
        item = items[i % 25][1]
        budget = decontaminate.edit_budget(item, decontaminate.EDIT_SHARE)
        inner = edited(item, rng.choice([0, budget // 2, budget, budget + 1, 3 * budget + 2]), rng)
        docs.append((10 + i, f"{' '.join(rng.choices(words, k=20))}  {inner.upper()}\n{' '.join(rng.choices(words, k=9))}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for doc_id, text in docs:
        for item_id, item in items:
            item = decontaminate.plain(item or "")
            edits = brute.edit_distance_inside(item, decontaminate.plain(text or "")) if item else 1
            if edits <= decontaminate.edit_budget(item, decontaminate.EDIT_SHARE):
                want.append((doc_id, item_id, edits))
    for block in (4_000_000, 500):
        found = decontaminate.contamination(frame(spark, docs), bench, block_chars=block)
        assert got(found, "doc_id", "item_id", "edits") == expected(want)
    for r in found.where("edits = 0").collect():
        text = decontaminate.plain(dict(docs)[r.doc_id])
        assert text[r.start : r.end] == decontaminate.plain(dict(items)[r.item_id])


def test_contamination_of_edges(edge_docs, spark):
    bench = spark.createDataFrame([(1, "same text"), (2, None), (None, "word1")], "item_id long, text string")
    found = got(decontaminate.contamination(edge_docs, bench), "doc_id", "item_id")
    want = [(7, 1), (8, 1), (15, None), (16, None)]
    assert found == expected(want)


# ------------------------------------------------------------------ BPE


def reference_rows(docs):
    t = Tokenizer.from_file(VOCAB)
    t.no_padding(), t.no_truncation()
    out = []
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, ids, t.decode(ids, skip_special_tokens=False)))
    return out


def coded_rows(df):
    rows = df.select("doc_id", "ids", "decoded").collect()
    return [(r.doc_id, list(memoryview(bytes(r.ids)).cast("I")), r.decoded) for r in rows]


HARD = [
    (1, "<|endoftext|>a<|endoftext|> <|endoftext|"), (2, "I'll  we've\t\tit's 'S x'reals\n\n end   "),
    (3, "日本語テスト ١٢٣ ½ é 👩‍👩‍👧 \U0001f600"), (4, "\x00\x01\x1c\x1d\x1e\x1f\x85 \xa0᠎​ 　 x"),
    (5, "a" * 3000 + " " * 200 + "b"), (6, "͸԰ \U000e0001 a\u0558b \u0cdc1"), (7, None), (8, ""), (None, "no id"),
]


@pytest.mark.parametrize("size", [0, 40, 100_000])
def test_bpe_of_tables_and_hard_texts(spark, size):
    docs = small_docs() + HARD
    found = bpe.encode_decode(frame(spark, docs), VOCAB, size)
    assert expected(coded_rows(found)) == expected(reference_rows(docs))


def test_bpe_of_edges(edge_docs):
    found = bpe.encode_decode(edge_docs, VOCAB)
    assert expected(coded_rows(found)) == expected(reference_rows(edge_rows()))
    assert sorted(found.columns) == sorted(edge_docs.columns)


def test_words_agree_on_every_character():
    t, vocab = Tokenizer.from_file(VOCAB).pre_tokenizer, bpe.Vocabulary(VOCAB)
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    usual = [c for c in characters if not bpe.unusual()[ord(c)]]
    for part in [usual[i : i + 4096] for i in range(0, len(usual), 4096)] + [characters[0x500:0x600]]:
        text = "".join(f" {c}a{c}1{c}.{c}\n" for c in part)
        assert vocab.words(text) == [text[a:b] for _, (a, b) in t.pre_tokenize_str(text)], hex(ord(part[0]))


def test_words_merged_together_come_out_as_one_by_one():
    vocab = bpe.vocabulary(VOCAB)
    rng = random.Random(3)
    words = [bytes(rng.choices(b" etaoinshrdluETA\xc3\xa9\xbc019_", k=rng.randint(0, 60))) for _ in range(6000)]
    words += [b"a" * n for n in range(90)]
    for word, packed in zip(words, vocab.merge_many(words)):
        assert packed == b"".join(i.to_bytes(4, "little") for i in vocab.merge(word)), word
    assert vocab.merge_many([]) == []


def test_lexicon_is_minimal_and_finds_exactly_its_words(tmp_path):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(1, 7))).encode() for _ in range(400)})
    entries = [(w, [i, i + 1][: i % 3]) for i, w in enumerate(words)]
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.compile_lexicon(entries))
    lexicon = bpe.Lexicon(str(path))
    assert all(lexicon.find(w) == ids for w, ids in entries)
    assert all(lexicon.find(w + b"e") is None for w in words) and lexicon.find(b"") is None
    endings = {frozenset(w[i:] for w in words if w[:i] == p) for v in words for i in range(len(v) + 1) for p in [v[:i]]}
    assert len(lexicon.finals) == len(endings)


# ------------------------------------------------------------------ empty tables


def test_empty_tables(spark, no_docs):
    bench = spark.createDataFrame([(1, "item")], "item_id long, text string")
    for result in (
        simhash.near_duplicates(no_docs), exact.exact_duplicates(no_docs), lines.dedup_lines(no_docs),
        windows.remove_repeats(no_docs), bpe.encode_decode(no_docs, VOCAB),
        decontaminate.contamination(no_docs, bench),
    ):
        assert result.count() == 0
    docs = no_docs.unionByName(no_docs.sparkSession.createDataFrame([(1, "x")], "doc_id long, text string"), True)
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0
    assert docs.where(F.lit(True)).count() == 1
