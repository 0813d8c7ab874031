"""Stages of the corpus pipeline against plain versions."""

import random
from collections import defaultdict

import brute
import corpus_pipeline
import duckdb
import public_tokenizers
from edges import edge_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tintero.llm import toxicity

SMALL = "/root/testdata/sf0.001"


def staged(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    n_chars = F.char_length("text").cast("long").alias("n_chars")
    return frame.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("web").alias("source"), n_chars)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def small_docs():
    return duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()


def plain_near_dedup(docs):
    """One row per group of fingerprints, the one with the smallest id, rows without an id last."""
    prints = [brute.simhash(t, 3) for _, t in docs]
    members = defaultdict(list)
    for row, root in enumerate(brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 2)):
        members[root].append(row)
    kept = {min(rows, key=lambda r: (docs[r][0] is None, docs[r][0] or 0, r)) for rows in members.values()}
    return [docs[r] for r in sorted(kept)]


def test_near_dedup_keeps_one_of_each_group(spark):
    rng = random.Random(4)
    base = [f"word{i}" for i in range(300)]
    docs = [(i, " ".join(w if rng.random() > 0.01 * (i % 3) else "other" for w in base)) for i in range(30, 0, -1)]
    docs += small_docs() + [(50_000 + i, None) for i in range(3)]
    left = corpus_pipeline.drop_near_duplicates(spark, staged(spark, docs), SMALL)
    assert pairs(left) == sorted(plain_near_dedup(docs), key=str)
    assert len(plain_near_dedup(docs)) < len(docs) - 20


def test_toxic_documents_go_and_all_others_stay(spark):
    docs = small_docs() + [(None, None), (None, ""), (7, "plain words"), (7, "plain words")]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    frame = staged(spark, docs)
    model = toxicity.Model(*toxicity.train(toxicity.labelled(frame, labels)).value)
    want = [(d, t) for d, t in docs if model.score(t or "")[0] < 0.5]
    left = corpus_pipeline.drop_toxic(spark, frame, SMALL)
    assert left.columns == list(corpus_pipeline.COLUMNS)
    assert pairs(left) == sorted(want, key=str)


def plain_lines(docs):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(brute.SPACE))

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(-1 if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        at = -1 if doc_id is None else doc_id
        lines = (text or "").split("\n")
        out.append((doc_id, "\n".join(x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == at)))
    return out


def test_repeated_lines_go_but_documents_stay(spark):
    docs = small_docs() + [(d, t) for d, t in edge_rows()]
    left = corpus_pipeline.drop_repeated_lines(spark, staged(spark, docs), SMALL)
    assert pairs(left) == sorted(plain_lines(docs), key=str)
    assert left.where(F.col("n_chars") != F.char_length("text")).isEmpty()


def test_encoding_as_the_library_does(spark):
    docs = [(d, t) for d, t in small_docs()[:60] + edge_rows()]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    want = [(d, library.encode(t or "", add_special_tokens=False).ids) for d, t in docs]
    found = corpus_pipeline.encode(spark, staged(spark, docs), SMALL)
    got = [(r.doc_id, list(memoryview(bytes(r.ids)).cast("I")), r.n_tokens, r.round_trip) for r in found.collect()]
    assert sorted(((d, i) for d, i, _, _ in got), key=str) == sorted(want, key=str)
    assert all(n == len(i) and whole for _, i, n, whole in got)


def test_stages_of_no_documents(spark):
    none = staged(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).collect() == []


def test_run_applies_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe",
    ]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect() or [], docs.schema) if stage is not corpus_pipeline.encode else stage(spark, docs, SMALL)
    columns = ["doc_id", "n_tokens", "ids_sha256", "round_trip"]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).select(columns).collect())
    assert got == sorted(tuple(r) for r in docs.select(columns).collect()) and len(got) > 100


def test_near_dedup_decides_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    docs = [(None, a), (None, a), (7, b), (7, b), (7, c), (3, c), (None, c), (8, "alone one two three four five")]
    left = corpus_pipeline.drop_near_duplicates(spark, staged(spark, docs), SMALL)
    assert left.columns == list(corpus_pipeline.COLUMNS)
    want = [(None, a), (7, b), (3, c), (8, "alone one two three four five")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)


def test_decontamination_decides_by_row(spark):
    item = next(r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if r.text and len(r.text) > 60)
    docs = [(None, f"before {item} after"), (None, "clean text without any of it"), (5, item), (5, "a clean one with the same id")]
    left = corpus_pipeline.drop_contaminated(spark, staged(spark, docs), SMALL)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([docs[1], docs[3]], key=str)
