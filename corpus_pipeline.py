"""A cleaning run over documents: toxicity, lines, near duplicates, benchmark items, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
stored before the next stage reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintero.llm import bpe, decontaminate, lines, simhash, toxicity
from tintero.llm.common import join_small
from tintero.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labels, does not call toxic.  A null text scores as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.train(toxicity.labelled(docs, labels))
    scored = toxicity.score(docs.select(*COLUMNS), weights)
    return scored.where(F.col("predicted") == 0).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that newer documents hold; documents stay, if need be with an empty text."""
    kept = lines.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: three-word shingles, fingerprints within two bits."""
    return simhash.keep_one(docs.select(*COLUMNS), words=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, told apart by a number of each row instead of their ids."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    numbered = materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = decontaminate.contamination(numbered.select(F.col("row").alias("doc_id"), "text"), benchmark)
    found = materialize(found.select(F.col("doc_id").alias("row")).distinct(), "contaminated")
    return join_small(numbered, found, ["row"], "left_anti", 16).drop("row")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as ids of the public vocabulary, with what the ids decode to."""
    coded = bpe.encode_decode(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    digest = F.sha2("ids", 256).alias("ids_sha256")
    return coded.select("doc_id", "lang", "source", n_tokens, digest, "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Hashes, edit distances and trained models have no SQL form; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
