"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet in the shared folder and read again as
the next one's input. All but the last return the columns of ``documents``, any
further ones with them.

Defined results of all stages: empty texts pass through, null ones count as empty
(the third stage writes them so) and have no tokens; rows that repeat an id stay or go together; rows
with a null id stay unless toxic or contaminated; of equal texts the smallest
id stays; an empty table stays empty; columns of any name keep their values.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordwave.llm import bpe, decontaminate, jaccard, linededup, scratch, toxicity

PERCENT = 75         # similarity of near duplicates
LINE_WORDS = 8       # words of a whole line that is cut where it repeats; shorter ones are headings and names
CONTAINED = 0.75     # share of a benchmark item's shingles that makes a document contaminated


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity model rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = docs.select("text", F.struct(*docs.columns).alias("__row"))
    return toxicity.score(rows, model, keep=["__row"]).where("predicted = 0").select("__row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return jaccard.one_of_each(docs, PERCENT)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later occurrences of passages and lines out of the texts."""
    cut = linededup.clean(docs, lines=True, line_words=LINE_WORDS)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), CONTAINED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids of each remaining text."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("repeated_passages", cut_repeated_passages),
          ("decontamination", drop_contaminated), ("encode", encode)]

#: None: training a model, and encoding, are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    scratch.ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
