"""From documents to token ids: toxic texts go, near-duplicates go, sources are mixed, texts are encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, mixing, simhash, toxicity

#: Pieces that the encoder remembers in a worker.
PIECES = 100_000
#: The stages draw, learn and encode in ways SQL has no form for; tests hold them against plain versions.
ORACLE_SQL = None


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity; learned from the labels of the documents that are here."""
    return toxicity.keep_clean(docs, toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (Jaccard 0.8 or more of five-word shingles) the document with the smallest doc_id."""
    return simhash.keep_one_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): one row for each time a document is taken. The stages before leave less memory than speed:
    the encoder remembers fewer pieces, and the bytes that the ids decode to are not made."""
    import public_tokenizers as P

    done = bpe.encode(docs, bpe.read_ranks(spark, P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN, pieces=PIECES, decode=False)
    return done.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", clean), ("simhash", dedup), ("mixing", mix), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over documents; each is written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
