"""From raw documents to token ids: STAGES applied one after the other, each to all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm import bpe, curriculum, quality, rules
from churnkit.llm.common import read, store
from churnkit.llm.ngram_join import distinct_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely of the top grade; toxic and poor ones go."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs.select(*COLUMNS), model).filter("kept").select(*COLUMNS)


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    learned = rules.train(docs, read(spark, sf_dir, "labels"))
    return rules.judge(docs.select(*COLUMNS), learned).filter("kept").select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; of repeated rows one stays. Documents without an id are judged by their text."""
    return distinct_documents(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them. Texts stay whole: the copy in which a source reaches its
    target is taken if at least half of it is wanted."""
    scheduled = curriculum.schedule(docs.select(*COLUMNS))
    return scheduled.filter(2 * F.col("mix_taken") >= F.col("mix_size")).select(*COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, in the given order within a file."""
    import public_tokenizers  # only this stage needs it

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", graded),
    ("quality rules", ruled),
    ("n-gram Jaccard join", distinct),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", tokenized),
]
#: The learned stages have no SQL; the tests hold the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
