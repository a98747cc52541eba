"""From raw documents to packed token sequences, in stages of DataFrame in, DataFrame out."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.contamination import decontaminate
from tidemark.llm.jobs import table
from tidemark.llm.packing import pack
from tidemark.llm.quality import keep_good, train
from tidemark.llm.secrets import redact
from tidemark.llm.simhash import drop_near_duplicates
from tidemark.llm.tables import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones outside its held-out fold, does not reject."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels"), "quality", folds=4, held_out=2), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near-duplicates."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in them are replaced by a mark."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack(docs, length=2048)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: No SQL for a trained classifier and a tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
