"""The registered queries of the operators on the test tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pages, toxicity
from .contamination import ORACLE as CONTAMINATION_SQL
from .contamination import contaminated
from .hardneg import ORACLE as HARDNEG_SQL
from .hardneg import hard_negatives
from .infill import ORACLE as INFILL_SQL
from .infill import fill_in_middle, with_restored
from .licenses import license_scan
from .ngrams import ngram_scores
from .packing import pack
from .quality import fold, quality_scores, train
from .repetition import repetition_rules
from .secrets import secret_scan
from .simhash import simhash_near_duplicates
from .suffixes import remove_repeats

QUERIES, ORACLES = {}, {}


#: Spark hands Python so many rows at a time by default; of whole texts, this many.
DEFAULT_ROWS, TEXT_ROWS = "10000", "2000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Unless the session says otherwise, texts go to Python in smaller batches."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == DEFAULT_ROWS:
        spark.conf.set(rows, TEXT_ROWS)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


@query
def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@query
def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op6_contamination"] = CONTAMINATION_SQL


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), length=2048)


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), "quality", folds=4, held_out=2)
    scores = quality_scores(docs, model, threshold=0.7)
    return scores.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", folds=5, held_out=0)
    scores = toxicity.toxicity_scores(docs, model, threshold=0.5)
    return scores.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages")
    )


@query
def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), least=100).drop("kept")


@query
def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages")
    return pages.main_texts(rows, pages.train(rows))


@query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = with_restored(fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op13_infill"] = INFILL_SQL


@query
def op11_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


ORACLES["op11_hardneg"] = HARDNEG_SQL


@query
def op12_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    scores = ngram_scores(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return scores.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
