"""The corpus pipeline: documents are judged, filtered, deduplicated, mixed and encoded, one written stage after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmetrics.llm import bpe, classifier, jaccard, mixing, quality_rules
from lossmetrics.llm.batches import set_aside
from lossmetrics.llm.queries import quality_model, table, tokenizer_path
from lossmetrics.llm.tables import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents with a lower quality score are rejected.
MIN_SCORE = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained classifier does not reject."""
    return classifier.score(docs, quality_model(spark, docs, sf_dir), result="__score").where(F.col("__score") >= MIN_SCORE).select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood threshold, both taken over the documents that are left."""
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"))
    weights = quality_rules.bucket_weights(docs, trusted)
    renamed, back = set_aside(docs, quality_rules.RESULTS)
    return back(quality_rules.judge(renamed, weights).where("kept"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five words, 80 percent)."""
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to tempered source weights, about as many rows as before, in a global shuffle."""
    renamed, back = set_aside(docs, ("copy", "order_key"))
    return back(mixing.replicate(renamed, mixing.rates(docs, mixing.tempered(docs))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row with their digest and that of the decoded text."""
    rows = docs.select("doc_id", "lang", "source", "n_chars", "text")
    return bpe.round_trip(rows, tokenizer_path(), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("n-gram Jaccard join", deduplicate),
    ("mixing", mix),
    ("BPE encoding", encode),
]

#: The classifier, the hashes and the vocabulary have no SQL form; tests/llm compares the pipeline with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "stage")
    return docs
