"""A corpus made ready for training: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.arrow import unused
from tallyframe.llm.bpe import default_pattern, default_rank_file, encode_documents
from tallyframe.llm.decontam import contaminated
from tallyframe.llm.linededup import dedup_lines
from tallyframe.llm.minhash import MinHashSpec, near_duplicates
from tallyframe.llm.quality import fit_quality, score_quality
from tallyframe.llm.registry import load
from tallyframe.session import scratch_path

QUALITY_THRESHOLD = 0.3


def _own(docs: DataFrame) -> list:
    """The columns a stage was given, whatever their names."""
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, does not reject.

    Unlabelled, empty and null texts are scored like others; an empty table stays
    empty; repeated rows share their fate.
    """
    model = fit_quality(docs, load(spark, sf_dir, "labels"))
    score = unused(docs.columns, "__score")
    return score_quality(docs, model, name=score).filter(F.col(score) >= QUALITY_THRESHOLD).select(_own(docs))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without long lines that many share; ``n_chars`` counts what is left.

    A null text comes back empty. A document may end up empty and stays.
    """
    return dedup_lines(docs, counts=False).withColumn("n_chars", F.char_length("text").cast("long")).select(_own(docs))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group, on five-word shingles at 0.8.

    Empty texts are no duplicates and stay, as do rows without an id; repeated rows
    are one document and stay as they are.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), MinHashSpec(words=5, percent=80))
    # The texts of one id stand for themselves; an id stays if any of them does.
    gone = groups.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(_own(docs))


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of ``benchmark``. Empty texts and rows without an id stay."""
    found = contaminated(docs.select("doc_id", "text"), load(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(_own(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return encode_documents(docs, default_rank_file(), default_pattern(), digests=True)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", keep_distinct),
    ("decontamination", keep_unseen),
    ("byte_bpe", encode),
]

# Learned scores and token ids are not for SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written in the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
