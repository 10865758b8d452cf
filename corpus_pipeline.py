"""A corpus pipeline over ``documents``: quality, exact copies, near copies, mixture, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet in the shared folder
and read again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import fingerprints, mixing, packing, quality, simhash
from corpusloom.llm.queries import held_out, tokenizer_path
from corpusloom.runtime import discard_since, materialize, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents scored below 0.5 go. Learns from labelled rows outside the held-out third; without any, the score is 0.5 and all stay. A null text counts as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_quality(docs, labels, ~held_out(F.col("doc_id")))
    return quality.score_quality(docs, model, out="_cl_score").where("_cl_score >= 0.5").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of equal texts (white space normalised; null is empty) the row of the smallest doc_id stays, null ids last; of equal rows one."""
    return fingerprints.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of documents alike in five-word shingles (0.8 and more) one stays, that of the smallest doc_id; rows of null doc_id all stay. Texts without words are alike."""
    return simhash.drop_near_copies(docs, words=5, similarity=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: whole documents, repeated or left out so that each source (null is one) comes near its target of words. Documents without words aren't taken."""
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: pieces of the documents in sequences of at most 2048 tokens; repeated rows are separate documents, a null text is empty."""
    pieces = packing.pack_documents(docs.select("doc_id", "text"), tokenizer_path(), most_parts=120_000, at_once=2 << 20)  # workers have earlier stages' memory to bear
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: The classifier, SimHash and the tokenizer can't be written in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Of what they write in the shared folder only the last table stays, until ``runtime.cleanup``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), written(spark)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        discard_since(spark, before, docs)
    return docs
