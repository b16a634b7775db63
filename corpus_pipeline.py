"""The training-data pipeline over ``documents``: quality, near-duplicates,
benchmark passages, personal data, token ids.

``STAGES`` are (name, function) pairs; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as
the next one's ``docs``.  All but the last return the columns of ``documents``.

1. ``quality``: documents the classifier rejects go (it learns from the labels
   of the documents it is given).
2. ``near_duplicates``: one document of every group of copies stays.
3. ``decontaminate``: documents that hold a benchmark passage go.
4. ``pii``: personal data is replaced by its kind in brackets; ``n_chars`` is
   the length of the new text where there was one.
5. ``encode``: the token ids of every text, and the text they decode to.

Extra columns pass through the filters unchanged; NULL texts count as empty and
rows without an id are kept where no stage can decide about them.  Tables may
be empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import bagminhash, bpe_codec, decontaminate, pii
from lakeloom.llm import quality as ranking
from lakeloom.llm.queries import quality_training
from lakeloom.llm.store import ship_code
from lakeloom.session import scratch_path

#: No SQL: the classifier and the encoder have no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ranking.keep_good(docs, ranking.learn(docs, quality_training(docs, labels)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return bagminhash.one_per_class(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return bpe_codec.encode_documents(docs, "word_bpe_49k.json")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminated),
          ("pii", masked), ("encode", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: ``doc_id, n_tokens, ids, decoded``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
