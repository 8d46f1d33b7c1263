"""A corpus made ready for training, in five stages over ``documents``.

Toxic documents go; of near duplicates the one with the smallest doc_id stays; documents that hold benchmark
items go; personal data is masked; what is left is packed into sequences. Each stage works on all that the
one before has kept, written as Parquet in the shared folder and read again. All but the last return the
columns of documents, whatever these are and whatever their names; the last returns the packed pieces.

Cases, for all stages: an empty table gives none; texts of any length are worked on whole. A null or empty text is not
toxic (it has the score of no match), has no near duplicates and no benchmark item, holds no personal data, and is packed
as the end token alone. Repeated rows are toxic, contaminated or masked alike; of rows with equal or near-equal texts one
stays, those with a null doc_id included. Ties (equal texts, equal ids) are settled by the smallest doc_id.

No SQL gives the rows of run() (a learned model and tokenizers are among its stages), so ORACLE_SQL is None;
tests/llm/test_pipeline.py holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, jaccard, packing, pii, toxicity
from cadenza.llm.scratch import release, written_once

ORACLE_SQL: str | None = None
LIMIT = 4096


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, learned from the labels that aren't held out: documents that score 0.3 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, labels.where(~toxicity.held_out(labels["doc_id"])), 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group stays, the one with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents with 0.8 or more of a benchmark item's shingles go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 0.8)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: spans are replaced by their kind. n_chars, where it is there, counts the new text; other columns stay as they were."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the pieces' places in sequences of at most LIMIT tokens. Rows with equal ids are packed each."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), LIMIT)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each on the written result of the one before, which is then deleted with all that it was made of."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written_once(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
