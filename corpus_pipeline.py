"""A training corpus in five stages, each a function of (spark, docs, sf_dir).

Every stage but the last returns the columns of the documents. Between stages the rows are
written and read again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hammerline.llm import bpe, exact_dedup, mixing, simhash_vp, toxicity
from hammerline.session import write_table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go.

    NULL and empty texts match no clause and stay; repeated rows share one score; very long texts
    are scored whole. Without labels of both kinds, or an empty table, nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays.

    NULL is the empty text; a NULL id is smaller than any other; of rows alike in id and text one
    stays. All columns are kept, whatever their names.
    """
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the smallest id stays.

    Texts without words have the fingerprint zero and are linked like any other; a NULL id is
    larger than any other here; of rows alike in id and text one stays.
    """
    return simhash_vp.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it.

    NULL and empty texts have size 0 and cost nothing of a target; a NULL source is a source of its
    own; ties are drawn by a seeded hash, so reruns agree. An empty table gives an empty mixture.
    """
    return mixing.apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text.

    NULL and empty texts have no ids; texts of any length are encoded whole; repeated rows are
    encoded alike.
    """
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

# The learned score, the fingerprints and the token ids can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_table(docs, f"stage-{i}")
    return docs
