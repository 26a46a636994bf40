"""The corpus pipeline: documents to packed training sequences.

Four stages, each on all that its predecessor kept: documents that the quality classifier
rejects go; one document of each group of near-duplicates stays; secrets are replaced by a
mark; what remains is tokenised and packed.  Each stage's result is written as Parquet in
the shared folder and read again, so a lost executor or a failed stage costs no more than
that stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tianguis.llm.common import ship_package, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose score is 0.5 or more; learned from the labelled ones of ``documents``.

    The model is fitted on the labelled documents of the input alone and never sees a
    document's label when it scores it.
    """
    from tianguis.llm.quality import keep_good

    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: shingles of five words, similarity of 0.8 or more."""
    from tianguis.llm.simhash import drop_near_duplicates

    return drop_near_duplicates(docs, width=5, similarity=0.8)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark and ``n_chars`` counted anew."""
    from pyspark.sql import functions as F

    from tianguis.llm.secrets import redact

    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, with their ids."""
    import public_tokenizers

    from tianguis.llm.packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packing)]

#: SQL can express neither the classifier nor the fingerprints' links; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        ship_package(spark)
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
