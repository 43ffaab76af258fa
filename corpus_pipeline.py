"""The corpus pipeline: documents -> no toxic ones -> one of each near-duplicate group -> no
contaminated ones -> personal data redacted -> tokens.

Each stage calls one operator of ``inkstream.llm`` on all rows its predecessor kept. ``run`` writes
every stage's rows to the shared folder and reads them again, so a lost executor never costs more than
one stage. All stages but the last keep the columns of ``documents`` (and any others); the operators'
docstrings say what happens to nulls, empty and very long texts, ties, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkstream.llm import bpe, decontaminate, pii, simhash, toxicity
from inkstream.llm.common import materialize, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxicity grade is below the cut; trained on the labels."""
    return toxicity.drop_toxic(docs, toxicity.trained(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.redact(docs, pii.train(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ids, their number and digests of ids and decoded text."""
    return bpe.encode(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("decontaminate", drop_contaminated),
          ("pii", redact), ("bpe", tokenise)]

#: Trained models, near duplicates and a tokenizer: not in SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
