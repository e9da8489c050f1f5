"""The corpus pipeline: five stages over ``documents``, each written and reread.

A toxicity filter, one document of each near-duplicate group, decontamination,
pseudonyms for personal data, and packing.  A stage takes (spark, docs, sf_dir);
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import decontaminate, jaccard_join, packing, pseudonyms, shared, toxicity

#: Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
SHINGLE, SIMILARITY = 5, 0.8
#: The session setting that holds the key of the pseudonyms.  Without one a run
#: draws a key of its own, which nobody keeps.
KEY = "spark.weirgate.pseudonym.key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.3 or more go."""
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, lexicon, keep=True).where("predicted = 0").select("kept.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs, k=SHINGLE, threshold=SIMILARITY).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth of the words go."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=True)
    return found.where(~decontaminate.contaminated()).select("kept.*")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; n_chars follows the new text."""
    new = pseudonyms.pseudonymised(docs, spark.conf.get(KEY, None) or secrets.token_hex(32), keep=True)
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_found") > 0, F.length("text").cast("long")).otherwise(F.col("kept.n_chars"))}
    return new.select(*(changed.get(c, F.col(f"kept.`{c}`")).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

#: Learning, permutations and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
