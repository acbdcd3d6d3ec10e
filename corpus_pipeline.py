"""The corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers

from stellata.llm import bpe, exact_dedup, mixing, simhash, toxicity
from stellata.llm.common import stored
from stellata.llm.queries import VOCABULARY


def drop_toxic(spark, docs, sf_dir):
    """Documents that the chain calls toxic go; all others stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def drop_copies(spark, docs, sf_dir):
    """One document of each class of equal texts stays."""
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each SimHash group stays, the one with the smallest id."""
    return simhash.representatives(docs)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as the mix of sources takes it."""
    return mixing.mixture(docs)


def tokenise(spark, docs, sf_dir):
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    path = public_tokenizers.path(VOCABULARY)
    tokens = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return bpe.digests(tokens).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_level_bpe", tokenise),
]

#: The first stage is a trained model and the third a graph search: no SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
