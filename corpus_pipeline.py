"""A training corpus from raw documents: toxic texts go, near copies go, personal data is masked, sources are mixed, and
what is left is packed into sequences.

Each stage takes what its predecessor kept and returns a table; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm import mixing, near_dedup, packing, personal_data, registry, toxicity
from tabmill.sources.workspace import new_path

TOXIC = 0.5
MIX_SHARE = 0.8  # of the tokens that are left


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC, by a model learned from the labels outside the held-out fold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, docs.columns).where(F.col("toxicity") < TOXIC).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies, and all documents without one."""
    gone = near_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows."""
    out = personal_data.masked(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights of domains, languages and sources, none twice."""
    levels = {"domain": F.expr(registry.DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.select(docs, levels, MIX_SHARE, 1, registry.MIX_WEIGHTS, registry.MIX_SEED).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# The toxicity scores and the vocabulary have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
