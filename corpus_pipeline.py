"""Documents to packed training sequences: filter, deduplicate, pseudonymise, mix, pack.

Each stage is one operator of ``plateful.llm`` over all rows that its predecessor kept. Its rows
are written as Parquet to the shared checkpoint folder and read back, so a lost executor
costs no earlier stage. A stage's folder is deleted once its successor is written, also where a stage fails, so
no text from before the pseudonyms stays; that of the last stage, one row per piece of a
sequence, is the result's and the caller's to delete.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateful.llm import mixing, packing, pseudonyms, quality, simhash
from plateful.llm.queries import pseudonym_key
from plateful.llm.shared import table
from plateful.plans.staging import remove_folder, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id."""
    return simhash.one_per_component(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text becomes pseudonyms; n_chars follows the text."""
    done = pseudonyms.pseudonymous_documents(docs, pseudonym_key(spark))
    return done.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("PII", pii),
          ("mixing", mix_sources), ("packing", pack)]

# Fingerprints, lots and token ids have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """The rows of the last stage over ``documents``, written to ``path`` or to a new folder of the shared one."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    before, last = None, path or f"{folder}/packed"
    try:
        for n, (_, stage) in enumerate(STAGES):
            written = last if n == len(STAGES) - 1 else f"{folder}/{n}"
            stage(spark, docs, sf_dir).write.parquet(written)
            docs = spark.read.parquet(written)
            if before:
                remove_folder(spark, before)
            before = written
    except BaseException:
        remove_folder(spark, folder)
        raise
    return docs
