"""Training-data pipeline over `documents`: five stages, each written as Parquet and read by the next.

1. language ID: documents whose language can't be told (null, no letter, or far less sure than
   any text of the learned languages) go;
2. SimHash near-duplicates: one document of each group stays, the one with the smallest doc_id;
3. benchmark decontamination: documents that hold a benchmark passage go;
4. secret scans: secrets are replaced by a mark, n_chars follows;
5. mixing: how many words the mix takes of each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwire.llm import decontaminate, langid, mixing, secrets, simhash
from tripwire.llm.shared import read, stash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (see ``langid.identify``): null texts, texts without a letter and far too unsure ones go.

    Repeated rows are judged alike; without labelled rows nothing can be told and all go; further columns stay.
    """
    model = langid.fit_language_model(docs)
    return langid.identify(docs, model).where("not rejected").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the least doc_id (see ``simhash``): 3-word shingles, 3 bits.

    Null and empty texts are linked like any other; rows with a null doc_id stay; an empty table stays empty.
    """
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage (see ``decontaminate``). The text decides, so null ids and repeated rows are no special case; a null text stays."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark (see ``secrets``). Null and empty texts stay as they are; texts of any length are scanned whole."""
    return secrets.redact(docs)


def mixing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document (see ``mixing``). Null texts have no words; null sources are one source, the last."""
    return mixing.mixture(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", mixing_plan),
]

#: SQL can't train the language model or search fingerprints; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix plan of `documents` after all stages."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir))
    return docs
