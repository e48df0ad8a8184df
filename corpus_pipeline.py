"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Languages are told first; texts that no language model accepts go. Of equal texts one stays, then of
near-duplicates (word 5-grams, similarity 0.8 or more) one. Documents with benchmark items go. What is
left is packed into sequences.

Nulls and edge cases are those of the operators: a null or letterless text has no language and goes in
the first stage; rows without an id are kept by the stages that compare ids; empty tables pass
through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import cut_lineage, table
from gridloom.llm.decontamination import without_contaminated
from gridloom.llm.exact_dedup import drop_copies
from gridloom.llm.jaccard_join import near_duplicates
from gridloom.llm.language_id import identify
from gridloom.llm.packing import pack_documents
from gridloom.operators.lookup import lookup_join

#: Rows that go to a Python task at once, and words whose ids a task keeps in the last stage. The stages
#: share executors, whose Python workers stay: with less in hand each of them stays small.
ROWS_AT_ONCE = 1000
WORDS_KEPT = 100_000


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose id is not among ``dropped``, which may be as many as the rows."""
    dropped = cut_lineage(dropped.select("doc_id").distinct(), "dropped")
    return lookup_join(docs, dropped, ["doc_id"], ["doc_id"], "left_anti").select(docs.columns)


def _slim(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _slim(spark)
    return _without(docs, identify(docs).where("NOT accepted"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _slim(spark)
    return _without(docs, near_duplicates(docs, gram=5, percent=80).where("doc_id != component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _slim(spark)
    return without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _slim(spark)
    return pack_documents(docs, words_kept=WORDS_KEPT)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Language models, retrieval and packing are beyond SQL; the operators are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
