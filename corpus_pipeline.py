"""A training-data pipeline over the documents table: each stage keeps the columns of documents (the last adds the mix).

In every stage: columns beyond doc_id and text (and source, for the mix) pass as they are, whatever their names, and may be missing or null; very
long texts are handled whole; an empty table gives an empty one; rows are told apart only by what a stage says below."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firelark.llm import decontaminate, jaccard_join, mixing, shared, suffix_dedup, toxicity as tox

REJECT = 0.5  # documents whose toxicity score is so high go


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores REJECT or more go, each by its own text: rows of a repeated doc_id are judged one by one, equal ones alike. Null, empty
    and wordless texts score that of no evidence, and stay. doc_id may be null. Without labels of both kinds all rows stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~tox.held_out("doc_id", 4, 2))
    return tox.without_toxic(docs, tox.fit(docs, labels), REJECT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents linked by five-word shingle sets of similarity 0.8 or more the one with the smallest doc_id stays. All rows
    of a doc_id are one document, and stay or go together; rows without a doc_id, and null, empty and wordless texts, are linked with none and
    stay."""
    found = jaccard_join.jaccard_components(docs, 5, 80, 100)
    return shared.without_ids(docs, shared.written(found.where("component_id <> doc_id").select("doc_id").distinct(), "copies"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in runs of 50 that a document with a smaller doc_id has are cut, n_chars is counted anew, and a text of which no word is left goes. All
    rows of a doc_id are one document, cut each by its own text; rows without a doc_id, null, empty and short texts stay as they are."""
    return suffix_dedup.without_passages(docs, suffix_dedup.repeated_passages(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows of a doc_id go if a text of it holds a benchmark item (see decontaminate). Rows without a doc_id, null and empty texts stay; with no
    benchmark item all do."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay and get mix_block, mix_slot and mix_position, which replace columns of these names. A null source is one of its own; rows of a
    source are ordered by a hash of doc_id and text, of which either may be null, and ties take neighbouring places."""
    return mixing.mixed(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("decontamination", decontamination), ("mix", mix)]

ORACLE_SQL = None  # a fitted model and a schedule: tested against brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
