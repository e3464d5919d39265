"""Corpus pipeline: language ID, near duplicates, decontamination, secrets, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.  All
stages but the last return the columns of ``documents``.

1. language       documents without a letter go, nothing else is rejected, whether there are labelled rows to
                  fit on or not; a missing ``lang`` is filled with the predicted one (if there are), and
                  that is the only use of the predictions (scores and spans decide nothing here)
2. near_duplicates  of each group of linked documents the smallest doc_id stays
3. decontaminate  documents that hold a benchmark passage go
4. secrets        findings are replaced in the text by a mark; no document goes
5. mix            documents that the mix takes, with size, source_size, target, epochs and
                  taken (words taken, repeats counted)

``run(spark, sf_dir)`` applies them to the table ``documents``.  Four stages are beyond SQL
(trained model, similarity join, embeddings), so there is no statement to compare with;
the tests compare every stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontaminate, language, mixing, secrets, shingle_join
from basketry.llm.tables import shared_table, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.label_languages(docs, language.fit_documents(docs)).where(F.regexp_like("text", F.lit(r"\p{L}")))
    return found.withColumn("lang", F.coalesce("lang", F.nullif("lang_pred", F.lit(language.UNKNOWN)))).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("secrets", secret_stage),
    ("mix", mixing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
