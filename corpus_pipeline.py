"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm.common import store
from marketloom.llm.mixing import mixed
from marketloom.llm.neardup import one_of_each
from marketloom.llm.packing import packed
from marketloom.llm.pii import without_personal_data
from marketloom.llm.quality import keep_good

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", one_of_each),
    ("personal data", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

#: Shingle hashing, keyed surrogates and tokenising are beyond SQL; tests hold stages against
#: invariants, and near duplicates against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
