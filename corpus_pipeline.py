"""Corpus pipeline: quality, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
All but the last return the columns of ``documents``; ``run`` writes every
stage's rows as Parquet under the shared folder and reads them back.

Rows with a null id are never near duplicates or leaks; rows that share an id
are one document for the near-duplicate stage, which keeps one of them.  Every
stage passes an empty table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import bpe, decontaminate, near_dedup, quality, secrets
from txlake.llm.common import fresh, table, written
from txlake.llm.queries import tokenizer_path

#: Documents of a batch in the token stage.
BATCH_ROWS = 500


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1."""
    score = quality.score_udf(quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))
    name = fresh(docs, "_quality")
    scored = docs.withColumn(name, score(F.col("text").cast("string")))
    return scored.where(quality.predicted(F.col(name)) == 1).drop(name)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 0.8."""
    groups = near_dedup.near_duplicates(docs, width=5, percent=80)
    gone = written(groups.where("not kept").select(F.col("doc_id").alias("_id")).distinct(), "pipeline_near")
    kept = docs.join(gone, docs["doc_id"] == gone["_id"], "left_anti")
    again = written(
        kept.select("doc_id").where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id")),
        "pipeline_again",
    )
    if not again.head(1):
        return kept
    same = kept["doc_id"] == again["_id"]
    one = kept.join(again, same, "left_semi").groupBy("doc_id").agg(F.min(F.struct(*kept.columns)).alias("_row")).select("_row.*")
    return kept.join(again, same, "left_anti").unionByName(one)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    leaks = written(found.select(F.col("doc_id").alias("_id")).distinct(), "pipeline_leaks")
    return docs.join(leaks, docs["doc_id"] == leaks["_id"], "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; credentials of one owner that look live are masked, and
    ``n_chars`` follows."""
    return secrets.mask_secrets(docs, count_col="n_chars")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left.  Texts reach the tasks in
    batches of ``BATCH_ROWS`` (a setting of the session), so that a batch of long
    texts stays small beside the words that a task holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return bpe.token_digests(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]

#: The classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
