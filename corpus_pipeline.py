"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
docs of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm.common import only, remove, staged, table
from loomgraph.llm.decontam import drop_leaks
from loomgraph.llm.langid import UNKNOWN, predict, train
from loomgraph.llm.lines import dedup_lines
from loomgraph.llm.packing import pack
from loomgraph.llm.shingles import first_of_similar

#: Rows that go to Python at once, in the session that the pipeline runs in. Texts are long, and four stages out of five
#: send them whole; Spark's default of 10,000 rows took an executor of 3,000 MB over its memory in a long run.
ARROW_ROWS = 256
#: Documents whose language is told with less confidence go.
MIN_SCORE = 0.5


def configured(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier tells; it learns from those that are labelled."""
    configured(spark)
    told = predict(docs, train(docs))
    return told.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier line; n_chars is that of the text that is left."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that shingles of five words link at a Jaccard similarity of 0.8 or more."""
    configured(spark)
    return first_of_similar(docs, width=5, num=4, den=5)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    configured(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document goes in the training sequences."""
    configured(spark)
    return pack(docs)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("packing", packing)]

#: Language models, fingerprints, alignment and tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, only(lambda: staged(stage(spark, docs, sf_dir), f"stage-{name}"))  # noqa: B023  # called at once
        if hasattr(before, "scratch_path"):
            remove(spark, before.scratch_path)
    return STAGES[-1][1](spark, docs, sf_dir)
