"""Parquet tables, text lists and graph directories: reading and writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCHEMAS, conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_columns(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(columns) if columns else df


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """page_id and title, whether the file calls them so or id and name; without a title column, it is null."""
    df = spark.read.parquet(path)
    key = next(c for c in ("page_id", "id") if c in df.columns)
    title = next((F.col(c) for c in ("title", "name") if c in df.columns), F.lit(None).cast("string"))
    return df.select(F.col(key).cast("long").alias("page_id"), title.alias("title"))


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """A title a line; blank lines go, nothing else does."""
    return spark.read.text(path).select(F.trim("value").alias("title")).filter("title <> ''").distinct()


def read_patterns(spark: SparkSession, path: str) -> list[str]:
    """A regular expression a line; blank lines and lines that begin with # go. The whole list is read."""
    lines = spark.read.text(path).select(F.trim("value").alias("p")).filter("p <> '' AND NOT startswith(p, '#')")
    return [r.p for r in lines.collect()]


def read_graph(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a graph folder and its metadata; those that are not there are left out."""
    out = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in ("nodes", "edges", "title_index", "ancestors") if exists(spark, f"{folder}/{name}.parquet")}
    if exists(spark, f"{folder}/metadata.json"):
        out["metadata"] = spark.read.schema(SCHEMAS["metadata"]).json(f"{folder}/metadata.json")
    return out


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_table(df: DataFrame, path: str, schema: str | None = None) -> None:
    """Parquet with zstd; an empty table is written with its schema too."""
    (conform(df, schema) if schema else df).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_categories(categories: DataFrame, path: str) -> None:
    write_table(categories.withColumn("page_count", F.coalesce("page_count", F.lit(0))), path, "categories")


def write_graph(graph: dict[str, DataFrame], folder: str) -> None:
    for name, df in graph.items():
        if name == "metadata":
            df.coalesce(1).write.mode("overwrite").json(f"{folder}/metadata.json")
        else:
            write_table(df, f"{folder}/{name}.parquet")


def write_titles(titles: DataFrame, path: str, order: Column, header: str | None = None) -> None:
    """A title a line in one file, in order; a header line begins with #."""
    lines = titles.filter("title IS NOT NULL").select(F.lit(1).alias("part"), F.col("title").alias("value"), *(F.col(c) for c in titles.columns if c != "title"), F.col("title"))
    if header:
        lines = lines.unionByName(titles.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit(f"# {header}").alias("value")), allowMissingColumns=True)
    # One file is wanted, so one task writes it; the list is short by nature.
    lines = lines.repartition(1).sortWithinPartitions("part", order).select("value")
    lines.write.mode("overwrite").text(path)
