"""Pages as visual or abstract: by rules over their categories, or by a classifier that is plugged in."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.titles import align_answers, matches_parts, parse_answers
from ..sources.tables import exists


def classify(nodes: DataFrame, page_categories: DataFrame, categories: DataFrame) -> DataFrame:
    """page_id, title, classification (visual, abstract or null if both or neither) and num_categories, the number of
    different known category titles. Flags are set once a category, not once a pair."""
    c = F.col("title")
    flags = categories.select("category_id", c.alias("category"), (c.isin(*fixed.VISUAL_TITLES) | matches_parts(c, fixed.VISUAL_PARTS)).alias("visual"), (c.isin(*fixed.ABSTRACT_TITLES) | matches_parts(c, fixed.ABSTRACT_PARTS)).alias("abstract"))
    held = page_categories.distinct().join(flags, "category_id").groupBy("page_id").agg(F.max("visual").alias("visual"), F.max("abstract").alias("abstract"), F.count_distinct("category").alias("num_categories"))
    out = nodes.select("page_id", "title").join(held, "page_id", "left")
    label = F.when(F.col("visual") & ~F.col("abstract"), "visual").when(F.col("abstract") & ~F.col("visual"), "abstract")
    return out.select("page_id", "title", label.alias("classification"), F.coalesce("num_categories", F.lit(0)).alias("num_categories"))


def classification_stats(classified: DataFrame) -> DataFrame:
    """Per class: pages, share in percent, smallest, median, mean and largest number of categories. The share comes
    from a total of one row."""
    per = classified.groupBy(F.coalesce("classification", F.lit("uncertain")).alias("classification")).agg(
        F.count("*").alias("pages"), F.min("num_categories").alias("min_categories"), F.percentile("num_categories", F.lit(0.5)).alias("median_categories"), F.avg("num_categories").alias("mean_categories"), F.max("num_categories").alias("max_categories")
    )
    return per.crossJoin(F.broadcast(classified.agg(F.count("*").alias("all")))).withColumn("pct", F.col("pages") * 100.0 / F.col("all")).drop("all")


def split_rules(classified: DataFrame) -> dict[str, DataFrame]:
    """What goes on: visual pages, and those that the rules leave open."""
    return {"visual": classified.filter("classification = 'visual'"), "uncertain": classified.filter("classification IS NULL"), "all": classified}


def ask(nodes: DataFrame, answer: Callable[[list[str]], str | None], batch: int = 30, retries: int = 3, wait: float = 1.0, limit: int | None = None) -> DataFrame:
    """page_id, title, visual (null where no answer came): titles go in batches to answer, which returns text with a
    JSON array of (title, visual); an answer without one is asked for again, after wait seconds, then twice as many and
    so on. With limit, only so many nodes are asked about, the first by id."""
    titles = nodes.filter("title IS NOT NULL").select("page_id", "title")
    if limit is not None:
        titles = titles.orderBy("page_id").limit(limit)

    def run(batches):
        for rb in batches:
            ids, names = rb.column(0).to_pylist(), rb.column(1).to_pylist()
            for k in range(0, len(ids), batch):
                part = names[k : k + batch]
                text = None
                for turn in range(retries):
                    if turn:
                        time.sleep(wait * 2 ** (turn - 1))
                    try:
                        text = answer(part)
                    except Exception:  # a classifier that fails gives no verdict
                        text = None
                    if text and "[" in text and "]" in text:
                        break
                yield pa.record_batch([pa.array([ids[k : k + batch]], pa.list_(pa.int64())), pa.array([part], pa.list_(pa.string())), pa.array([text], pa.string())], ["ids", "titles", "answer"])

    asked = titles.mapInArrow(run, "ids array<long>, titles array<string>, answer string")
    verdicts = asked.select("ids", align_answers(F.col("titles"), parse_answers(F.col("answer"))).alias("v"))
    return verdicts.select(F.explode(F.arrays_zip("ids", "v")).alias("x")).select(F.col("x.ids").alias("page_id"), F.col("x.v.title").alias("title"), F.col("x.v.visual").alias("visual"))


def resume(nodes: DataFrame, done: DataFrame) -> DataFrame:
    """Nodes that have no verdict yet."""
    return nodes.join(done.filter("visual IS NOT NULL").select("page_id"), "page_id", "left_anti")


def ask_in_parts(nodes: DataFrame, answer: Callable[[list[str]], str | None], path: str, every: int = 100, batch: int = 30, **how) -> DataFrame:
    """All verdicts, of which those at path are there already: what is open is asked in parts of about every batches for
    each core, and each part is added to path, so a run that breaks off goes on where it was."""
    spark = nodes.sparkSession
    if exists(spark, path):
        nodes = resume(nodes, spark.read.parquet(path))
    size = every * batch * spark.sparkContext.defaultParallelism
    parts = -(-nodes.count() // size)
    for k in range(parts):
        part = nodes.filter(F.pmod(F.xxhash64("page_id"), F.lit(parts)) == k)
        ask(part, answer, batch, **how).write.mode("append").parquet(path)
    if not exists(spark, path):
        ask(nodes, answer, batch, **how).write.parquet(path)
    # A page without a verdict is asked again, so it may have several rows.
    return spark.read.parquet(path).groupBy("page_id").agg(F.max("title").alias("title"), F.max("visual").alias("visual"))


def split_verdicts(verdicts: DataFrame) -> dict[str, DataFrame]:
    keep = verdicts.select("page_id", "title", "visual")
    return {"visual": keep.filter("visual"), "nonvisual": keep.filter("NOT visual"), "failed": keep.filter("visual IS NULL")}


def cost(nodes: DataFrame, tokens_in: int = 25, tokens_out: int = 15, price_in: float = 0.0008, price_out: float = 0.002, batch: int = 30) -> DataFrame:
    """One row: titles, batches, tokens and the price of asking for all, with prices per 1000 tokens."""
    n = F.count("title")
    return nodes.agg(n.alias("titles"), F.ceil(n / batch).alias("batches"), (n * tokens_in).alias("tokens_in"), (n * tokens_out).alias("tokens_out"), (n * tokens_in / 1000 * price_in + n * tokens_out / 1000 * price_out).alias("price"))
