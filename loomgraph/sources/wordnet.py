"""Synsets and their hypernyms from the public WordNet database files (data.noun and the like)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = {"n": "data.noun", "v": "data.verb", "a": "data.adj", "r": "data.adv"}


def read_synsets(spark: SparkSession, folder: str, pos: str | None = None) -> DataFrame:
    """The synsets of the files in folder, as parse_synsets has them; pos s is a satellite adjective, in the file of the
    adjectives."""
    names = [FILES["a" if pos == "s" else pos]] if pos else list(FILES.values())
    rows = parse_synsets(spark.read.text([f"{folder}/{n}" for n in names]))
    return rows.filter(F.col("pos") == pos) if pos else rows


def parse_synsets(lines: DataFrame) -> DataFrame:
    """(offset, pos, lemma, f, definition, pointers) of lines (column value). The words of a line follow their number in
    hexadecimal; pointers are (symbol, offset, pos)."""
    lines = lines.filter(F.col("value").rlike(r"^\d{8} "))
    parts = lines.select(F.split(F.split("value", r" \| ")[0], " ").alias("f"), F.trim(F.regexp_extract("value", r" \| (.*)$", 1)).alias("gloss"))
    rows = parts.withColumn("words", F.conv(F.get("f", F.lit(3)), 16, 10).try_cast("int")).withColumn("at", F.lit(4) + F.col("words") * 2)
    pointer = lambda k: F.struct(F.get("f", F.col("at") + 1 + k * 4).alias("symbol"), F.get("f", F.col("at") + 2 + k * 4).try_cast("long").alias("offset"), F.get("f", F.col("at") + 3 + k * 4).alias("pos"))
    n = F.get("f", F.col("at")).try_cast("int")
    rows = rows.select(
        F.get("f", F.lit(0)).try_cast("long").alias("offset"), F.get("f", F.lit(2)).alias("pos"), F.regexp_replace(F.lower(F.get("f", F.lit(4))), r"\(\w+\)$", "").alias("lemma"), "f",
        F.regexp_replace("gloss", r"; \".*$", "").alias("definition"), F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), pointer)).otherwise(F.array().cast("array<struct<symbol:string,offset:bigint,pos:string>>")).alias("pointers"),
    )
    return rows


def build(synsets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node_id, synset, definition, pos) and distinct edges (parent_id, child_id) from hypernyms and instance
    hypernyms. A synset is named by its first word, part of speech and the sense number among the synsets of that
    name, in order of offset; a hypernym of a part of speech that was not read gives no edge."""
    from pyspark.sql import Window

    kind = F.when(F.col("pos") == "s", "a").otherwise(F.col("pos"))
    node_id = F.col("offset") * 4 + F.array_position(F.array(*(F.lit(p) for p in FILES)), kind).cast("long") - 1
    sense = F.row_number().over(Window.partitionBy("lemma", "pos").orderBy("offset"))  # senses of one word are few
    rows = synsets.withColumn("node_id", node_id).withColumn("synset", F.format_string("%s.%s.%02d", "lemma", "pos", sense))
    nodes = rows.select("node_id", "synset", "definition", "pos")
    up = rows.select("node_id", F.explode("pointers").alias("p")).filter(F.col("p.symbol").isin("@", "@i"))
    parent = F.col("p.offset") * 4 + F.array_position(F.array(*(F.lit(p) for p in FILES)), F.when(F.col("p.pos") == "s", "a").otherwise(F.col("p.pos"))).cast("long") - 1
    edges = up.select(parent.alias("parent_id"), F.col("node_id").alias("child_id")).distinct()
    return nodes, edges.join(nodes.select(F.col("node_id").alias("parent_id")), "parent_id", "left_semi").orderBy("parent_id", "child_id")
