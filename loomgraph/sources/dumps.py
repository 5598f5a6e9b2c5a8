"""Tables from SQL dumps: one INSERT statement a line, many tuples in it.

Lines are read by Spark (gzip included) and filtered by their beginning in the JVM; only INSERT lines go to Python,
in Arrow batches, where one regular expression steps through strings, brackets and commas. A gzip file is one
partition, so its lines are dealt out before they are parsed.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.titles import to_int, to_str

# Outside strings white space is dropped. A string may run to the end of the line.
TOKEN = re.compile(r"'((?:[^'\\]|\\.)*+)(?:'|\\?\Z)|([(),])|([^'(),\s]+)|\s+", re.S)
ESCAPE = re.compile(r"\\(.)", re.S)
CODES = {"n": "\n", "r": "\r", "t": "\t", "0": "\0"}


def tuples(values: str, decode_escapes: bool = True) -> list[list[str]]:
    """The tuples of the text after VALUES. Quotes are lost, so a doubled quote joins its halves; an opening bracket
    outside a string starts a tuple anew."""
    out: list[list[str]] = []
    fields: list[str] | None = None
    field: list[str] = []
    for m in TOKEN.finditer(values):
        text, mark, plain = m.groups()
        if text is not None:
            if "\\" in text:
                text = ESCAPE.sub((lambda e: CODES.get(e[1], e[1])) if decode_escapes else r"\1", text)
            field.append(text)
        elif mark == "(":
            fields, field = [], []
        elif fields is not None:
            if plain is not None:
                field.append(plain)
            elif mark:
                fields.append("".join(field))
                field = []
                if mark == ")":
                    out.append(fields)
                    fields = None
    return out


def read_tuples(lines: DataFrame, table: str, decode_escapes: bool = True, partitions: int | None = None) -> DataFrame:
    """(fields array<string>) for each tuple of the INSERT lines for table; lines has the column value."""
    begin = f"INSERT INTO `{table}` VALUES"
    wanted = lines.filter(F.col("value").startswith(begin)).select(F.substring("value", len(begin) + 1, 2**31 - 1).alias("values"))
    if partitions:
        wanted = wanted.repartition(partitions)

    def run(batches):
        for batch in batches:
            for values in batch.column(0).to_pylist():
                values = values.strip()
                found = tuples(values[:-1] if values.endswith(";") else values, decode_escapes)
                if found:
                    yield pa.record_batch([pa.array(found, pa.list_(pa.string()))], ["fields"])

    return wanted.mapInArrow(run, "fields array<string>")


def read_dump(spark: SparkSession, path: str, table: str, decode_escapes: bool = True) -> DataFrame:
    """Tuples of a dump file, gzip or plain; the lines of a file that cannot be split are dealt out."""
    n = spark.sparkContext.defaultParallelism
    return read_tuples(spark.read.text(path), table, decode_escapes, n if path.endswith(".gz") else None)


def field(i: int):
    return F.get("fields", F.lit(i))


# What the pipelines use of each table, by position; rows too short or without a number where one is needed go.

def pages(rows: DataFrame) -> DataFrame:
    return rows.select(to_int(field(0)).alias("page_id"), to_int(field(1)).alias("ns"), to_str(field(2)).alias("title"))


def link_targets(rows: DataFrame) -> DataFrame:
    return rows.select(to_int(field(0)).alias("lt_id"), to_int(field(1)).alias("ns"), to_str(field(2)).alias("title"))


def redirects(rows: DataFrame) -> DataFrame:
    return rows.select(to_int(field(0)).alias("rd_from"), to_int(field(1)).alias("ns"), to_str(field(2)).alias("title"))


def page_links(rows: DataFrame) -> DataFrame:
    return rows.select(to_int(field(0)).alias("pl_from"), to_int(field(1)).alias("pl_from_ns"), to_int(field(2)).alias("pl_target")).dropna()


def categories(rows: DataFrame) -> DataFrame:
    return rows.select(to_int(field(0)).alias("category_id"), to_str(field(1)).alias("title"), to_int(field(2)).alias("page_count")).dropna(subset=["category_id", "title"])


def category_links(rows: DataFrame) -> DataFrame:
    return rows.select(to_int(field(0)).alias("cl_from"), to_str(field(4)).alias("cl_type"), to_int(field(6)).alias("cl_target")).dropna()


def head(spark: SparkSession, path: str, n: int = 100_000) -> DataFrame:
    """The first n lines of a dump, for trials."""
    return spark.read.text(path).limit(n)
