"""Dump tuples, link resolution, WordNet files, tables on disk."""

import gzip

from pyspark.sql import functions as F

from loomgraph.operators import resolve
from loomgraph.sources import dumps, tables, wordnet


def test_tuples():
    line = r"(1,0,'A\nB'),(2,0,'it\'s'),(3,0,'a''b'),(4,0,'x,(y)'),(5,0,'NULL'),(6,0,NULL),( 7 , -1 ,'p q')"
    assert dumps.tuples(line) == [["1", "0", "A\nB"], ["2", "0", "it's"], ["3", "0", "ab"], ["4", "0", "x,(y)"], ["5", "0", "NULL"], ["6", "0", "NULL"], ["7", "-1", "p q"]]
    assert dumps.tuples(r"(1,'A\nB')", decode_escapes=False) == [["1", "AnB"]]
    assert dumps.tuples("(1,(2,3),x") == [["2", "3"]]
    assert dumps.tuples("") == [] and dumps.tuples("(1,'open") == []


def test_dump_file(spark, tmp_path):
    with gzip.open(tmp_path / "page.sql.gz", "wt") as f:
        f.write("-- a comment\nINSERT INTO `page` VALUES (1,0,'A'),(2,x,'B'),(3);\nINSERT INTO `other` VALUES (9,0,'Z');\n")
    rows = dumps.pages(dumps.read_dump(spark, str(tmp_path / "page.sql.gz"), "page")).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, "A"), (2, None, "B"), (3, None, None)]


def test_resolve_links(spark):
    page = spark.createDataFrame([(1, 0, "A"), (2, 0, "B"), (3, 0, "C"), (4, 0, "D"), (9, 14, "K")], "page_id long, ns int, title string")
    lt = spark.createDataFrame([(10, 0, "A"), (11, 0, "B"), (12, 0, "C"), (13, 0, "D"), (14, 0, "Missing"), (15, 14, "K")], "lt_id long, ns int, title string")
    rd = spark.createDataFrame([(3, 0, "B"), (4, 0, "C"), (1, 0, "Missing")], "rd_from long, ns int, title string")
    pl = spark.createDataFrame([(1, 0, 11), (1, 0, 11), (1, 0, 12), (1, 0, 13), (2, 0, 11), (3, 0, 11), (2, 0, 14), (2, 0, 15), (2, 1, 10), (99, 0, 10)], "pl_from long, pl_from_ns int, pl_target long")
    got = sorted(map(tuple, resolve.resolve_links(pl, lt, page, rd).collect()))
    assert got == [(1, 2), (1, 2), (1, 2), (1, 3), (2, 2), (3, 2)]
    assert (1, 2) in set(map(tuple, resolve.resolve_links(pl.filter("pl_target = 13"), lt, page, rd, max_hops=2).collect()))


def test_resolve_categories(spark):
    cat = spark.createDataFrame([(100, "Animals", 5), (101, "Cats", 2), (102, "Empty", None)], "category_id long, title string, page_count long")
    page = spark.createDataFrame([(1, 0, "Tom"), (50, 14, "Cats"), (51, 14, "Ghost")], "page_id long, ns int, title string")
    lt = spark.createDataFrame([(10, 14, "Animals"), (11, 14, "Cats"), (12, 0, "Animals")], "lt_id long, ns int, title string")
    cl = spark.createDataFrame([(50, "subcat", 10), (1, "page", 11), (51, "subcat", 10), (1, "page", 12), (1, "file", 10), (7, "page", 11)], "cl_from long, cl_type string, cl_target long")
    edges, held = resolve.resolve_categories(cl, cat, page, lt)
    assert list(map(tuple, edges.collect())) == [(100, 101)] and list(map(tuple, held.collect())) == [(1, 101)]


def test_tables(spark, tmp_path):
    at = str(tmp_path / "c.parquet")
    tables.write_categories(spark.createDataFrame([(1, "A", None)], "category_id long, title string, page_count long"), at)
    assert tuple(spark.read.parquet(at).first()) == (1, "A", 0)
    (tmp_path / "t.txt").write_text("# one\n\n  ISBN \nA b\n")
    assert {r.title for r in tables.read_titles(spark, str(tmp_path / "t.txt")).collect()} == {"# one", "ISBN", "A b"}
    assert tables.read_patterns(spark, str(tmp_path / "t.txt")) == ["ISBN", "A b"]
    titles = spark.createDataFrame([("b", 1), ("a", 2)], "title string, in_degree int")
    tables.write_titles(titles, str(tmp_path / "x"), F.desc("in_degree"), "list")
    assert [r.value for r in spark.read.text(str(tmp_path / "x")).collect()] == ["# list", "a", "b"]
    spark.createDataFrame([(5, "N")], "id long, name string").write.parquet(str(tmp_path / "n.parquet"))
    assert tuple(tables.read_nodes(spark, str(tmp_path / "n.parquet")).first()) == (5, "N")


def test_wordnet(spark, tmp_path):
    (tmp_path / "data.noun").write_text(
        "  1 licence text\n00001740 03 n 01 entity 0 001 ~ 00001930 n 0000 | that which exists; \"an example\"\n00001930 03 n 02 physical_entity 0 thing 0 001 @ 00001740 n 0000 | an entity that has physical existence\n00002000 03 n 01 Paris 0 001 @i 00001930 n 0000 | a city\n"
    )
    nodes, edges = wordnet.build(wordnet.read_synsets(spark, str(tmp_path), "n"))
    rows = {r.synset: r for r in nodes.collect()}
    assert set(rows) == {"entity.n.01", "physical_entity.n.01", "paris.n.01"} and rows["entity.n.01"].definition == "that which exists"
    assert {(r.parent_id, r.child_id) for r in edges.collect()} == {(rows["entity.n.01"].node_id, rows["physical_entity.n.01"].node_id), (rows["physical_entity.n.01"].node_id, rows["paris.n.01"].node_id)}


def test_first_lines(spark, tmp_path):
    (tmp_path / "dump").write_text("".join(f"line {i}\n" for i in range(50)))
    assert [r.value for r in dumps.head(spark, str(tmp_path / "dump"), 3).collect()] == ["line 0", "line 1", "line 2"]


def test_tables_round_trip(spark, tmp_path):
    """Schemas are kept by empty tables too, columns are cast and ordered, missing ones are an error."""
    import pytest

    df = spark.createDataFrame([("t", 3, "x")], "title string, page_id int, more string")
    tables.write_table(df, str(tmp_path / "nodes"), "nodes")
    back = spark.read.parquet(str(tmp_path / "nodes"))
    assert [(f.name, f.dataType.simpleString()) for f in back.schema] == [("page_id", "bigint"), ("title", "string")] and back.first().page_id == 3
    tables.write_table(df.limit(0), str(tmp_path / "none"), "nodes")
    assert spark.read.parquet(str(tmp_path / "none")).isEmpty()
    with pytest.raises(ValueError):
        tables.write_table(df, str(tmp_path / "edges"), "edges")
    assert tables.read_columns(spark, str(tmp_path / "nodes"), ["title"]).columns == ["title"]
    df.select(F.col("page_id").alias("id"), F.col("title").alias("name")).write.parquet(str(tmp_path / "other"))
    assert tables.read_nodes(spark, str(tmp_path / "other")).first() == (3, "t")


def test_scratch_tables(spark):
    """Buckets spare the shuffle of the side that has them; a broadcast depends on size; settings do not stay."""
    from loomgraph import runtime

    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    held = runtime.bucketed(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v")), "k")
    joined = held.hint("merge").join(spark.range(50).select(F.col("id").alias("k")).hint("merge"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50 and plan.count("Exchange hashpartitioning") == 1
    small = runtime.staged(spark.range(10))
    assert "BROADCAST" in str(runtime.bounded(small)._jdf.logicalPlan()).upper() and "MERGE" in str(runtime.bounded(small, limit=0)._jdf.logicalPlan()).upper()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
