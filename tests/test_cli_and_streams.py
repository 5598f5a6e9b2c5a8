"""Commands end to end on a small world, and streams that are run to their end."""

from pyspark.sql import functions as F

from loomgraph.__main__ import parser, run
from loomgraph.sources import tables
from loomgraph.streaming.degrees import degree_stream, windowed_counts

PAGES = "INSERT INTO `page` VALUES (1,0,'Tom'),(2,0,'Rex'),(3,0,'Old_Tom'),(50,14,'Cats'),(51,14,'Animals'),(52,14,'Dogs'),(53,14,'Main_topic_classifications');\n"
TARGETS = "INSERT INTO `linktarget` VALUES (10,0,'Tom'),(11,0,'Rex'),(12,0,'Old_Tom'),(20,14,'Cats'),(21,14,'Animals'),(22,14,'Dogs'),(23,14,'Main_topic_classifications');\n"
CATEGORIES = "INSERT INTO `category` VALUES (100,'Cats',1),(101,'Animals',0),(102,'Dogs',NULL),(103,'Main_topic_classifications',0);\n"
LINKS = "INSERT INTO `categorylinks` VALUES " + ",".join(f"({a},0,0,0,'{k}',0,{t})" for a, k, t in ((50, "subcat", 21), (52, "subcat", 21), (51, "subcat", 23), (1, "page", 20), (2, "page", 22), (3, "page", 20))) + ";\n"


def test_commands(spark, tmp_path, capsys):
    def call(*args):
        return run(spark, parser().parse_args([str(a) for a in args]))

    files = {"page": PAGES, "linktarget": TARGETS, "category": CATEGORIES, "categorylinks": LINKS, "redirect": "INSERT INTO `redirect` VALUES (3,0,'Tom');\n", "pagelinks": "INSERT INTO `pagelinks` VALUES (1,0,11),(2,0,12),(2,0,10),(1,1,11);\n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    at = lambda *names: [x for n in names for x in (f"--{n}", tmp_path / n)]
    assert call("parse-links", *at("page", "linktarget", "redirect", "pagelinks"), "--out", tmp_path / "links") == 0
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/links/edges.parquet").collect())) == [(1, 2), (2, 1), (2, 1)]
    assert call("parse-categories", *at("page", "linktarget", "category", "categorylinks"), "--out", tmp_path / "cats") == 0
    nodes, edges = f"{tmp_path}/links/nodes.parquet", f"{tmp_path}/links/edges.parquet"
    cats, cat_edges, held = (f"{tmp_path}/cats/wiki_{n}.parquet" for n in ("categories", "category_edges", "page_categories"))
    assert call("rank", "--nodes", nodes, "--edges", edges, "--out", tmp_path / "ranks") == 0
    assert call("prune", "--nodes", nodes, "--edges", edges, "--ranks", tmp_path / "ranks", "--drop-bottom-pct", 20, "--out", tmp_path / "pruned") == 0
    assert spark.read.parquet(f"{tmp_path}/pruned/nodes.parquet").count() == 2
    assert call("lookup-rank", "--nodes", nodes, "--ranks", tmp_path / "ranks", "--title", "Tom") == 0
    assert call("exclusions", "--nodes", nodes, "--edges", edges, "--out", tmp_path / "excluded", "--min-in-degree", 2) == 0
    assert call("classify", "--nodes", nodes, "--page-categories", held, "--categories", cats, "--out", tmp_path / "classes") == 0
    assert spark.read.parquet(f"{tmp_path}/classes/visual.parquet").count() == 3
    assert call("build", "--visual", nodes, "--page-categories", held, "--categories", cats, "--edges", cat_edges, "--out", tmp_path / "kg") == 0
    assert call("validate", "--graph", tmp_path / "kg") == 0
    assert call("clean", "--graph", tmp_path / "kg", "--out", tmp_path / "clean", "--min-root-concepts", 1) == 0
    assert call("validate", "--graph", tmp_path / "clean", "--quick") == 0
    assert set(tables.read_graph(spark, f"{tmp_path}/clean")) == {"nodes", "edges", "title_index", "ancestors", "metadata"}
    assert call("subgraph", "--categories", cats, "--edges", cat_edges, "--page-categories", held, "--min-pages", 1, "--out", tmp_path / "sem") == 0
    sem = [f"{tmp_path}/sem/semantic_{n}.parquet" for n in ("categories", "category_edges", "page_categories")]
    assert call("tree", "--categories", sem[0], "--edges", sem[1], "--page-categories", sem[2], "--pages", nodes, "--out", tmp_path / "tree") == 0
    got = {r.title: (r.parent_id, r.depth) for r in spark.read.parquet(f"{tmp_path}/tree/nodes.parquet").collect()}
    assert got["Tom"] == ("cat_100", 3) and got["Animals"] == ("cat_103", 1)
    capsys.readouterr()
    assert call("show", "--nodes", cats, "--edges", cat_edges, "--title", "animals", "--depth", 1) == 0
    assert capsys.readouterr().out.splitlines() == ["Animals", "  Cats", "  Dogs"]
    assert call("show", "--nodes", cats, "--edges", cat_edges, "--title", "anim") == 1


def drained(stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()


def test_degree_stream(spark, tmp_path):
    for k, rows in enumerate(([(1, 2), (1, 2)], [(2, 1), (3, 3)])):
        spark.createDataFrame(rows, "src_id long, dst_id long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/edges")
    drained(degree_stream(spark.readStream.schema("src_id long, dst_id long").parquet(f"{tmp_path}/edges")), "degrees", "complete")
    assert sorted(map(tuple, spark.table("degrees").collect())) == [(1, 1, 2), (2, 2, 1), (3, 1, 1)]


def test_windows(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "event_type", "value")
    events.coalesce(1).write.parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/events")
    drained(windowed_counts(stream), "windows", "complete")
    assert spark.table("windows").agg(F.sum("n")).first()[0] == events.count()
