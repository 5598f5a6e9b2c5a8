"""Command line: each step reads tables and writes tables.

    python -m loomgraph parse-links --page P --linktarget L --redirect R --pagelinks K --out DIR
    python -m loomgraph parse-categories --page P --linktarget L --category C --categorylinks K --out DIR
    python -m loomgraph wordnet --folder DICT --out DIR [--pos n]
    python -m loomgraph rank --nodes N --edges E --out R [--key page_id --src src_id --dst dst_id] [--exclude FILE] [--exclude-defaults]
    python -m loomgraph prune --nodes N --edges E --ranks R --out DIR (--min-pagerank X | --drop-bottom-pct X)
    python -m loomgraph exclusions --nodes N --edges E --out FILE
    python -m loomgraph classify --nodes N --page-categories B --categories C --out DIR
    python -m loomgraph build --visual V --page-categories B --categories C --edges E --out DIR
    python -m loomgraph clean --graph DIR --out DIR [--remove FILE] [--keep FILE] [--mode acyclic|reference]
    python -m loomgraph validate --graph DIR [--quick]
    python -m loomgraph subgraph --categories C --edges E --page-categories B --root TITLE --out DIR [--short]
    python -m loomgraph tree --categories C --edges E --page-categories B --root TITLE --out DIR [--pages V]
    python -m loomgraph show --nodes N --edges E --title T [--depth 2] [--up]
    python -m loomgraph lookup-rank --nodes N --ranks R --title T
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed_values as fixed
from .operators import classify, degrees, knowledge_graph, lookup, pagerank, resolve, tree, validate
from .sources import dumps, tables, wordnet


def positioned(edges: DataFrame) -> DataFrame:
    """Edges with edge_pos: their own, or the order of ids, as rows of a table have no other."""
    return edges if "edge_pos" in edges.columns else edges.withColumn("edge_pos", F.col("parent_id"))


def root_of(categories: DataFrame, title: str):
    row = categories.filter(F.col("title") == title).select(F.min("category_id")).first()
    if row[0] is None:
        raise SystemExit(f"no category {title}")
    return row[0]


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_ids(categories: DataFrame) -> DataFrame:
    return categories.withColumn("id", F.col("category_id"))


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    out = getattr(a, "out", None)
    if a.command == "parse-links":
        page = dumps.pages(dumps.read_dump(spark, a.page, "page"))
        edges = resolve.resolve_links(dumps.page_links(dumps.read_dump(spark, a.pagelinks, "pagelinks")), dumps.link_targets(dumps.read_dump(spark, a.linktarget, "linktarget")), page, dumps.redirects(dumps.read_dump(spark, a.redirect, "redirect")))
        tables.write_table(page.filter("ns = 0"), f"{out}/nodes.parquet", "nodes")
        tables.write_table(edges, f"{out}/edges.parquet", "edges")
    elif a.command == "parse-categories":
        read_ = lambda path, name: dumps.read_dump(spark, path, name, decode_escapes=False)
        cats = dumps.categories(read_(a.category, "category"))
        edges, held = resolve.resolve_categories(dumps.category_links(read_(a.categorylinks, "categorylinks")), cats, dumps.pages(read_(a.page, "page")), dumps.link_targets(read_(a.linktarget, "linktarget")), a.max_pages)
        tables.write_categories(cats, f"{out}/wiki_categories.parquet")
        tables.write_table(edges, f"{out}/wiki_category_edges.parquet", "category_edges")
        tables.write_table(held, f"{out}/wiki_page_categories.parquet", "page_categories")
    elif a.command == "wordnet":
        nodes, edges = wordnet.build(wordnet.read_synsets(spark, a.folder, a.pos))
        tables.write_table(nodes, f"{out}/nodes.parquet", "wn_nodes")
        tables.write_table(edges, f"{out}/edges.parquet", "wn_edges")
    elif a.command == "rank":
        nodes = read(spark, a.nodes)
        if a.exclude:
            nodes = nodes.join(tables.read_titles(spark, a.exclude), "title", "left_anti")
        if a.exclude_defaults:
            nodes = nodes.filter(~F.coalesce(F.col("title").isin(*fixed.DEFAULT_EXCLUDED), F.lit(False)))
        tables.write_table(pagerank.pagerank(nodes, read(spark, a.edges), a.key, a.src, a.dst, max_iter=a.max_iter, normalize=a.normalize), out)
    elif a.command == "prune":
        limit = {"min_pagerank": a.min_pagerank, "drop_bottom_pct": a.drop_bottom_pct}
        nodes, edges = pagerank.prune(read(spark, a.nodes), read(spark, a.edges), read(spark, a.ranks), a.key, a.src, a.dst, **limit)
        tables.write_table(nodes, f"{out}/nodes.parquet")
        tables.write_table(edges, f"{out}/edges.parquet")
    elif a.command == "exclusions":
        d = degrees.degrees(tables.read_nodes(spark, a.nodes), read(spark, a.edges))
        found = degrees.exclusions(d, a.min_in_degree).join(d.groupBy("title").agg(F.max("in_degree").alias("in_degree")), "title")
        tables.write_titles(found, out, F.desc("in_degree"), "titles left out of the ranking")
    elif a.command == "classify":
        parts = classify.split_rules(classify.classify(tables.read_nodes(spark, a.nodes), read(spark, a.page_categories), read(spark, a.categories)))
        for name, df in parts.items():
            tables.write_table(df, f"{out}/{name}.parquet", "classified")
    elif a.command == "build":
        tables.write_graph(knowledge_graph.build(tables.read_nodes(spark, a.visual), read(spark, a.page_categories), read(spark, a.categories), read(spark, a.edges), a.max_depth, a.min_concepts, not a.direct_only), out)
    elif a.command == "clean":
        lists = [tables.read_patterns(spark, p) if p else None for p in (a.remove, a.keep)]
        graph, stats = knowledge_graph.clean(tables.read_graph(spark, a.graph), *lists, min_root_concepts=a.min_root_concepts, mode=a.mode)
        tables.write_graph(graph, out)
        print(*(f"{k}: {v}" for k, v in stats.items()), sep="\n")
    elif a.command == "validate":
        ledger = validate.validate(tables.read_graph(spark, a.graph), a.quick)
        print(validate.report(ledger))
        return 0 if validate.passed(ledger) else 1
    elif a.command == "subgraph":
        cats = with_ids(read(spark, a.categories))
        made = tree.semantic_subgraph(cats, read(spark, a.edges), read(spark, a.page_categories), root_of(cats, a.root), fixed.NOT_SEMANTIC_SHORT if a.short else fixed.NOT_SEMANTIC, a.min_pages)
        for name, file in (("categories", "semantic_categories"), ("edges", "semantic_category_edges"), ("page_categories", "semantic_page_categories")):
            tables.write_table(made[name].drop("id"), f"{out}/{file}.parquet")
    elif a.command == "tree":
        cats = with_ids(read(spark, a.categories))
        root = root_of(cats, a.root)
        made = tree.build_tree(cats, positioned(read(spark, a.edges)), read(spark, a.page_categories), root, a.parents)
        for name in ("categories", "edges", "page_categories"):
            tables.write_table(made[name].drop("id"), f"{out}/tree_{name}.parquet")
        if a.pages:
            held = made["page_categories"].withColumn("pos", F.col("category_id"))
            nodes, edges = tree.attach_pages(made["categories"].drop("depth"), positioned(made["edges"]), tables.read_nodes(spark, a.pages), held, root)
            tables.write_table(nodes, f"{out}/nodes.parquet", "tree_nodes")
            tables.write_table(edges, f"{out}/edges.parquet", "tree_edges")
    elif a.command == "show":
        nodes, edges = read(spark, a.nodes), read(spark, a.edges)
        key = nodes.columns[0]
        found = lookup.by_title(nodes, a.title, a.limit) if "title" in nodes.columns else lookup.by_synset(nodes, a.title)
        hits = found.collect()
        for hit in hits:
            walk = lookup.printed_tree(edges, hit[key], a.depth, a.up)
            label = "title" if "title" in nodes.columns else "synset"
            names = {r[key]: r[label] for r in nodes.join(spark.createDataFrame([(n,) for _, n in walk], f"`{key}` {nodes.schema[key].dataType.simpleString()}"), key, "left_semi").collect()}
            print(*("  " * level + str(names.get(n, n)) for level, n in walk), sep="\n")
        if not hits and "title" in nodes.columns:
            print("not found; did you mean:", *(r.title for r in lookup.suggestions(nodes, a.title).collect()))
            return 1
    elif a.command == "lookup-rank":
        lookup_ = pagerank.lookup(tables.read_nodes(spark, a.nodes), read(spark, a.ranks), a.title).collect()
        print(*(f"{r.title}: rank {r.rank_position}, percentile {r.percentile:.4f}, {r.status}" for r in lookup_) if lookup_ else ("not found",), sep="\n")
        return 0 if lookup_ else 1
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomgraph", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)

    def command(name: str, *required: str, **more) -> None:
        c = commands.add_parser(name)
        for r in required:
            c.add_argument(f"--{r}", required=True)
        for k, v in more.items():
            flag = f"--{k.replace('_', '-')}"
            if v is False:
                c.add_argument(flag, action="store_true")
            else:
                kind, default = v if isinstance(v, tuple) else (type(v), v)
                c.add_argument(flag, type=kind, default=default)

    ends = {"key": "page_id", "src": "src_id", "dst": "dst_id"}
    command("parse-links", "page", "linktarget", "redirect", "pagelinks", "out")
    command("parse-categories", "page", "linktarget", "category", "categorylinks", "out", max_pages=(int, None))
    command("wordnet", "folder", "out", pos=(str, None))
    command("rank", "nodes", "edges", "out", **ends, max_iter=30, exclude=(str, None), exclude_defaults=False, normalize=False)
    command("prune", "nodes", "edges", "ranks", "out", **ends, min_pagerank=(float, None), drop_bottom_pct=(float, None))
    command("exclusions", "nodes", "edges", "out", min_in_degree=1000)
    command("classify", "nodes", "page-categories", "categories", "out")
    command("build", "visual", "page-categories", "categories", "edges", "out", max_depth=5, min_concepts=1, direct_only=False)
    command("clean", "graph", "out", remove=(str, None), keep=(str, None), min_root_concepts=5, mode="acyclic")
    command("validate", "graph", quick=False)
    command("subgraph", "categories", "edges", "page-categories", "out", root=fixed.ROOT_TITLE, short=False, min_pages=10)
    command("tree", "categories", "edges", "page-categories", "out", root=fixed.ROOT_TITLE, parents=2, pages=(str, None))
    command("show", "nodes", "edges", "title", depth=2, limit=5, up=False)
    command("lookup-rank", "nodes", "ranks", "title")
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    spark = SparkSession.builder.appName(f"loomgraph {a.command}").getOrCreate()
    return run(spark, a)


if __name__ == "__main__":
    sys.exit(main())
