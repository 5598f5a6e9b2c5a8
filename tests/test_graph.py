"""Ranks, hierarchies, cycles, trims, trees and lookups on small hand-made graphs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import closure as up
from loomgraph.operators import degrees as deg
from loomgraph.operators import knowledge_graph as kg
from loomgraph.operators import lookup, tree, trim, validate
from loomgraph.operators import pagerank as pr


def edges_of(spark, pairs, a="parent_id", b="child_id"):
    return spark.createDataFrame(pairs, f"{a} long, {b} long")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_pagerank(spark):
    nodes = spark.createDataFrame([(i, f"n{i}") for i in range(1, 5)], "page_id long, title string")
    links = edges_of(spark, [(1, 2), (1, 2), (1, 3), (2, 3), (2, 4), (3, 3), (3, 1)], "src_id", "dst_id")
    for rounds, want in ((1, [0.196875, 0.23229167, 0.37395833, 0.196875]), (2, [0.23826823, 0.19089844, 0.39277344, 0.17805990]), (30, [0.23912351, 0.20684373, 0.39478376, 0.15924900])):
        r = pr.pagerank(nodes, links, max_iter=rounds, tol=None)
        assert [x.pagerank for x in r.orderBy("page_id").collect()] == pytest.approx(want, abs=2e-8)
    assert ids(pr.keep_set(r, drop_bottom_pct=20).select("page_id")) == [1, 2, 3]
    assert ids(pr.keep_set(r, drop_bottom_pct=75).select("page_id")) == [3]
    at = {x.page_id: x for x in pr.ranked(r, nodes).collect()}
    assert at[2].rank_position == 3 and at[2].percentile == pytest.approx(50.0)
    one = pr.lookup(nodes, r, "n2").first()
    assert one.rank_position == 3 and one.percentile == pytest.approx(50.0)
    assert pr.lookup(nodes, r, "nowhere").isEmpty()
    with pytest.raises(ValueError):
        pr.threshold(r)
    early = pr.pagerank(nodes, links, max_iter=200, tol=1e-6, normalize=True)
    assert early.agg(F.sum("pagerank")).first()[0] == pytest.approx(1)
    assert pr.pagerank(nodes.limit(0), links).isEmpty()


def test_detectors(spark):
    rows = [("Wayback_Machine", 9000, 10), ("United_States", 90000, 5000), ("Foo_(identifier)", 1000, 50), ("H:S", 1000, 0), ("Some_database", 5000, 199), ("Dangling", 500, 0), (None, 9000, 0)]
    nodes = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, title string, in_degree long, out_degree long").withColumn("in_out_ratio", F.col("in_degree") / (F.col("out_degree") + 1))
    names = lambda df: {r.title for r in df.collect()}
    assert names(deg.by_ratio(nodes)) == {"Wayback_Machine"}
    assert names(deg.by_title(nodes)) == {"Foo_(identifier)", "H:S", "Some_database"}
    assert names(deg.by_citation(nodes)) == {"Wayback_Machine", "Foo_(identifier)"}
    assert names(deg.by_dangling(nodes)) == {"H:S", "Dangling"}
    assert names(deg.exclusions(nodes)) == {"Wayback_Machine", "Foo_(identifier)", "H:S", "Some_database", "Dangling"}


def test_diamond(spark):
    cats = spark.createDataFrame([(1000, "R"), (1001, "A"), (1002, "B"), (1003, "C")], "category_id long, title string")
    e = edges_of(spark, [(1000, 1001), (1000, 1002), (1001, 1003), (1002, 1003)])
    held = spark.createDataFrame([(1, 1003), (2, 1001)], "page_id long, category_id long")
    visual = spark.createDataFrame([(1, "p1"), (2, "p2")], "page_id long, title string")
    g = kg.build(visual, held, cats, e)
    n = {r.title: r for r in g["nodes"].collect()}
    assert [(n[t].depth, n[t].direct_concept_count, n[t].total_concept_count) for t in "RABC"] == [(0, 0, 3), (1, 1, 2), (1, 0, 1), (2, 1, 1)]
    assert n["R"].specificity_score == pytest.approx(0.721348, abs=1e-6) and n["p1"].depth == 3 and n["p2"].depth == 2
    lists = {r.node_id: r.ancestors for r in g["ancestors"].collect()}
    assert lists == {1: [1000, 1001, 1002, 1003], 2: [1000, 1001]}
    # Total counts by paths are what the checks of the formula take as they are.
    assert validate.passed(validate.validate(g))
    done, stats = kg.clean(g, min_root_concepts=1)
    c = {r.title: r for r in done["nodes"].collect()}
    assert c["R"].total_concept_count == 2 and c["p1"].direct_concept_count == 0 and stats["removed_weak_roots"] == 0
    assert validate.passed(validate.validate(done)) and "PASSED" in validate.report(validate.validate(done, quick=True))
    moved = kg.build(visual.withColumn("page_id", F.when(F.col("page_id") == 2, 1003).otherwise(1)), held.withColumn("page_id", F.when(F.col("page_id") == 2, 1003).otherwise(1)), cats, e)
    assert sorted(r.node_id for r in moved["nodes"].filter("node_type = 'category'").collect()) == [2004, 2005, 2006, 2007]
    broken = {**g, "edges": g["edges"].union(spark.createDataFrame([(1000, 1000, "child_of")], "a long, b long, c string"))}
    assert not validate.passed(validate.validate(broken))


def test_cycles(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 3), (5, 5), (4, 1)], "child_id long, parent_id long")
    parts = {(r.id, r.component) for r in trim.strong_components(e).collect()}
    assert parts == {(1, 1), (2, 1), (3, 1)}
    depths = up.category_depths(spark.createDataFrame([(i,) for i in range(1, 6)], "id long"), e)
    cut = trim.cycle_edges(e, depths)
    left = e.join(cut, ["child_id", "parent_id"], "left_anti")
    assert ids(up.ordered(spark.createDataFrame([(i,) for i in range(1, 6)], "id long"), left)) == [1, 2, 3, 4, 5]
    assert trim.cycle_edges(e, depths, "reference").count() == 1
    rng = random.Random(5)
    pairs = [(rng.randrange(14), rng.randrange(14)) for _ in range(26)]
    got = {r.id: r.component for r in trim.strong_components(spark.createDataFrame(pairs, "child_id long, parent_id long")).collect()}
    reach = {a: {a} for a in range(14)}
    for _ in range(14):
        for a, b in pairs:
            for s in reach.values():
                if a in s:
                    s.add(b)
    want = {a: min(b for b in range(14) if b in reach[a] and a in reach[b]) for a in range(14) if any(b != a and b in reach[a] and a in reach[b] for b in range(14))}
    assert got == want


def test_trim(spark):
    cats = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "id long")
    pages = spark.createDataFrame([(p, c) for c, n in ((3, 7), (4, 2)) for p in range(n)], "page_id long, category_id long")
    assert ids(trim.trim_leaves(cats, edges_of(spark, [(1, 2), (1, 3), (2, 4)]), pages, 1, 5)) == [1, 3]


def tree_of(spark, extra=()):
    names = ["Main_topic_classifications", "Culture", "Animals", "History_of_pets", "Dogs"]
    cats = spark.createDataFrame([(i + 1, i + 1, t) for i, t in enumerate(names)], "id long, category_id long, title string")
    e = [(1, 2), (1, 3), (1, 4), (4, 5), (2, 5), (3, 5), *extra]
    return cats, spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(e)], "parent_id long, child_id long, edge_pos long")


def parents(df):
    return sorted((r.parent, r.id) for r in df.filter("parent is not null").collect())


def test_best_parents(spark):
    cats, e = tree_of(spark)
    assert parents(tree.best_paths(cats, e, 1, 1)) == [(1, 2), (1, 3), (1, 4), (3, 5)]
    two = tree.best_paths(cats, e, 1, 2)
    assert parents(two) == [(1, 2), (1, 3), (1, 4), (2, 5), (3, 5)]
    s = two.filter("id = 5 and parent = 3").first().score
    assert tuple(s) == (0, 0, -1, 1, 3)
    cats, e = tree_of(spark, [(2, 3)])
    assert (2, 3) in parents(tree.best_paths(cats, e, 1, 1))
    cats, e = tree_of(spark, [(3, 2)])
    assert (1, 2) in parents(tree.best_paths(cats, e, 1, 1))


def test_attach(spark):
    cats, e = tree_of(spark)
    pages = spark.createDataFrame([(1, "Big_dog"), (2, "Dogs"), (3, "Culture"), (4, "Poem")], "page_id long, title string")
    held = spark.createDataFrame([(1, 2, 0), (1, 5, 1), (2, 5, 2), (3, 5, 3), (4, 4, 4), (4, 2, 5)], "page_id long, category_id long, pos long")
    nodes, links = tree.attach_pages(cats, e, pages, held, 1)
    got = {r.title: r.parent_id for r in nodes.filter("node_type = 'page'").collect()}
    assert got == {"Big_dog": "cat_5", "Dogs": "cat_5", "Poem": "cat_2"}
    assert "cat_4" not in {r.node_id for r in nodes.collect()}
    assert links.filter("child_id = 'page_4'").first().parent_id == "cat_2"


def test_lookup(spark):
    e = spark.createDataFrame([("a", "b", 0), ("a", "c", 1), ("b", "c", 2), ("c", "d", 3)], "parent_id string, child_id string, edge_pos long")
    assert [n for _, n in lookup.printed_tree(e, "a", 2)] == ["a", "b", "c"]
    assert ids(lookup.neighbourhood(e, "a", 2)) == ["a", "b", "c", "d"]
    diamond = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")], "parent_id string, child_id string")
    start = spark.createDataFrame([("d",)], "id string")
    assert sorted(r.path for r in lookup.paths_up(diamond, start, 20, "a").collect()) == [["d", "b", "a"], ["d", "c", "a"]]
    assert lookup.paths_up(diamond, start, 2, "a").isEmpty()
    assert lookup.one_per_root(lookup.paths_up(diamond, start, 10)).count() == 1
    nodes = spark.createDataFrame([("1", "Red Dog", "category"), ("2", "red-dog", "page"), ("3", "Big_red_dog", "page")], "node_id string, title string, node_type string")
    assert [r.node_id for r in lookup.search(nodes, "red dog").collect()] == ["1", "2", "3"]
    assert [r.node_id for r in lookup.search(nodes, "red dog", "page", 1).collect()] == ["2"]
    assert lookup.search(nodes, "red dog", "page", 1, filter_first=False).isEmpty()


def test_paths_by_pointer(spark):
    p = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (8, 9), (9, 8)], "id long, parent_id long")
    got = {r.id: r.path for r in up.pointers_to_root(p).collect()}
    assert got[4] == [4, 3, 2, 1] and got[1] == [1] and got[8] == [8, 9]


def test_each_check_finds_its_damage(spark):
    """A graph that is right, then one fault for each check."""
    cats = spark.createDataFrame([(10, "R"), (11, "A"), (12, "B"), (13, "C")], "category_id long, title string")
    e = edges_of(spark, [(10, 11), (10, 12), (11, 13)])
    held = spark.createDataFrame([(1, 13), (2, 11), (3, 12)], "page_id long, category_id long")
    visual = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3")], "page_id long, title string")
    g = {k: v.cache() for k, v in kg.build(visual, held, cats, e).items()}
    ok = validate.validate(g).collect()
    assert {r.level for r in ok} == {"ok"} and {r.check for r in ok} == {f"V{i}" for i in range(1, 10)}
    n, l = g["nodes"], g["edges"]  # noqa: E741
    kind, node = l.columns, {r.title: r.node_id for r in n.collect()}
    add = lambda a, b, t: {"edges": l.union(spark.createDataFrame([(a, b, t)], l.schema))}
    put = lambda title, **c: {"nodes": n.withColumns({k: F.when(F.col("title") == title, F.lit(v).cast(n.schema[k].dataType)).otherwise(F.col(k)) for k, v in c.items()})}
    faults = {
        ("V1", "number of nodes as in metadata"): {"nodes": n.filter("title <> 'p3'")},
        ("V1", "number of edges as in metadata"): {"edges": l.limit(5)},
        ("V1", "node ids occur once"): {"nodes": n.union(n.limit(1))},
        ("V1", "edges end at nodes"): add(node["p1"], 999, "belongs_to"),
        ("V1", "title index has every titled node"): {"title_index": g["title_index"].filter("title <> 'R'")},
        ("V1", "every concept has an ancestor list"): {"ancestors": g["ancestors"].filter(F.col("node_id") != node["p1"])},
        ("V1", "ancestor lists are of concepts"): {"ancestors": g["ancestors"].union(spark.createDataFrame([(node["R"], [])], g["ancestors"].schema))},
        ("V2", "belongs_to leads from a concept to a category"): add(node["p1"], node["p2"], "belongs_to"),
        ("V2", "child_of leads from a category to a category"): add(node["p1"], node["R"], "child_of"),
        ("V2", "no edge is a loop"): add(node["B"], node["B"], "child_of"),
        ("V3", "categories of depth 0 have no parent"): put("B", depth=0),
        ("V3", "a parent is less deep than its child"): put("A", depth=5),
        ("V3", "a concept is one deeper than its least deep category"): put("p1", depth=1),
        ("V3", "normalized depth is depth over the largest"): put("C", normalized_depth=0.123),
        ("V4", "the hierarchy has no cycle"): add(node["R"], node["C"], "child_of"),
        ("V5", "specificity is 1 / log1p(total)"): put("A", specificity_score=1.0),
        ("V5", "specificity is over 0 and no more than 1 / log(2)"): put("A", specificity_score=-1.0),
        ("V5", "specificity falls as the count grows"): {"nodes": n.withColumn("specificity_score", F.when(F.col("node_type") == "category", F.log1p("total_concept_count")).otherwise(F.lit(1.0)))},
        ("V6", "ancestors are all that is above"): {"ancestors": g["ancestors"].withColumn("ancestors", F.slice("ancestors", 1, 1))},
        ("V6", "ancestors go from the root down"): {"ancestors": g["ancestors"].withColumn("ancestors", F.reverse("ancestors"))},
        ("V7", "every concept belongs to a category"): {"edges": l.filter(F.col("src_id") != node["p3"])},
        ("V7", "direct counts are the edges"): put("B", direct_concept_count=7),
        ("V8", "title_lower is the title in lower case"): {"title_index": g["title_index"].withColumn("title_lower", F.col("title"))},
        ("V8", "titles are those of the nodes"): {"title_index": g["title_index"].withColumn("title", F.when(F.col("title") == "A", "Z").otherwise(F.col("title")))},
        ("V8", "titles occur once"): {"title_index": g["title_index"].union(g["title_index"].limit(1))},
        ("V9", "depths are distributed as in metadata"): put("p1", depth=9),
    }
    assert kind == ["src_id", "dst_id", "edge_type"] and set(faults) == {(r.check, r.message) for r in ok}
    of = dict(V1=validate.structure, V2=validate.edge_types, V3=validate.depths, V4=validate.cycles, V5=validate.scores, V6=validate.ancestors, V7=validate.coverage, V8=validate.index, V9=validate.statistics)
    for (check, message), parts in faults.items():
        row = next(x for x in of[check]({**g, **parts}) if x.filter(F.col("message") == message).count())
        assert row.first().level != "ok", (check, message)


def test_classifier_goes_on(spark, tmp_path):
    """Back-off, checkpoints and a limit: a run that broke off asks only about what is open."""
    from loomgraph.operators import classify

    nodes = spark.createDataFrame([(i, f"t_{i}") for i in range(40)], "page_id long, title string")
    asked = tmp_path / "asked"
    asked.mkdir()

    def answer(titles, fail=False):
        import json
        import uuid

        (asked / uuid.uuid4().hex).write_text("\n".join(titles))
        return None if fail else json.dumps([{"title": t, "visual": int(t[2:]) % 2 == 0} for t in titles])

    path = str(tmp_path / "verdicts")
    part = classify.ask_in_parts(nodes.filter("page_id < 10"), answer, path, every=1, batch=3)
    assert part.count() == 10
    before = len(list(asked.iterdir()))
    done = classify.ask_in_parts(nodes, answer, path, every=1, batch=3)
    assert {(r.page_id, r.visual) for r in done.collect()} == {(i, i % 2 == 0) for i in range(40)}
    later = {t for f in sorted(asked.iterdir(), key=lambda f: f.stat().st_mtime)[before:] for t in f.read_text().split("\n")}
    assert later == {f"t_{i}" for i in range(10, 40)}
    for f in asked.iterdir():
        f.unlink()
    none = classify.ask(nodes, lambda t: answer(t, True), retries=3, wait=0.01, limit=2).collect()
    assert [r.visual for r in none] == [None, None] and len(list(asked.iterdir())) == 3


def test_samples_are_seeded(spark):
    nodes = spark.createDataFrame([(f"page_{i}", "page") for i in range(50)], "node_id string, node_type string")
    a, b, c = (ids(lookup.random_pages(nodes, 5, s).select("node_id")) for s in (1, 1, 2))
    assert a == b != c and len(a) == 5


def test_quantiles(spark):
    rng = random.Random(3)
    for values in ([1.0], [2.0, 1.0], [rng.choice([0.1, 0.2, rng.random()]) for _ in range(200)]):
        df = spark.createDataFrame([(v,) for v in values], "pagerank double")
        shares = [0, 0.2, 0.5, 0.75, 0.99, 1]
        want = df.agg(F.percentile("pagerank", F.array(*(F.lit(float(s)) for s in shares)))).first()[0]
        assert list(pr.quantiles(df, shares).first()) == pytest.approx(want)


def test_concept_card(spark):
    cats = spark.createDataFrame([(10, "R"), (11, "A"), (12, "B"), (13, "C"), (14, "S")], "category_id long, title string")
    e = edges_of(spark, [(10, 11), (10, 12), (11, 13), (12, 13), (14, 13)])
    g = kg.build(spark.createDataFrame([(1, "p1")], "page_id long, title string"), spark.createDataFrame([(1, 13)], "page_id long, category_id long"), cats, e)
    card = lookup.concept_card(g, "P1").first()
    assert card.parents == ["C"] and card.hierarchy == ["R>A>C>p1", "S>C>p1"]
    assert lookup.concept_card(g, "nothing").isEmpty()


@pytest.mark.parametrize("limit", [1 << 23, 0])
def test_lists_of_concepts(spark, monkeypatch, limit):
    """Put together row by row or, of a large hierarchy, joined: the same lists, of null categories and without any too."""
    monkeypatch.setattr(up, "LOOKUP_PAIRS", limit)
    above = up.closure(edges_of(spark, [(1, 2), (1, 3), (2, 4), (3, 4), (9, 5)]))
    held = spark.createDataFrame([(10, 4), (10, 4), (10, 5), (11, 1), (12, None), (12, 2), (13, 7)], "page_id long, category_id long")
    depths = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 2), (5, None), (9, 3)], "id long, depth int")
    nodes = spark.createDataFrame([(10,), (11,), (13,), (14,)], "id long")
    assert {r.id: list(r.ancestors) for r in up.concept_ancestors(held, above, depths, nodes).collect()} == {10: [1, 5, 2, 3, 4, 9], 11: [1], 13: [7], 14: []}
    pairs = sorted(tuple(r) for r in up.ancestors_of_concepts(held, above).filter("id <> 12").collect())
    assert pairs == [(10, 1), (10, 2), (10, 3), (10, 4), (10, 5), (10, 9), (11, 1), (13, 7)]
    assert {r.ancestor for r in up.ancestors_of_concepts(held, above).filter("id = 12").collect()} == {None, 1, 2}


def test_lists_of_concepts_are_not_dealt_out(spark):
    """Concepts meet their categories in a shuffle; what is above these comes in from a table that each task has."""
    above = up.closure(edges_of(spark, [(1, 2), (2, 4)]))
    plan = up.concept_ancestors(edges_of(spark, [(10, 4), (11, 2)], "page_id", "category_id"), above)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and plan.count("Join") == 1


def test_fingerprints_of_lists(spark):
    rows = spark.createDataFrame([(0, [3, 1, 2]), (1, [1, 2, 3]), (2, [1, 2]), (3, None)], "i int, x array<long>")
    f = [r.f for r in rows.select(validate._fingerprint(F.col("x")).alias("f"), "i").orderBy("i").collect()]
    assert f[0].members == f[1].members != f[2].members and f[0].order != f[1].order and f[3] is None


@pytest.mark.parametrize("limit", [1 << 23, 0])
def test_distinct_counts_of_odd_rows(spark, monkeypatch, limit):
    """Repeated rows, null pages and null categories, a category without pages and one that is not listed."""
    monkeypatch.setattr(up, "LOOKUP_PAIRS", limit)
    above = up.closure(edges_of(spark, [(1, 2), (1, 3), (2, 4), (3, 4), (9, 5)]))
    held = spark.createDataFrame([(10, 4), (10, 4), (10, 5), (10, 2), (11, 1), (12, None), (12, 2), (13, 7), (None, 4)], "page_id long, category_id long")
    cats = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 8, 9)], "id long")
    got = {r.id: (r.direct, r.total) for r in up.distinct_counts(cats, held, above).collect()}
    assert got == {1: (1, 4), 2: (2, 3), 3: (0, 2), 4: (2, 2), 5: (1, 1), 8: (0, 0), 9: (0, 1)}


def test_distinct_counts_deal_the_bridge_out_once(spark):
    """One shuffle of the bridge serves both counts, and that which makes it distinct falls away."""
    above = up.closure(edges_of(spark, [(1, 2), (2, 4)]))
    held = spark.range(100).selectExpr("id * 7 % 50 AS page_id", "id % 3 AS category_id").distinct()
    plan = up.distinct_counts(spark.createDataFrame([(1,)], "id long"), held, above)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 100") == 1
    assert plan[plan.index("Generate explode") : plan.index("Range (0, 100")].count("Exchange hashpartitioning") == 1


def test_cleaning_makes_only_what_is_read(spark, monkeypatch):
    """What cleaning took away is told without counts and lists of the graph that is left; its tables are made when read."""
    cats = spark.createDataFrame([(10, "R"), (11, "A"), (12, "Lonely")], "category_id long, title string")
    visual = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3")], "page_id long, title string")
    held = spark.createDataFrame([(1, 11), (1, 11), (2, 11), (2, None), (None, 11)], "page_id long, category_id long")
    g = kg.build(visual, held, cats, edges_of(spark, [(10, 11)]))
    with monkeypatch.context() as m:
        for name in ("concept_ancestors", "distinct_counts"):
            m.setattr(kg, name, lambda *a: pytest.fail(f"{name} is not read"))
        done, stats = kg.clean(g, min_root_concepts=1)
    assert stats["removed_orphan_concepts"] == 1 and stats["concepts_before"] == 3 and stats["categories_before"] == 2
    assert sorted((r.original_id, r.node_type, r.total_concept_count) for r in done["nodes"].collect()) == [(1, "concept", 1), (2, "concept", 1), (10, "category", 2), (11, "category", 2)]
    assert sorted(tuple(r) for r in done["edges"].select("src_id", "dst_id").collect()) == [(1, 11), (2, 11), (11, 10)]
    assert set(done) == {"nodes", "edges", "title_index", "ancestors", "metadata"} and done["metadata"].first().num_edges == 3


def test_counts_after_cleaning_need_no_depths(spark, monkeypatch):
    """Cleaning reads neither depths nor counts of the graph before, its tables go early, and counts come without depths."""
    cats = spark.createDataFrame([(10, "R"), (11, "A"), (12, "Lonely")], "category_id long, title string")
    visual = spark.createDataFrame([(1, "p1"), (10, "p2"), (3, "p3")], "page_id long, title string")
    held = spark.createDataFrame([(1, 11), (1, 11), (10, 11), (10, 10), (10, None), (None, 11)], "page_id long, category_id long")
    g, read = kg.build(visual, held, cats, edges_of(spark, [(10, 11)])), []
    with monkeypatch.context() as m:
        m.setattr(kg, "concept_depths", lambda *a: pytest.fail("depths are not read"))
        done, stats = kg.clean(g, min_root_concepts=1, read=lambda: read.append(1))
        rows = sorted(tuple(r) for r in done.counted().collect())
    names = ("node_id", "original_id", "node_type", "direct_concept_count", "total_concept_count")
    assert rows == sorted(tuple(r) for r in done["nodes"].select(*names).collect()) and len(rows) == 4
    assert [r for r in rows if r[2] == "category"] == [(21, 10, "category", 1, 2), (22, 11, "category", 2, 2)]
    assert read == [1] and "nodes" not in g.tables and stats["removed_orphan_concepts"] == 1
    again, same = kg.clean({name: g[name] for name in ("nodes", "edges")}, min_root_concepts=1)
    assert same == stats and rows == sorted(tuple(r) for r in again.counted().collect())


def test_orphans_deal_no_bridge_out(spark):
    from loomgraph.runtime import setting

    cats = spark.createDataFrame([(10,), (11,)], "id long")
    held = spark.createDataFrame([(1, 11), (2, 11), (3, 99)], "page_id long, category_id long")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        used, pages = trim.without_orphans(cats, edges_of(spark, [(10, 11)]), held)
        assert "SortMergeJoin" not in pages._jdf.queryExecution().executedPlan().toString()
        assert ids(used) == [10, 11] and ids(pages) == [1, 2]


def test_only_leaves_no_other_scratch(spark):
    from loomgraph.runtime import made, only, staged

    def make():
        return staged(staged(spark.range(3), "first").filter("id > 0"), "second")

    with made() as paths:
        out = only(make)
    there = [p for p in paths if os.path.exists(p.removeprefix("file:"))]
    assert out.count() == 2 and len(paths) == 2 and there == [out.scratch_path]
