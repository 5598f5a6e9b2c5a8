from loomgraph.sources.tables import read_patterns


def test_long_lists_are_read_whole(spark, tmp_path):
    (tmp_path / "p.txt").write_text("# head\n\n" + "".join(f"^c{i}$\n" for i in range(10_050)))
    assert sorted(read_patterns(spark, str(tmp_path / "p.txt"))) == sorted(f"^c{i}$" for i in range(10_050))
