"""Small fixtures for the operators whose cases the driver's tables lack."""

from lodestack.functions import text as T
from lodestack.operators import matching as M
from lodestack.operators import relational as R
from lodestack.sources import files
from pyspark.sql import functions as F


def values(spark, column, rows):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column(F.col("x"))).collect()]


def test_text_functions(spark):
    assert values(spark, T.clean_text, ["&lt;b&gt;a&lt;/b&gt; <p>x&nbsp;y</p>", "<script>z</script>q"]) == ["a x y", "q"]
    assert values(spark, T.clean_cell, ["&lt;b&gt;a <i>x</i>"]) == ["<b>a x"]
    assert values(spark, T.iso_date, ["03.12.2020", "open", None]) == ["2020-12-03", "open", None]
    assert values(spark, T.date_rank, ["03-12-2020_a.pdf", "../2020-12-03.txt", "a"]) == [20201203, 20201203, 0]
    assert values(spark, T.application_id, [" ep10007106.5 ", "10007106", "", None]) == ["EP10007106", "EP10007106", "", ""]
    assert values(spark, T.publication_id, ["WO 2004/12345 A1", "EP 1 492 030 B1", "US 2004/0012345", "US 14123456", "xx"]) == ["WO2004012345A1", "EP1492030B1", "US20040012345A1", "", ""]
    assert values(spark, T.wipo_id, ["WO9912345", "WO0112345", "EP1"]) == ["WO1999012345", "WO2001012345", "EP1"]
    assert values(spark, lambda x: T.between(x, "Applicant:", ["Inventor:", "Agent:"], 50), ["Applicant: A B Agent: C Inventor: D", "none"]) == ["A B", ""]
    assert values(spark, lambda x: T.rewrite_root_links(x, "https://b"), ['<a href="/x"><a href="//y">']) == ['<a href="https://b/x"><a href="//y">']
    assert values(spark, T.meaningful_chars, ["--- PAGE 3 ---\nSOURCE: abc\nxy 中1"]) == [4]


def test_scores_disagree_as_meant(spark):
    df = spark.createDataFrame([(80.0, None), (70.0, 90.0)], "a double, b double")
    for mode, want in (("strict", [None, 80.0]), ("renormalised", [80.0, 80.0]), ("zero_fill", [40.0, 80.0])):
        assert [r[0] for r in df.select(R.weighted_score([F.col("a"), F.col("b")], [0.5, 0.5], mode)).collect()] == want


def test_pick_gaps_and_anti(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", 1), ("b", 2)], "k string, n long")
    assert {tuple(r) for r in R.gaps(df, "k", "n").collect()} == {("a", 1, 1), ("b", 0, 0)}
    assert {tuple(r) for r in R.pick(df, ["k"], ["n"], last=True).collect()} == {("a", 3), ("b", 2)}
    rows = spark.createDataFrame([("",), ("x",), ("y",)], "k string")
    assert {r.k for r in R.anti_keep_empty(rows, spark.createDataFrame([("",), ("x",)], "k string"), "k").collect()} == {"", "y"}


def test_json_and_fuzzy(spark):
    rows = ['{"a": 1}', 'text ```json\n{"b": [2]}\n``` more', "so {bad} then {\"c\": {\"d\": 3}} end", "none", None]
    assert values(spark, M.first_json, rows) == ['{"a": 1}', '{"b": [2]}', '{"c": {"d": 3}}', None, None]


def test_sources(spark, tmp_path):
    assert files.read_csv(spark, str(tmp_path / "missing.csv")).count() == 0
    path = tmp_path / "doclist.csv"
    path.write_text("﻿applicationNumber,documentId,date,title,phase,pages\nEP1,D1,03.12.2020,Title,Exam,4\n", encoding="utf-8")
    assert files.read_csv(spark, str(path)).first().title == "Title"
    (tmp_path / "old.txt").write_bytes("caf\xe9".encode("cp1252"))
    assert files.read_text(spark, str(tmp_path / "old.txt")).first().text == "café"
    assert {r.name for r in files.catalog(spark, str(tmp_path), "*.txt").collect()} == {"old.txt"}
    manifest = tmp_path / "m.json"
    manifest.write_text('{"metadata": {}, "records": [{"app": "EP1", "rank": 2}]}')
    assert files.read_manifest(spark, str(manifest), "app string, rank int").first().rank == 2


def test_entry_and_names():
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and "mention_topk" in queries


def on_tables(spark, tmp_path, name, **tables):
    """Rows of a catalog query over tables given as (rows, schema)."""
    from lodestack.plans import catalog

    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    return sorted(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect())


def test_boxes_of_a_whole_page(spark, tmp_path):
    lines = ([(1, n, 10) for n in range(1, 8)], "l_orderkey long, l_linenumber int, l_partkey long")
    assert len(on_tables(spark, tmp_path / "pairs", "box_iou_pairs", lineitem=lines)) == 21
    apart = ([(1, n, k) for n, k in ((1, 0), (5, 25))], "l_orderkey long, l_linenumber int, l_partkey long")
    assert on_tables(spark, tmp_path / "nms", "greedy_nms", lineitem=apart) == [(1, 1), (1, 5)]


def test_token_overlap_of_short_quotes(spark, tmp_path):
    bench = ([(1, "Alpha beta, gamma"), (2, "delta of it")], "item_id long, text string")
    docs = ([(7, "gamma ALPHA x"), (8, "none here"), (9, "delta")], "doc_id long, text string")
    assert on_tables(spark, tmp_path, "token_overlap_topk", benchmark=bench, documents=docs) == [(1, 7, 2), (2, 9, 1)]


def test_evidence_of_every_tier(spark, tmp_path):
    words = [f"word{i}" for i in range(30)]
    anchors = " ".join(words[:12] + ["other"] + words[-12:])
    bench = ([(1, "pha beta"), (2, "The composition holds twenty grams of it"), (3, " ".join(words)), (4, "zq x")], "item_id long, text string")
    docs = ([(7, "alpha beta"), (8, "the compo sition holds twenty grams of it"), (9, anchors), (10, "a zq x")], "doc_id long, text string")
    for name, want in (("evidence_tiers", [(1, 7, 1.0), (2, 8, 0.97), (3, 9, 0.92), (4, None, 0.0)]), ("evidence_exact_hits", [(1, 7), (4, 10)]), ("evidence_compact_hits", [(2, 8)])):
        assert on_tables(spark, tmp_path / name, name, benchmark=bench, documents=docs) == want


def test_whole_lines_and_snippets(spark, tmp_path):
    turns = [(1, 0, "user", "u" * 60), (1, 1, "tool", "a" * 50), (1, 2, "tool", "b"), (1, 3, "tool", "c"), (1, 4, "tool", "d")]
    got = on_tables(spark, tmp_path / "lines", "borrow_next_lines", conversations=(turns, "conv_id long, turn long, role string, text string"))
    assert got == [(1, 0, " ".join(["u" * 60, "a" * 50, "b", "c"]))]
    docs = ([(1, "x" * 200 + "LICENSE" + "y" * 500)], "doc_id long, text string")
    assert on_tables(spark, tmp_path / "snippets", "keyword_snippets", documents=docs) == [(1, "x" * 120, "x" * 180 + "LICENSE" + "y" * 420)]


def test_character_references(spark):
    """Named, numeric and unfinished references as the standard library reads them; nothing is decoded twice."""
    import html

    texts = ["a &amp; b &lt;i&gt; &quot;x&quot; &#39;y&#39;", "&amp;lt;b&amp;gt; &amp;amp;", "&auml;&ouml;&uuml; &hellip; &NotEqualTilde;", "&#228;&#xE4;&#XE4; &#128; &#0; &#1114112;", "&copy 2024 &ampx &notit; &nosuch; &", "AT&T R&D &;&#;", "&#38;lt; &amp;auml;", "", "no reference", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").withColumn("got", T.unescape(F.col("t"))).collect()
    want = {k: None if t is None else html.unescape(t) for k, t in enumerate(texts)}
    assert {r.k: r.got for r in rows} == want


def test_clean_html_keeps_what_its_sql_keeps(spark, tmp_path):
    """The queries decode the references that their SQL names, also beside unfinished and rare ones; the operators decode all."""
    import duckdb
    from __spark_entry__ import oracle_sql

    pages = [(1, "u", "<p>a &amp b &amp; c</p>"), (2, "u", "R&ampD &eacute; &#39;x&#39; &copy &copy;"), (3, "u", "<i>plain</i> &lt;b&gt; &am")]
    for name in ("clean_html_text", "clean_html_cells"):
        got = on_tables(spark, tmp_path / name, name, pages=(pages, "page_id long, url string, html string"))
        con = duckdb.connect()
        con.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
        con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
        assert sorted(got) == sorted(con.sql(oracle_sql()[name]).fetchall())
