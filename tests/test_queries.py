"""Every query against its DuckDB twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from fieldloom.plans import oracle, queries

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(value):
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_twin(spark, db, name):
    frame = queries.queries()[name](spark, str(SF))
    columns = sorted(frame.columns)
    twin = db.sql(oracle.oracle_sql()[name])
    assert sorted(twin.columns) == columns
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    theirs = sorted(tuple(plain(v) for v in r) for r in twin.select(*[f'"{c}"' for c in columns]).fetchall())
    assert mine == theirs


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.queries()) <= set(__spark_entry__.queries()) and set(oracle.oracle_sql()) == set(queries.queries())
    assert set(oracle.oracle_sql()) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def agrees(spark, name, pages, folder):
    """Whether a query and its twin give the same rows over made-up pages, and these rows."""
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    frame, con = queries.queries()[name](spark, str(folder)), duckdb.connect()
    con.sql(f"create view pages as select * from '{folder}/pages.parquet/*.parquet'")
    columns = sorted(frame.columns)
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    return mine == sorted(tuple(plain(v) for v in r) for r in con.sql(oracle.oracle_sql()[name]).select(*[f'"{c}"' for c in columns]).fetchall()), mine


@pytest.mark.parametrize("name", ["q01_html_text", "q02_fetch_summary", "q05_route_fallback"])
def test_references_without_semicolon(spark, tmp_path, name):
    texts = ["<title>a&amp;&amp</title><p>a&amp;&quot;b&am</p>", "<p>&ampx &lt b &copy &eacute &#39 &#x27 &#8217</p>", "<p>&amp;amp &amp&amp; &notit &amplify; &</p>", "<p>&copy; a</p>", "<p>a &amp; b</p>"]
    same, rows = agrees(spark, name, [(i, f"https://h{i % 2}.example/{i}", x) for i, x in enumerate(texts, 1)], tmp_path)
    assert same and rows


def test_whole_texts(spark, tmp_path):
    pages = [(1, "https://h.example/1", "<p>" + "ab " * 5000 + "</p><p>end</p>"), (2, "https://h.example/2", "<p>" + "ab " * 5000 + "</p><p>End</p>"), (3, "https://h.example/3", "<p>é&amp;</p>" * 4001)]
    same, rows = agrees(spark, "q01_html_text", pages, tmp_path)
    columns = sorted(("page_id", "n_chars", "text_md5", "prompt_md5"))
    assert same and sorted(int(r[columns.index("n_chars")]) for r in rows) == [12002, 15003, 15003]
    assert len({r[columns.index("text_md5")] for r in rows}) == 3


def test_summary_of_whole_texts(spark, tmp_path):
    pages = [(1, "https://h.example/1", "<p>" + "ab " * 5000 + "</p><p>end</p>"), (2, "https://h.example/2", "<p>é&amp;</p>" * 4001), (3, "https://g.example/3", "<p></p>")]
    same, rows = agrees(spark, "q02_fetch_summary", pages, tmp_path)
    assert same and rows == [("https://g.example", "0", "0", "1"), ("https://h.example", "27005", "2", "2")]
