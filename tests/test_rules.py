"""Truth tables of the scoring rules, the merge, and the gates they stand on."""

from __future__ import annotations

import hashlib
import html

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom import schema
from fieldloom.functions.text import html_to_text, iso_date, number, strip, unescaped
from fieldloom.operators import validate
from fieldloom.operators.merge import merge_sources
from fieldloom.plans import queries

AS_OF = "2025-06-15"


def verdicts(spark, rows, ddl, column):
    return [(r["v"]["score"], r["v"]["issues"]) for r in spark.createDataFrame(rows, ddl).coalesce(1).select(column.alias("v")).collect()]


def test_generic(spark):
    rows = [(None, 0.9, True), (None, 0.9, False), ("", 0.9, False), ("x", 0.69, False), ("x", 0.7, False), ("x", 0.0, True), ("x", None, False), ("x", 1.5, False)]
    got = verdicts(spark, rows, "value string, c double, required boolean", validate.check_generic(F.lit("f"), F.col("value"), F.col("c"), F.col("required")))
    assert got == [
        (0.0, ["f: missing (required)"]), (0.5, ["f: not found (optional)"]), (0.9, []), (0.69, ["f: low confidence (0.69)"]), (0.7, []),
        (0.0, ["f: low confidence (0.00)"]), (0.0, ["f: low confidence (0.00)"]), (1.5, []),
    ]


def test_currency(spark):
    rows = [("1 USD", 0.9, None), ("1 usd", 0.9, None), ("1", 0.9, "in Usd"), ("1", 0.9, None), ("1", 0.5, ""), (None, 0.9, "USD")]
    got = verdicts(spark, rows, "value string, c double, notes string", validate.check_currency(F.col("value"), F.col("c"), F.col("notes"), F.lit("USD")))
    issue = ["tuition: currency may not match expected USD"]
    assert got == [(0.9, []), (0.9, []), (0.9, []), (0.7, issue), (0.5, issue), (0.0, ["tuition_fees: not found"])]


@pytest.mark.parametrize(
    ("value", "score", "issue"),
    [
        ("43", 0.9, None), ("43%", 0.9, None), (" 4.5 % ", 0.9, None), ("0", 0.9, None), ("100", 0.9, None), ("100.01", 0.0, "acceptance_rate: implausible value 100.01"),
        ("-1", 0.0, "acceptance_rate: implausible value -1.0"), ("about half", 0.5, "acceptance_rate: could not parse as number"), ("5d", 0.5, "acceptance_rate: could not parse as number"),
        ("1_0", 0.5, "acceptance_rate: could not parse as number"), ("nan", 0.5, "acceptance_rate: could not parse as number"), ("", 0.5, "acceptance_rate: could not parse as number"),
        (None, 0.4, "acceptance_rate: not found"),
    ],
)
def test_percent(spark, value, score, issue):
    assert verdicts(spark, [(value, 0.9)], "value string, c double", validate.check_percent(F.col("value"), F.col("c"))) == [(score, [issue] if issue else [])]


def test_deadline(spark):
    values = ["2025-06-14", "2025-06-15", "2025-06-16", "2025", "2025-1-5", "20250614", "2025-06-14T23:00:00+02:00", "2025-02-30", "in spring", '["2025-06-14"]', None]
    got = verdicts(spark, [(v, 0.9) for v in values], "value string, c double", validate.check_deadline(F.col("value"), F.col("c"), F.lit(AS_OF).cast("date")))
    past = {"2025-06-14", "20250614", "2025-06-14T23:00:00+02:00"}
    assert got == [(0.4, ["intake_deadlines: not found"]) if v is None else (0.6, [f"intake_deadlines: deadline {v} is in the past"]) if v in past else (0.9, []) for v in values]


def test_rollup_all_missing_and_sample_shape(spark):
    entities = spark.createDataFrame([("none", "USD"), ("full", "USD")], "entity_id string, currency string")
    rows = [("full", r.storage_key, "1 USD" if r.rule != "percent" else "prose", 1.0, None) for r in schema.ROUTES]
    found = spark.createDataFrame(rows, "entity_id string, storage_key string, value string, confidence double, notes string")
    out = {r["entity_id"]: r for r in validate.rollup(validate.score_fields(found, schema.routes(spark), entities, AS_OF)).collect()}
    assert out["none"]["overall_quality_score"] == 0.38 and not out["none"]["ready_for_storage"]
    assert out["none"]["critical_issues"] == ["about_university missing or low confidence", "tuition_fees missing or implausible"]
    assert out["full"]["overall_quality_score"] == 0.95 and out["full"]["ready_for_storage"] and out["full"]["critical_issues"] == []
    assert set(out["full"]["fields"]) == {r.report_key for r in schema.ROUTES}
    assert out["none"]["fields"]["about"]["issues"] == ["about_university: missing (required)"]


def test_merge(spark):
    ddl = "k int, value string, confidence double, source_url string, needs_review boolean, notes string"
    p = spark.createDataFrame([(1, None, 0.0, "a", True, None), (2, None, 0.0, "a", True, None), (3, "x", 0.5, "a", True, "n"), (4, " X ", 0.95, "a", True, None), (5, "x", 0.9, "a", False, None), (6, "only", 0.4, "a", False, None)], ddl)
    s = spark.createDataFrame([(1, None, 0.1, "b", True, None), (2, "y", 0.8, "b", False, "m"), (3, None, 0.0, "b", True, None), (4, "x", 0.2, "b", True, None), (5, "z", 0.3, "b", False, None), (7, "late", 0.6, "b", False, None)], ddl)
    got = {r["k"]: tuple(r)[1:] for r in merge_sources(p, s, ["k"]).collect()}
    assert got == {
        1: (None, 0.0, "a", True, None, "neither"), 2: ("y", 0.8, "b", False, "m", "secondary"), 3: ("x", 0.5, "a", True, "n", "primary"),
        4: (" X ", 1.0, "a", False, "Cross-validated: secondary source agrees. (b)", "agree"), 5: ("x", 0.9, "a", True, "CONFLICT: primary=x (from a) vs secondary=z (from b)", "conflict"),
        6: ("only", 0.4, "a", False, None, "primary"), 7: ("late", 0.6, "b", False, None, "secondary"),
    }


def test_gates(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "x string").select(c(F.col("x"))).first()[0]
    assert one(strip, "\t  a b \n") == "a b"
    assert [one(number, v) for v in ("1e3", ".5", "5.", "+7", "1,0", "inf", None)] == [1000.0, 0.5, 5.0, 7.0, None, None, None]
    assert [str(one(iso_date, v)) for v in ("2025-01-15 10:20", "2025-01-15 junk", "2025-W03-3")] == ["2025-01-15", "None", "None"]


def test_html(spark):
    html = "<title>T</title><style>p{}</style><p>a &amp;lt; b<!-- c --><b> d\n e </b><nav>n<i>m</i></nav><script>var t='</p>';</script>"
    assert spark.createDataFrame([(html,)], "x string").select(html_to_text(F.col("x"))).first()[0] == "T a &lt; b d\n e"
    assert spark.createDataFrame([("x" * 9000,)], "x string").select(F.length(html_to_text(F.col("x")))).first()[0] == 8000


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 1), min_size=2, max_size=6))
def test_score_grows_with_confidence(spark, cs):
    rows = [("x", c) for c in sorted(cs)]
    for column in (validate.check_percent(F.col("value"), F.col("c")), validate.check_currency(F.col("value"), F.col("c"), F.lit(None), F.lit("USD"))):
        scores = [s for s, _ in verdicts(spark, rows, "value string, c double", column)]
        assert scores == sorted(scores)


def test_all_entities_in_pivot(spark):
    d = "/root/testdata/sf0.001"
    rows = queries.q17_field_entity_pivot(spark, d).collect()
    ids = {r[0] for r in spark.read.parquet(f"{d}/events.parquet").select("user_id").distinct().collect()}
    assert {(r["field"], r["entity_id"]) for r in rows} == {(f, i) for f in queries.EVENT_FIELDS for i in ids} and len(rows) == 5 * len(ids) > 25
    for field in queries.EVENT_FIELDS:
        scores = [float(r["score"]) for r in rows if r["field"] == field]
        assert [r["avg_score"] for r in rows if r["field"] == field] == pytest.approx([sum(scores) / len(scores)] * len(ids), abs=1e-5)


def test_routes_whole_texts(spark):
    d = "/root/testdata/sf0.001"
    whole = {r["text_md5"] for r in queries.q01_html_text(spark, d).collect()} | {hashlib.md5(b"").hexdigest()}
    assert {r["text_md5"] for r in queries.q05_route_fallback(spark, d).collect()} <= whole


def test_preview_of_all_documents(spark, tmp_path):
    spark.createDataFrame([(3, "three"), (4, "four")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3,), (4,), (5,)], "doc_id long").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["entity_id"]: r["preview_md5"] for r in queries.q20_value_preview(spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.md5(x.encode()).hexdigest() for i, x in ((3, "three"), (4, "four"), (5, "—"))}


def test_all_character_references(spark):
    pages = ["<p>caf&eacute; &#8217;x&#x2019; &uuml;ber &hellip;</p>", "<p>a &amp;eacute; &lt;b&gt; &copy; c</p>", "<p>&eacute;</p>" * 9000, None]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(pages)], "i int, x string").select("i", html_to_text(F.col("x")).alias("t")).orderBy("i").select("t").collect()]
    assert got == ["café ’x’ über …", "a &eacute; <b> © c", ("é " * 9000)[:8000], None]
    odd = ["&notit; &notin; &copyx &amp;lt; &zzz; & &#; &#x; &#0; &#128; &#xD800; &#99999999999; &#x1F600;y &#0065 &NotEqualTilde; &AMP&&lt", "&eacute", "", "a&b"]
    got = spark.createDataFrame([(x,) for x in odd], "x string").select("x", unescaped(F.col("x")).alias("t")).collect()
    assert all(r["t"] == html.unescape(r["x"]) for r in got)


def test_references_without_semicolon_stay(spark):
    pages = ["<p>a&amp;&amp</p>", "<p>caf&eacute; &eacute x &amp</p>", "<p>&#8217;&#8217 &ampx &notit;</p>"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(pages)], "i int, x string").select("i", html_to_text(F.col("x")).alias("t")).orderBy("i").select("t").collect()]
    assert got == ["a&&amp", "café &eacute x &amp", "’&#8217 &ampx &notit;"]
