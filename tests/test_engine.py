"""Sources, replies, typed records, stores, reports, streaming: with fakes, no network."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldloom import schema
from fieldloom.operators.extract import ChatService, Patterns, Recorded, envelopes, extract, parse_reply, with_retries
from fieldloom.operators.store import Store, latest, ranked_latest, upserted
from fieldloom.operators.typed import listed_values, records
from fieldloom.plans.run import outputs, requests, run, start, watched, write_outputs
from fieldloom.sources.pages import Session, fetch, fetch_one, fetch_summary, page_texts
from fieldloom.sources.registry import distinct_urls, load_registry, page_list
from fieldloom.sources.robots import allowed, fetch_policies, gate, policy
from fieldloom.streaming.upsert import arrivals, upsert_stream

REGISTRY = """
universities:
  - id: north
    name: North Institute
    country: Norland
    currency: NOK
    pages: {about: "https://north.example/a", tuition: "https://north.example/fees", living: "https://north.example/fees", visa: "https://north.example/v"}
  - id: south
    name: South Institute
    country: Sudland
    currency: SUD
    pages: {about: "https://south.example:8080/a"}
"""


@pytest.fixture
def registry(spark, tmp_path):
    path = tmp_path / "registry.yaml"
    path.write_text(REGISTRY)
    return load_registry(spark, str(path))


def test_registry(registry):
    pages = page_list(registry)
    assert pages.count() == 5 and distinct_urls(pages).count() == 4


def test_robots(spark, registry):
    assert policy(503, "x") == policy(401, None) == "User-agent: *\nDisallow: /" and policy(404, "x") == policy(None, None) == ""
    assert allowed("", "https://a/b") and not allowed("User-agent: *\nDisallow: /b", "https://a/b") and not allowed("", None)
    answers = {"https://north.example/robots.txt": (200, "User-agent: *\nDisallow: /v"), "https://south.example:8080/robots.txt": (500, None)}
    pages = page_list(registry).unionByName(spark.createDataFrame([("odd", "x", "no url"), ("odd", "y", None)], "entity_id string, label string, url string"))
    from fieldloom.functions.text import url_base

    gated = gate(pages, fetch_policies(pages.select(url_base(F.col("url")).alias("base")), answers.get)).collect()
    assert {(r["label"], r["entity_id"]): r["allowed"] for r in gated} == {("about", "north"): True, ("tuition", "north"): True, ("living", "north"): True, ("visa", "north"): False, ("about", "south"): False, ("x", "odd"): True, ("y", "odd"): False}


def test_fetch(spark, registry):
    waits: list[float] = []
    tries = iter([(429, ""), (500, ""), (200, "<p>ok</p>")])
    assert fetch_one("u", lambda u: next(tries), waits.append)["attempts"] == 3 and waits == [30, 2, 4]

    def fail(url):
        raise OSError("down")

    assert fetch_one("u", fail, lambda s: None) == {"url": "u", "html": None, "status": None, "attempts": 3, "waited": 14.0, "error": "down"}
    pages = page_list(registry)
    gated = pages.withColumn("allowed", F.col("label") != "visa")
    got = fetch(gated, lambda u: (200, f"<p>{u}</p>"), gap=0, sleep=lambda s: None)
    texts = page_texts(pages, got)
    assert {(r["entity_id"], r["fetched"], r["total"]) for r in fetch_summary(texts).collect()} == {("north", 3, 4), ("south", 1, 1)}


@pytest.mark.parametrize(
    ("reply", "value", "confidence", "review", "notes"),
    [
        ('```json\n{"value": "v", "confidence": 0.9, "needs_review": false, "notes": "n"}\n```', '"v"', 0.9, False, "n"),
        ("sorry", None, 0.0, True, "parse_error"), ("[1]", None, 0.0, True, "not_object"), ('{"value": 3, "confidence": null}', "3", 0.0, False, None),
        ('{"value": {"a": 1}, "confidence": "0.9", "needs_review": "no"}', '{"a":1}', 0.0, True, None), ('{"value": null}', None, 0.0, False, None),
        ('{"value": 1, "confidence": 7, "needs_review": null, "notes": [1]}', "1", 7.0, True, "[1]"), ("", None, 0.0, True, "parse_error"), (None, None, 0.0, True, "parse_error"),
    ],
)
def test_replies(spark, reply, value, confidence, review, notes):
    e = spark.createDataFrame([(reply,)], "x string").select(parse_reply(F.col("x")).alias("e")).first()["e"]
    assert (e["value_json"], e["confidence"], e["needs_review"], e["notes"]) == (value, confidence, review, notes)


def test_retries():
    waits: list[float] = []

    def limited():
        raise RuntimeError("Rate_Limit hit")

    def broken():
        raise RuntimeError("bad key")

    assert with_retries(limited, sleep=waits.append) == (None, "Rate limit exceeded") and waits == [5, 10, 15, 20, 25, 30, 30, 30]
    assert with_retries(broken, sleep=waits.append) == (None, "bad key") and len(waits) == 8


def test_typed(spark):
    rows = [
        ("a", "about_raw", '{"founding_year": "1900", "location_city": "C"}'), ("a", "acceptance_raw", '" 7 %"'), ("a", "visa_raw", '{"visa_type": "V"}'),
        ("b", "about_raw", '{"location_city": null}'), ("b", "acceptance_raw", "0"), ("b", "visa_raw", '"prose"'), ("c", "about_raw", '"prose"'), ("c", "acceptance_raw", '"prose"'), ("c", "visa_raw", '""'),
    ]
    found = spark.createDataFrame([(*r, 0.8, "u", False, None) for r in rows], "entity_id string, storage_key string, value_json string, confidence double, source_url string, needs_review boolean, notes string")
    entities = spark.createDataFrame([(k, k.upper(), "Land") for k in "abcd"], "entity_id string, name string, country string")
    frame = records(found, entities, "2024-01-01T00:00:00")
    assert [(f.name, f.dataType) for f in frame.schema["record"].dataType.fields] == [(f.name, f.dataType) for f in schema.RECORD.fields]
    got = {r["entity_id"]: r["record"] for r in frame.collect()}
    assert (got["a"]["about"]["founding_year"], got["a"]["about"]["location_city"], got["a"]["about"]["location_country"]) == (1900, "C", "")
    assert got["a"]["acceptance_rate"]["overall_percent"] == 7.0 and (got["a"]["visa_policy"]["country"], got["a"]["visa_policy"]["visa_type"]) == ("Land", "V")
    assert got["b"]["about"] is None and got["b"]["acceptance_rate"]["overall_percent"] is None and (got["b"]["visa_policy"]["country"], got["b"]["visa_policy"]["visa_type"]) == ("", "prose")
    assert got["c"]["about"]["location_city"] == "" and got["c"]["acceptance_rate"] is None and got["c"]["visa_policy"] is None
    assert got["d"]["about"] is None and got["d"]["courses"] == [] and got["d"]["overall_confidence"] == 0.0


def test_listed(spark):
    text = spark.createDataFrame([("[{'name': 'x', 'value': '1'}]",), ("[{'name': 'x'}, None]",)], "x string")
    got = [r["v"] for r in text.coalesce(1).select(listed_values(F.col("x"), "name string, value string").alias("v")).collect()]
    assert got[0][0]["name"] == "x" and got[1] is None


def test_upsert(spark, tmp_path):
    ddl = "id string, v string, ts int, seq int"
    old = spark.createDataFrame([("a", "1", 1, 1), ("b", "1", 1, 1)], ddl)
    new = spark.createDataFrame([("a", "2", 2, 1), ("a", "3", 2, 2), ("c", "1", 1, 1), (None, "n", 1, 1)], ddl)
    want = {("a", "3", 2, 2), ("b", "1", 1, 1), ("c", "1", 1, 1), (None, "n", 1, 1)}
    assert {tuple(r) for r in upserted(old, new, ["id"], ["ts", "seq"]).collect()} == want
    assert {tuple(r) for r in latest(new, ["id"], ["ts", "seq"]).collect()} == {tuple(r) for r in ranked_latest(new, ["id"], ["ts", "seq"]).collect()}


def test_run(spark, registry, tmp_path):
    texts = spark.createDataFrame([("north", "about", "https://north.example/a", "Founded 1900"), ("north", "tuition", "https://north.example/fees", "NOK 100"), ("north", "living", "https://north.example/fees", ""), ("south", "about", "https://south.example:8080/a", None)], schema.PAGES)
    asked = requests(registry, texts)
    living = asked.filter("entity_id = 'north' AND storage_key = 'living_raw'").first()
    assert (living["text"], living["url"], living["used_label"]) == ("NOK 100", "https://north.example/fees", "tuition") and asked.count() == 20
    replies = {("https://north.example/a", "about_university"): '{"value": {"founding_year": 1900}, "confidence": 1.0}', ("https://north.example/fees", "tuition_fees_all_levels"): '{"value": "NOK 100", "confidence": 0.9}'}
    store = Store(spark, str(tmp_path / "store"))
    report = run(spark, registry, texts, Recorded(replies), store, str(tmp_path / "replies"), "2024-01-01", "2024-01-02T00:00:00", str(tmp_path / "report.md"), pause=0)
    text = (tmp_path / "report.md").read_text()
    assert report == str(tmp_path / "report.md") and "| north | North Institute | 1.00 | 0.90 | 0.50 |" in text and "| **all** |  | 0.50 | 0.45 |" in text
    again = run(spark, registry, texts, Recorded(replies), store, str(tmp_path / "replies2"), "2024-01-01", "2024-01-03T00:00:00", pause=0)
    assert again + "\n" == text and store.read("raw_fields").count() == 20
    listed = store.listed().collect()
    assert [r["id"] for r in listed] == ["north", "south"] and listed[0]["confidence"] == round((1 + 0.9 + 0.5 * 6 + 0.4 * 2) / 10, 3)
    assert json.loads(store.record("north"))["about"]["founding_year"] == 1900 and store.record("x") is None
    found = envelopes(extract(asked, Recorded(replies), skip_empty=True))
    body = json.loads(outputs(registry, found, "2024-01-01", "t").filter("entity_id = 'north'").first()["json"])
    assert body["fields"]["about_raw"]["value"] == {"founding_year": 1900} and list(body["fields"]) == [r.storage_key for r in schema.ROUTES]
    assert body["validation"]["ready_for_storage"] is False and set(body["fields"]) == {r.storage_key for r in schema.ROUTES}


def test_start(spark, registry, tmp_path, caplog):
    """From the registry file to the report: robots, one fetch a url, paced extraction, three tables, counts."""
    asked = spark.sparkContext.accumulator(0)

    def get(url):
        asked.add(1)
        return 200, f"<p>Page {url}</p>"

    robots = lambda url: (200, "User-agent: *\nDisallow: /v") if "north" in url else (None, None)
    replies = {("https://north.example/a", "about_university"): '{"value": "x", "confidence": 1.0}'}
    store = Store(spark, str(tmp_path / "store"))
    with caplog.at_level("INFO", "fieldloom"):
        report = start(spark, str(tmp_path / "registry.yaml"), Recorded(replies), store, str(tmp_path / "scratch"), "2024-01-01", "2024-01-02T00:00:00", get=get, robots=robots, gap=0, pause=0.01, skip_empty=True)
    assert asked.value == 3 and "| north | North Institute | 1.00 |" in report and "20 fields tried, 1 found" in caplog.text
    assert store.read("raw_fields").filter("value_json != 'null'").count() == 1 and store.read("validation_reports").count() == 2


def test_session():
    """One connection serves a host's pages, is opened anew when the server has closed it, and follows redirects."""
    import socket
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    ports = []

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_GET(self):
            ports.append(self.client_address[1])
            if self.path == "/old":
                self.send_response(302)
                self.send_header("Location", "/new")
                self.send_header("Content-Length", "0")
                self.end_headers()
                return
            body = self.path.encode()
            self.send_response(404 if self.path == "/none" else 200)
            self.send_header("Content-Length", str(len(body)))
            if self.path == "/last":
                self.send_header("Connection", "close")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    session = Session()
    try:
        assert [session(f"{base}{p}") for p in ("/a", "/b?c=1", "/old", "/none")] == [(200, "/a"), (200, "/b?c=1"), (200, "/new"), (404, "/none")]
        assert len(set(ports)) == 1
        assert session(f"{base}/last")[0] == 200 and session(f"{base}/a")[0] == 200 and len(set(ports)) == 2
        session.connection.sock.shutdown(socket.SHUT_RDWR)  # as if the server had gone
        assert session(f"{base}/a") == (200, "/a")
    finally:
        session.close()
        server.shutdown()


def test_store_survives_a_crash(spark, tmp_path, monkeypatch):
    """What fails before the manifest is published changes no table; and a writer that comes second fails."""
    ts = "timestamp_ntz'2024-01-01 00:00:00'"
    entities = lambda n: spark.sql(f"select '{n}' id, '{n}' name, {ts} scraped_at, 0.5D overall_confidence, '{{}}' data_json")
    checked = lambda n: spark.sql(f"select '{n}' university_id, '{{}}' report_json, 0.5D quality_score, 0 ready_for_storage, {ts} created_at")
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    store.upsert_all({"universities": entities("a"), "validation_reports": checked("a")})
    whole = Store._write

    def fails(self, name, rows):
        if name == "validation_reports":
            raise OSError("disk full")
        return whole(self, name, rows)

    for name, broken in (("_write", fails), ("_publish", lambda self, number, versions: (_ for _ in ()).throw(OSError("killed")))):
        with monkeypatch.context() as m:
            m.setattr(Store, name, broken)
            with pytest.raises(OSError):
                store.upsert_all({"universities": entities("b"), "validation_reports": checked("b")})
        again = Store(spark, str(tmp_path / "store"))
        assert [r["id"] for r in again.listed().collect()] == ["a"] and again.read("validation_reports").count() == 1
    number, versions = store._manifest()
    with pytest.raises(RuntimeError):
        store._publish(number, versions)
    store.upsert_all({"universities": entities("b"), "validation_reports": checked("b")})
    assert store.listed().count() == 2 and store.read("validation_reports").count() == 2


def test_sinks_and_counts(spark, registry, tmp_path):
    texts = spark.createDataFrame([("north", "about", "https://north.example/a", "Founded in 1900.")], schema.PAGES)
    answers = extract(requests(registry, texts), Patterns({"about_university": r"in (\d+)"}))
    found, seen = watched(envelopes(answers))
    write_outputs(outputs(registry, found, "2024-01-01", "t"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("entity_id=*")) == ["entity_id=north", "entity_id=south"]
    assert found.count() == 20 and seen.get["tried"] == 20 and seen.get["found"] == 1


def test_service(monkeypatch):
    with pytest.raises(KeyError):
        ChatService("https://service.example", "m", "NO_SUCH_KEY_HERE")
    monkeypatch.setenv("A_KEY", "k")
    body = ChatService("https://service.example", "m", "A_KEY").body("p")
    assert [m["role"] for m in body["messages"]] == ["system", "user"] and body["temperature"] == 0.0 and body["max_tokens"] == 1024


def test_empty_store(spark, tmp_path):
    from fieldloom.operators.report import markdown

    store = Store(spark, str(tmp_path / "s"))
    assert markdown(store.read("universities"), store.read("raw_fields")) is None and store.listed().count() == 0


def test_stream(spark, tmp_path):
    landed = spark.sql("select 'e' entity_id, 'about' label, 'u' url, '<p>hi</p>' html, timestamp_ntz'2024-01-01 00:00:00' landed_at")
    landed.write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "store"))
    for _ in range(2):
        upsert_stream(spark, str(tmp_path / "in"), store, str(tmp_path / "check")).awaitTermination()
        assert [(r["university_id"], r["value_json"]) for r in store.read("raw_fields").collect()] == [("e", '{"text":"hi"}')]
    assert arrivals(landed.withColumn("landed_at", F.col("landed_at").cast("timestamp"))).first()["fetched"] == 1
