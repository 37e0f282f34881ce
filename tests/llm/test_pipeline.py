"""The pipeline's stages against brute force over a small table."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_operators import deduplicated, sets_of


def test_run_odd_and_empty(spark, odd, tmp_path):
    """Nulls, blank and very long texts, repeated rows and clashing columns pass through; an empty table gives no rows."""
    odd.unionByName(odd.filter("doc_id = 9").selectExpr("doc_id + 100 AS doc_id", *[f"`{c}`" for c in odd.columns if c != "doc_id"])).write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert {r["doc_id"] for r in got} <= {1, 2, 3, 8, 9, 109, None} and {r["doc_id"] for r in got} & {1, 9, None}
    odd.filter("false").write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).collect() == []


def test_stages(spark, tmp_path):
    good = prose(1, 200)
    docs = [(i, prose(i, 150), "en", f"s{i % 3}") for i in range(20)]
    docs += [(30, good, "en", "s0"), (31, good + "\nalso this.", "en", "s0"), (40, "%%% ### $$$ " * 40, "en", "s1"), (41, "too short", "en", "s1"), (42, None, None, None), (43, "again and again one two three four\n" * 30, "en", "s2")]
    frame = spark.createDataFrame([(*d, len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "near duplicates", "mixing", "packing"]

    kept = stages["quality rules"](spark, frame, "")
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {*range(20), 30, 31}

    lines = stages["line dedup"](spark, kept, "")
    want = deduplicated(sorted((r["doc_id"], r["text"]) for r in kept.collect()), 10)
    got = {r["doc_id"]: r for r in lines.collect()}
    assert {i: r["text"] for i, r in got.items()} == {i: t for i, t in want.items() if t} and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[31]["text"] == "also this."

    near = stages["near duplicates"](spark, frame.filter("doc_id IN (0, 1, 30)").unionByName(frame.filter("doc_id = 30").selectExpr("doc_id + 70 doc_id", "concat(text, ' extra') text", "lang", "source", "n_chars")), "")
    assert {r["doc_id"] for r in near.collect()} == {0, 1, 30} and len(sets_of([(0, good)])[0]) > 100

    mixed = stages["mixing"](spark, lines, "")
    assert mixed.columns == frame.columns and {r["doc_id"] for r in mixed.collect()} <= set(got)
    packed = stages["packing"](spark, mixed, "").collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed.collect()}

    frame.write.parquet(str(tmp_path / "documents.parquet"))
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in run} == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in packed}
