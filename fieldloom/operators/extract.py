"""Routing pages to fields, prompts, pluggable extraction, and tolerant parsing of replies."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import PROMPT_CAP, first_filled, once, strip

#: The reply's keys, in order, and notes of stubs.
REPLY_KEYS = ("field", "value", "confidence", "source_url", "raw_snippet", "needs_review", "notes")
PARSE_ERROR, NOT_OBJECT, RATE_LIMITED = "parse_error", "not_object", "Rate limit exceeded"


def route_pages(entities: DataFrame, pages: DataFrame, routes: DataFrame) -> DataFrame:
    """(entity_id, route columns, text, url, text_label) for every entity and route.

    Text and url fall back independently, to the first that is not empty; `text_label` names the page the
    text came from ("" for none), so that a mismatch with the url shows. A page that is absent or null
    counts as empty; of several pages of a label the one with the smallest url and text counts. `entities`:
    entity_id and more; `pages`: entity_id, label, url, text. The pages of an
    entity are gathered in one map, so routing needs one shuffle however many routes there are.
    """
    by_label = F.map_from_entries(F.collect_list(F.struct("label", F.struct("page.text", "page.url"))))
    held = pages.groupBy("entity_id", "label").agg(F.min(F.struct("url", "text")).alias("page")).groupBy("entity_id").agg(by_label.alias("by_label"))
    full = entities.join(held, "entity_id", "left").crossJoin(F.broadcast(routes))
    at = lambda label, part: F.try_element_at("by_label", F.coalesce(F.col(label), F.lit("")))[part]
    text, second = at("text_label", "text"), at("text_fallback", "text")
    label = F.when(F.length(text) > 0, F.col("text_label")).when(F.length(second) > 0, F.col("text_fallback")).otherwise("")
    return full.withColumns({"text": first_filled(text, second), "url": first_filled(at("url_label", "url"), at("url_fallback", "url")), "used_label": label}).drop("by_label")


def prompt(name: Column, country: Column, currency: Column, url: Column, field: Column, text: Column) -> Column:
    """The request for one field; page text is cut to the first 4,000 code points."""
    lines = [
        F.concat(F.lit("Institution: "), name, F.lit(" ("), country, F.lit("), amounts in "), currency),
        F.concat(F.lit("Page: "), url),
        F.concat(F.lit("Wanted: "), field),
        F.lit("Answer with one JSON object of the keys " + ", ".join(REPLY_KEYS) + "; value is null when the page does not say."),
        F.lit("Text:"),
        F.substring(text, 1, PROMPT_CAP),
    ]
    return F.concat_ws("\n", *lines)


def parse_reply(reply: Column) -> Column:
    """A reply as a struct of value_json, confidence, source_url, raw_snippet, needs_review, notes, issue.

    Code fences are removed anywhere, then white space around. No JSON: a stub noted parse_error; JSON but
    no object: a stub noted not_object. A confidence that is no number counts as 0, a needs_review that is
    no boolean as true, both with an issue; a missing one as 0 and false. A confidence outside 0..1 passes
    with an issue. Notes and urls that are no text are kept as JSON text. value_json is null for a missing
    or null value.
    """
    bare = strip(F.replace(F.replace(strip(reply), F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))

    def read(v: Column) -> Column:
        top = F.schema_of_variant(v)
        get = lambda key, kind: F.try_variant_get(v, f"$.{key}", kind)
        kind = lambda key: F.schema_of_variant(get(key, "variant"))
        text = lambda key: F.when(kind(key) == "STRING", get(key, "string")).when(F.coalesce(kind(key), F.lit("VOID")) == "VOID", F.lit(None)).otherwise(F.to_json(get(key, "variant")))
        number = kind("confidence").rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT)")
        confidence = F.when(number, get("confidence", "double")).otherwise(0.0)
        review = F.when(kind("needs_review") == "BOOLEAN", get("needs_review", "boolean")).when(kind("needs_review").isNull(), False).otherwise(True)
        issue = (
            F.when(kind("confidence").isNotNull() & ~number, "confidence is no number")
            .when((confidence < 0) | (confidence > 1), "confidence outside 0..1")
            .when(kind("needs_review").isNotNull() & (kind("needs_review") != "BOOLEAN"), "needs_review is no boolean")
        )
        value = F.when(F.coalesce(kind("value"), F.lit("VOID")) != "VOID", F.to_json(get("value", "variant")))
        none = F.lit(None).cast("string")

        def reply_struct(value_json, confidence, url, snippet, review, notes, issue) -> Column:
            return F.struct(
                value_json.alias("value_json"), confidence.cast("double").alias("confidence"), url.alias("source_url"), snippet.alias("raw_snippet"), review.alias("needs_review"),
                notes.alias("notes"), issue.alias("issue"),
            )

        stub = lambda note: reply_struct(none, F.lit(0.0), none, none, F.lit(True), F.lit(note), F.lit(note))
        whole = reply_struct(value, confidence, text("source_url"), text("raw_snippet"), review, text("notes"), issue)
        return F.when(v.isNull(), stub(PARSE_ERROR)).when(~top.startswith("OBJECT"), stub(NOT_OBJECT)).otherwise(whole)

    return once(F.try_parse_json(bare), read)


def value_text(value_json: Column) -> Column:
    """A value's text: strings without quotes, anything else as its JSON; null stays null."""
    v = F.try_parse_json(value_json)
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(value_json)


class Extractor(Protocol):
    """Answers one request; raises on failure. Instances are sent to executors, one copy a partition."""

    def __call__(self, prompt: str, field: str, text: str, url: str) -> str: ...


class Recorded:
    """Replies by (url, field), for tests and replays; an unknown request gives a null value."""

    def __init__(self, replies: dict[tuple[str, str], str]) -> None:
        self.replies = replies

    def __call__(self, prompt: str, field: str, text: str, url: str) -> str:
        return self.replies.get((url, field), '{"value": null, "confidence": 0.0}')


class Patterns:
    """The first group of a field's pattern in the page text, with confidence 1."""

    def __init__(self, patterns: dict[str, str]) -> None:
        self.patterns = patterns

    def __call__(self, prompt: str, field: str, text: str, url: str) -> str:
        import json

        found = re.search(self.patterns[field], text) if field in self.patterns else None
        return json.dumps({"field": field, "value": found and found[1], "confidence": 1.0 if found else 0.0, "source_url": url, "raw_snippet": found and found[0][:150], "needs_review": not found, "notes": None})


class ChatService:
    """A chat-completion service over HTTP: a system and a user message, temperature 0, at most 1,024 tokens.

    The key comes from the environment of the driver; without it construction fails, before any work. Only
    the standard library is used. Untested against a live service here.
    """

    def __init__(self, endpoint: str, model: str, key_variable: str, system: str = "Extract only what the text says. Answer with one JSON object and nothing else.", timeout: float = 60) -> None:
        import os

        self.endpoint, self.model, self.system, self.timeout = endpoint, model, system, timeout
        self.key = os.environ[key_variable]

    def body(self, prompt: str) -> dict:
        messages = [{"role": "system", "content": self.system}, {"role": "user", "content": prompt}]
        return {"model": self.model, "messages": messages, "temperature": 0.0, "max_tokens": 1024}

    def __call__(self, prompt: str, field: str, text: str, url: str) -> str:
        import json
        from urllib.request import Request, urlopen

        headers = {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"}
        with urlopen(Request(self.endpoint, json.dumps(self.body(prompt)).encode(), headers), timeout=self.timeout) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]


#: Seconds before each new attempt after a rate limit, and what names one.
LIMIT_WAITS = (5, 10, 15, 20, 25, 30, 30, 30)
LIMIT_SIGNS = ("429", "rate_limit")


def _attempt(call: Callable[[], str]) -> tuple[str | None, str | None]:
    try:
        return call(), None
    except Exception as e:  # the service's errors are data here
        return None, str(e)


def with_retries(call: Callable[[], str], waits: tuple[float, ...] = LIMIT_WAITS, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """(reply, error). One attempt a wait; only a rate limit is waited out and tried again."""
    for wait in waits:
        reply, error = _attempt(call)
        if error is None or not any(sign in error.lower() for sign in LIMIT_SIGNS):
            return reply, error
        sleep(wait)
    return None, RATE_LIMITED


def extract(requests: DataFrame, extractor: Extractor, skip_empty: bool = False, pause: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """`requests` (prompt, prompt_name, text, url and more) with reply and error.

    The extractor is called in Arrow batches, one copy a partition, `pause` seconds apart; partitions set
    the concurrency. Errors are rows, never failures. Write the result before using it twice: Spark would
    call again on recomputation. With `skip_empty`, requests without text are not sent.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields) + ", reply string, error string"

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            replies = []
            for r in pdf.itertuples(index=False):
                if skip_empty and not r.text:
                    replies.append(('{"value": null, "confidence": 0.0}', None))
                    continue
                if pause:
                    sleep(pause)
                replies.append(with_retries(lambda r=r: extractor(r.prompt, r.prompt_name, r.text, r.url), sleep=sleep))
            pdf["reply"], pdf["error"] = [x[0] for x in replies], [x[1] for x in replies]
            yield pdf

    return requests.mapInPandas(run, schema)


def envelopes(replies: DataFrame) -> DataFrame:
    """Parsed envelopes of `extract`'s rows; a request that failed is a stub noted with its error."""
    parsed = replies.withColumn("e", parse_reply(F.coalesce("reply", F.lit("{}"))))
    failed = F.col("error").isNotNull()
    return parsed.select(
        "entity_id", "pos", "storage_key", "prompt_name", "url", "used_label",
        F.col("e.value_json").alias("value_json"), value_text(F.col("e.value_json")).alias("value"), F.col("e.confidence").alias("confidence"), F.col("e.source_url").alias("source_url"),
        F.col("e.raw_snippet").alias("raw_snippet"), (failed | F.col("e.needs_review")).alias("needs_review"), F.when(failed, F.col("error")).otherwise(F.col("e.notes")).alias("notes"), F.col("e.issue").alias("issue"),
    )
