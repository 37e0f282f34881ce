"""robots.txt: one policy per scheme and host, matched in Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import url_base
from fieldloom.sources.pages import Session

AGENT = "fieldloom-bot/1.0"


def policy(status: int | None, body: str | None) -> str:
    """Rules text of a robots.txt answer: unreachable and other 4xx allow all; 401, 403 and 5xx deny all."""
    if status is None:
        return ""
    if status in (401, 403) or status >= 500:
        return "User-agent: *\nDisallow: /"
    return (body or "") if status < 400 else ""


@functools.lru_cache(maxsize=4096)
def _parser(rules: str):
    from urllib.robotparser import RobotFileParser

    parser = RobotFileParser()
    parser.parse(rules.splitlines())
    return parser


def allowed(rules: str | None, url: str | None, agent: str = AGENT) -> bool:
    return bool(url) and _parser(rules or "").can_fetch(agent, url)


def gate(pages: DataFrame, policies: DataFrame, agent: str = AGENT) -> DataFrame:
    """`pages` (url and more) with `allowed`; `policies`: base, rules. A base without a policy allows all.

    There is one policy a host, far fewer than pages; the planner picks the join by size.
    """

    @F.pandas_udf("boolean")
    def check(rules: pd.Series, url: pd.Series) -> pd.Series:
        return pd.Series([allowed(r, u, agent) for r, u in zip(rules, url, strict=True)])

    joined = pages.withColumn("base", url_base(F.col("url"))).join(policies, "base", "left")
    return joined.withColumn("allowed", check(F.coalesce("rules", F.lit("")), "url")).drop("rules")


def robots_get(url: str) -> tuple[int | None, str | None]:
    """Status and body of a robots.txt, or None twice for no answer."""
    session = Session(AGENT)
    try:
        return session(url)
    except Exception:  # unreachable is an answer here
        return None, None
    finally:
        session.close()


def fetch_policies(bases: DataFrame, get: Callable[[str], tuple[int | None, str | None]]) -> DataFrame:
    """(base, rules) of each distinct base, one request each; `get` returns status and body, or None for no answer."""

    def run(batches):
        for pdf in batches:
            pdf["rules"] = [policy(*get(f"{b}/robots.txt")) for b in pdf["base"]]
            yield pdf

    return bases.select("base").filter("base IS NOT NULL").distinct().mapInPandas(run, "base string, rules string")
