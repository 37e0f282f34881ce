"""Pages: read from tables, or fetched politely."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.text import html_to_text, url_base
from fieldloom.schema import FETCHED

#: Seconds after each failed attempt, more seconds on a refusal, and between pages of a host.
DELAYS, REFUSED_WAIT, PAGE_GAP = (2, 4, 8), 30, 2
TIMEOUT = 30


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class Session:
    """GET over HTTP that keeps the connection to the last host open, with the standard library.

    A partition's pages come host by host, so one connection serves a host's pages. A connection that the
    server has closed is opened anew once; redirects are followed up to `most` times.
    """

    def __init__(self, agent: str = "fieldloom-bot/1.0", most: int = 10) -> None:
        self.agent, self.most, self.host, self.connection = agent, most, None, None

    def _connect(self, host: tuple[str, str]):
        from http.client import HTTPConnection, HTTPSConnection

        if self.host != host:
            self.close()
            self.connection, self.host = (HTTPSConnection if host[0] == "https" else HTTPConnection)(host[1], timeout=TIMEOUT), host
        return self.connection

    def _ask(self, url: str):
        from http.client import HTTPException
        from urllib.parse import urlsplit

        parts = urlsplit(url)
        path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        fresh = self.host != (parts.scheme, parts.netloc)
        try:
            connection = self._connect((parts.scheme, parts.netloc))
            connection.request("GET", path, headers={"User-Agent": self.agent})
            answer = connection.getresponse()
            return answer, answer.read()
        except (HTTPException, ConnectionError):
            self.close()
            if fresh:
                raise
            return self._ask(url)
        except BaseException:
            self.close()
            raise

    def __call__(self, url: str) -> tuple[int, str]:
        """Status and body."""
        from urllib.parse import urljoin

        for _ in range(self.most + 1):
            answer, body = self._ask(url)
            if answer.status not in (301, 302, 303, 307, 308) or not answer.headers.get("Location"):
                return answer.status, body.decode(answer.headers.get_content_charset() or "utf-8", "replace")
            url = urljoin(url, answer.headers["Location"])
        raise OSError("too many redirects")

    def close(self) -> None:
        if self.connection is not None:
            self.connection.close()
        self.host = self.connection = None


def fetch_one(url: str, get: Callable[[str], tuple[int, str]], sleep: Callable[[float], None] = time.sleep) -> dict:
    """A page with its status, attempts, time waited and last error; html is null unless a 200 came."""
    status, error, waited = None, None, 0.0
    for k, delay in enumerate(DELAYS, 1):
        try:
            status, body = get(url)
            if status == 200:
                return {"url": url, "html": body, "status": status, "attempts": k, "waited": waited, "error": None}
            error = f"HTTP {status}"
            if status in (403, 429):
                sleep(REFUSED_WAIT)
                waited += REFUSED_WAIT
        except Exception as e:  # a failed request is a row
            error = str(e)
        sleep(delay)
        waited += delay
    return {"url": url, "html": None, "status": status, "attempts": len(DELAYS), "waited": waited, "error": error}


def fetch(pages: DataFrame, get: Callable[[str], tuple[int, str]] | None = None, gap: float = PAGE_GAP, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Allowed urls (url, allowed) fetched once each; a host's pages are in one partition and one at a time.

    That is the politeness rule, not a load balance: hosts, not pages, are the unit of parallelism. Write the
    result before using it twice, and keep speculation off: a recomputed partition asks again. Urls that are
    not allowed have a null page without a request. A partition asks through one `Session`, which is closed at
    its end whatever happens, unless `get` is given.
    """
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session = None if get else Session()
        try:
            yield from pages_of(batches, get or session)
        finally:
            if session:
                session.close()

    def pages_of(batches: Iterator[pd.DataFrame], ask: Callable) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for url, ok in zip(pdf["url"], pdf["allowed"], strict=True):
                rows.append(fetch_one(url, ask, sleep) if ok else {"url": url, "html": None, "status": None, "attempts": 0, "waited": 0.0, "error": "robots"})
                if ok and gap:
                    sleep(gap)
            yield pd.DataFrame(rows, columns=FETCHED.names).astype({"status": "Int32", "attempts": "Int32"})

    urls = pages.select("url", "allowed").distinct()
    return urls.repartition(url_base(F.col("url"))).sortWithinPartitions(url_base(F.col("url")), "url").mapInPandas(run, FETCHED)


def page_texts(pages: DataFrame, fetched: DataFrame) -> DataFrame:
    """(entity_id, label, url, text): every page joined with what was fetched for its url."""
    return pages.join(fetched.select("url", html_to_text(F.col("html")).alias("text")), "url", "left").select("entity_id", "label", "url", "text")


def fetch_summary(texts: DataFrame) -> DataFrame:
    """Pages fetched (a text that is not empty) and tried, and the characters fetched, per entity."""
    n = F.length("text")
    return texts.groupBy("entity_id").agg(F.count_if(n > 0).alias("fetched"), F.count("*").alias("total"), F.coalesce(F.sum(n), F.lit(0)).alias("chars"))
