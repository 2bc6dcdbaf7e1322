"""SRC-12: files by HTTP, as rows that `seams.choose_response` takes. Nothing else in the engine reaches a network."""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

#: How a request names itself, and the seconds that it may take.
USER_AGENT, TIMEOUT = "Mozilla/5.0 (X11; Linux x86_64; rv:128.0) Gecko/20100101 Firefox/128.0", 30
HTML = ("text/html", "application/xhtml")


def get(url: str, schemes: tuple[str, ...], timeout: float) -> tuple[bytes, str | None, str] | None:
    """Content, declared type and final URL of a response; None without a good one, and for HTML, which is for a browser."""
    if urlsplit(url).scheme.lower() not in schemes:
        return None
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": USER_AGENT}), timeout=timeout) as r:
            kind = r.headers.get("Content-Type")
            return None if any(h in (kind or "") for h in HTML) else (r.read(), kind, r.geturl())
    except (OSError, ValueError, urllib.error.URLError):
        return None


def fetch_http(urls: DataFrame, schemes: tuple[str, ...] = ("http", "https"), timeout: float = TIMEOUT) -> DataFrame:
    """SRC-12: (url, method, content, content_type, final_url) for each row of `urls` (url); without a response the last three are null.

    Requests run in the tasks of `urls`, one after another in each: repartition it for more at a time. A lost task asks again.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for url in b.column(0).to_pylist():
                content, kind, final = (get(url, schemes, timeout) if url else None) or (None, None, None)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((url, pa.string()), ("http", pa.string()), (content, pa.binary()), (kind, pa.string()), (final, pa.string()))], ["url", "method", "content", "content_type", "final_url"])

    return urls.select("url").mapInArrow(each, "url string, method string, content binary, content_type string, final_url string")
