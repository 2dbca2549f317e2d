"""Pages from the web as a page table, fetched on the executors. Runs are offline unless they ask for this.

Every hop of a redirect must lead to a public address: a usual port, no user, and a name that resolves to global
addresses only. The connection goes to an address that was checked, not to whatever the name resolves to later.
"""

from __future__ import annotations

import http.client
import ipaddress
import socket
import ssl
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame

MAX_HOPS, MAX_BYTES, TIMEOUT_S = 4, 2_000_000, 12.0
PAGE_TYPES = ("text/html", "application/xhtml+xml")


class Answer(NamedTuple):
    status: int
    headers: dict[str, str]
    body: bytes


def public_address(url: str, resolve: Callable = socket.getaddrinfo) -> str | None:
    """A checked global address of the url's host, or none if it may not be visited."""
    try:
        u = urlsplit(url)
        host = (u.hostname or "").lower()
        if u.scheme not in ("http", "https") or not host or u.username or u.password or u.port not in (None, 80, 443):
            return None
        if host in ("localhost", "localhost.localdomain") or host.endswith((".local", ".internal")):
            return None
        found = sorted({a[4][0] for a in resolve(host, u.port or 443)})
        return found[0] if found and all(ipaddress.ip_address(a).is_global for a in found) else None
    except (OSError, ValueError):
        return None


def open_address(url: str, address: str, timeout: float, max_bytes: int, context: ssl.SSLContext | None = None) -> Answer:
    """One request to ``address`` in the name of the url's host; reads a byte more than allowed, to tell."""
    u = urlsplit(url)
    sock = socket.create_connection((address, u.port or (443 if u.scheme == "https" else 80)), timeout)
    if u.scheme == "https":
        sock = (context or ssl.create_default_context()).wrap_socket(sock, server_hostname=u.hostname)
    connection = http.client.HTTPConnection(u.hostname, timeout=timeout)
    connection.sock = sock
    try:
        path = (u.path or "/") + (f"?{u.query}" if u.query else "")
        connection.request("GET", path, headers={"User-Agent": "siftline", "Accept": ", ".join(PAGE_TYPES), "Accept-Language": "fr,en;q=0.5"})
        r = connection.getresponse()
        return Answer(r.status, {k.lower(): v for k, v in r.getheaders()}, r.read(max_bytes + 1))
    finally:
        connection.close()


def fetch(url: str, resolve: Callable = socket.getaddrinfo, opener: Callable = open_address, max_bytes: int = MAX_BYTES, timeout: float = TIMEOUT_S) -> tuple[str, str] | None:
    """(final url, html) of a page within three redirects, or none: not public, not a page, too large, or any error."""
    for _ in range(MAX_HOPS):
        address = public_address(url, resolve)
        if address is None:
            return None
        try:
            answer = opener(url, address, timeout, max_bytes)
        except (OSError, http.client.HTTPException, ValueError):
            return None
        if answer.status in (301, 302, 303, 307, 308) and answer.headers.get("location"):
            url = urljoin(url, answer.headers["location"])
            continue
        kind, _, parameters = answer.headers.get("content-type", "").partition(";")
        if not 200 <= answer.status < 300 or kind.strip().lower() not in PAGE_TYPES or len(answer.body) > max_bytes:
            return None
        charset = parameters.partition("charset=")[2].strip(" \"'") or "utf-8"
        try:
            return url, answer.body.decode(charset, "replace")
        except LookupError:
            return url, answer.body.decode("utf-8", "replace")
    return None


def client(ca_file: str | None = None, max_bytes: int = MAX_BYTES, timeout: float = TIMEOUT_S) -> Callable[[str], tuple[str, str] | None]:
    """``fetch`` with one TLS context for all its requests, which trusts the certificates of ``ca_file`` too; a task makes one."""
    context = ssl.create_default_context()
    if ca_file:
        context.load_verify_locations(ca_file)
    opener = lambda url, address, timeout, most: open_address(url, address, timeout, most, context)
    return lambda url: fetch(url, opener=opener, max_bytes=max_bytes, timeout=timeout)


def page_store(urls: DataFrame, url_col: str = "url", concurrency: int = 4, fetcher: Callable[[str], tuple[str, str] | None] = fetch) -> DataFrame:
    """(requested, url, html) of the pages that could be read. Write the result before using it: reading it again fetches again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(u, fetcher(u)) for u in pdf["requested"]]
            yield pd.DataFrame([(u, *page) for u, page in got if page is not None], columns=["requested", "url", "html"])

    asked = urls.selectExpr(f"`{url_col}` AS requested").distinct().repartition(concurrency)
    return asked.mapInPandas(run, "requested string, url string, html string")
